"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh 2016).

Every bit position gets a nonzero vector of r + 1 bits; the table of a nonzero vector v
keeps the positions whose vector has an odd product with v. For any r differing bits some
v is orthogonal to all their vectors, so a pair within the radius r always agrees on one
of the 2**(r+1) - 1 masked fingerprints: no pair is missed, and no probability is involved.

Equal fingerprints are one node. Inside a bucket (nodes that agree on a mask) the exact
distances are computed in one task and only a spanning star of each linked set leaves it,
never the pairs. A bucket of more than ``BUCKET`` nodes is cut by a second covering of the
bits its mask leaves open: a piece then has at most 2**14 nodes, and again no pair is lost.

Defined results: a null or empty text has the fingerprint zero and links like any other;
equal rows stay separate rows with equal results; null ids are ignored by the smallest id
(a component of null ids only has the id null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import ROW, Scratch, batch_rows, field, packed, pieces, ship, with_columns

BITS = 64
BUCKET = 1 << 14


def masks(radius: int, positions: list[int]) -> list[int]:
    """The masks of a covering of ``positions``; bits outside them are in no mask."""
    width = radius + 1
    vector = {p: i % (2**width - 1) + 1 for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (vector[p] & v).bit_count() & 1) for v in range(1, 2**width)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: bytes | None, shingle: int, seed: int) -> int:
    """Majority bits of the XXH64 of every word shingle, repeats included."""
    words = text.lower().split() if text else []  # bytes: A-Z and ASCII white space only
    n = len(words)
    if n == 0:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    size = np.fromiter(map(len, words), np.int64, n)
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    count, total = np.zeros(BITS, np.int64), n - shingle + 1
    name = xxhash.xxh64_intdigest
    for a in range(0, total, 65536):
        b = min(total, a + 65536)
        spans = zip(start[a:b].tolist(), stop[a + shingle - 1:b + shingle - 1].tolist(), strict=True)
        h = np.fromiter((name(line[i:j], seed) for i, j in spans), np.uint64, b - a)
        count += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > total).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``row`` and the fingerprint (a signed long) of every input row.

    The text travels to the Python workers beside the row only when it is a column of it.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "t", 8 << 20):
            fps = [fingerprint(t, shingle, seed) for t in batch_rows(b, "t").cast(pa.large_binary()).to_pylist()]
            yield with_columns(b, ["k"], {"fp": pa.array(np.array(fps, np.uint64).view(np.int64))})

    kept = [c for c in docs.columns if c != text]
    src = docs.select(
        F.struct(F.lit(True).alias("here"), *[F.col(f"`{c}`") for c in kept]).alias("k"),
        F.col(f"`{text}`").alias("t"),
    )
    out = src.mapInArrow(run, src.drop("t").withColumn("fp", F.lit(0).cast("long")).schema)
    return out.select(F.struct(*[F.col("k").getField(c).alias(c) for c in kept] or [F.lit(True).alias("here")]).alias(ROW), "fp")


def local_stars(nodes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its linked set) for the nodes of a bucket that have a link."""
    left = np.sort(nodes)
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        stack, found = [root], []
        while stack and len(left):
            x = stack.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                hit = left[near]
                found.append(hit)
                stack.extend(hit)
                left = left[~near]
        if found:
            members = np.concatenate(found)
            out_a.append(members)
            out_b.append(np.full(len(members), root, np.uint64))
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """Rows (a, b), a > b, that connect each linked set of each bucket (column ``fps``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = batch_rows(b, "fps")
            values = np.asarray(col.flatten()).astype(np.int64).view(np.uint64)
            size = np.asarray(col.value_lengths()).astype(np.int64)
            stop = np.cumsum(size)
            sides: list[tuple[np.ndarray, np.ndarray]] = []
            two = np.flatnonzero(size == 2)  # most buckets: all at once
            if len(two):
                x, y = values[stop[two] - 2], values[stop[two] - 1]
                near = np.bitwise_count(x ^ y) <= radius
                sides.append((np.maximum(x, y)[near], np.minimum(x, y)[near]))
            sides += [local_stars(values[stop[i] - size[i]:stop[i]], radius) for i in np.flatnonzero(size > 2).tolist()]
            if sides:
                a, c = (np.concatenate([s[i] for s in sides]).view(np.int64) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])

    return buckets.mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, radius: int, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """Distinct links between the distinct fingerprints ``nodes(fp)``; transitively they
    connect exactly the nodes that chains of pairs within ``radius`` connect."""
    tables = masks(radius, list(range(BITS)))
    spread = nodes.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(tables)])).alias("x"),
    ).select("fp", "x.t", "x.key")
    sizes = scratch.write(spread.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    members = scratch.write(spread.join(sizes, ["t", "key"]), "members")
    found = _bucket_links(members.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).select("fps"), radius)

    big = members.where(F.col("n") > bucket)
    inner = [masks(radius, [p for p in range(BITS) if not m >> p & 1]) for m in tables]
    sub = F.array(*[F.array(*[F.lit(signed(x)) for x in row]) for row in inner])
    again = big.select("t", "key", "fp", F.posexplode(F.get(sub, F.col("t"))).alias("t2", "mask")).select(
        "t", "key", "t2", F.col("fp").bitwiseAND(F.col("mask")).alias("key2"), "fp",
    )
    parts = again.groupBy("t", "key", "t2", "key2").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
    return found.union(_bucket_links(parts, radius)).distinct()


def stars(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node a, root b) of every connected set of at least two nodes, by alternating
    large-star and small-star rounds; each round's links are a written table."""
    state = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    cur = scratch.write(edges, "star0")
    before, k = state(cur), 0
    while before[0]:
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.write(large, f"large{k}")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").union(low.select("a", F.col("m").alias("b"))).distinct()
        k += 1
        cur = scratch.write(small, f"star{k}")
        scratch.drop(f"large{k - 1}", f"star{k - 1}")
        now = state(cur)
        if tuple(now) == tuple(before):
            break
        before = now
    return cur


def components(prints: DataFrame, key: str, scratch: Scratch, radius: int = 3, bucket: int = BUCKET, roots: bool = False) -> DataFrame:
    """``prints(fp, ..., key)`` with ``component_id``: the smallest ``key`` reachable over
    fingerprints within ``radius`` bits, the row's own included; with ``roots`` also
    ``root``, the fingerprint that stands for the component alone."""
    nodes = scratch.write(prints.groupBy("fp").agg(F.min(key).alias("low")), "nodes")
    star = stars(links(nodes.select("fp"), radius, scratch, bucket), scratch)
    member = nodes.join(star.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"),
    )
    label = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = scratch.write(member.join(label, "root").select("fp", "component_id", *["root"] * roots), "named")
    scratch.drop("members", "sizes")
    return prints.join(named, "fp")


def _grouped(docs: DataFrame, id_col: str, text: str, shingle: int = 3, radius: int = 3, seed: int = 42, bucket: int = BUCKET, roots: bool = False) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "simhash")
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    prints = scratch.write(fingerprints(slim, "text", shingle, seed).select(field("id").alias("id"), field("text_hash").alias("text_hash"), "fp"), "prints")
    return components(prints, "id", scratch, radius, bucket, roots)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The id, ``text_hash``, ``fingerprint`` (long) and ``component_id`` of every input row."""
    return _grouped(docs, id_col, text, **options).select(F.col("id").alias(id_col), "text_hash", F.col("fp").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The input's rows with one document of each near-duplicate group: that with the
    smallest id, null after all others, and of rows that share it that with the smallest
    hash of its text (of rows that repeat both id and text, one)."""
    found = _grouped(docs, id_col, text, roots=True, **options)
    least = found.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root", "id").agg(F.min("text_hash").alias("k2"))
    keep = least.select(F.xxhash64("id").alias("k1"), "k2")
    src = packed(docs).select(ROW, F.xxhash64(field(id_col)).alias("k1"), F.xxhash64(field(text)).alias("k2"))
    kept = src.join(keep, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return kept.select(*[field(c).alias(c) for c in docs.columns])
