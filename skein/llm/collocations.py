"""Phrase mining by joins of sorted occurrence relations (SETM, Houtsma and Swami 1995).

An occurrence relation holds, sorted by piece and position, which group (a word at first, then a phrase) starts
at each place. It is persisted as packed rows, one a part of the corpus and lang: a part is
``PART`` words that one task has met, its groups numbered from 0, a break between pieces. A round is

1. group-count: the parts' distinct groups with their counts are rows of a table; Spark sorts
   them by group and adds them up. Groups of at least ``least`` occurrences are frequent;
   a word's id is its first place (the smallest part, and its number there), a phrase's its number in its bucket;
2. semi-join: the rows of frequent groups, with their ids, return to their parts;
3. merge-join: the part's relation, cut to frequent groups, meets itself at the next position.
   Two phrases of k words that overlap in k - 1 are one phrase of k + 1; its key is the
   pair of their ids, exact and of fixed size whatever the words.

The rows of a round are shuffled once by group, where one sort serves both the counts and
the semi-join, and what is left of them once by part. Counting rows of phrases travel packed: a part
sorts its groups by (bucket, head, tail), a hash of the pair naming the bucket, and sends each
bucket's as one compressed row, whose place in the part's order needs no column. The answers return
in the same form, as do the relations. A bucket holds the groups of about ``BUCKET`` words, so buckets
follow the corpus. A round's shuffle files are deleted when its table is written.

A phrase of k + 1 words is frequent only if both of its phrases of k words are, so nothing is
lost. Counting rows are distinct within a part, so a word pair of a third of all rows is one
row a part of ``PART`` words. A frequent phrase carries the counts of all its heads and tails from its parents,
so cuts need no further join.

Defined results: a null lang reads as ``und``, a null text as empty; repeated rows count each
time; equal scores rank by the count, then the phrase's bytes; phrases never cross a piece
or a document; an empty table gives no rows. Texts of any length are taken whole; a text of more
than ``PART`` words makes a larger part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from skein.llm.common import LOWER_BYTES, Scratch, batch_rows, field, mix64, packed, pieces, scaled, ship, text_bytes, word_bounds
from skein.llm.cuts import distinct

LEAST, LONGEST = 30, 4
SHARE = 80          # percent of a phrase's count that a longer one needs to take its place
TOP = 2000
PART = 4 << 20      # words of an occurrence relation held at once
PARTS = 1 << 12     # parts of a task at most
PLACES = 1 << 31    # groups of a part at most
CHUNK = 2 << 20     # bytes of text cut at once
ROWS = 200_000      # counting rows a record batch
BUCKET = 2 << 20    # words whose phrases are counted together, at most about
LEAST_BUCKET = 1 << 16   # words of a bucket where there are few
BUCKETS = 256       # buckets of a small corpus
PACKETS = 2_000     # packed rows a record batch

#: Bytes that end a piece, and all bytes between words.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = ENDS.copy()
BETWEEN[[0x20, 0x09]] = True

WORDS = StructType([StructField("part", LongType()), StructField("lang", StringType()), StructField("seq", BinaryType()), StructField("local", IntegerType()), StructField("word", StringType()), StructField("n", LongType())])
PHRASES = StructType([StructField("part", LongType()), StructField("seq", BinaryType()), StructField("bucket", LongType()), StructField("first", LongType()), StructField("size", IntegerType()), StructField("rows", BinaryType())])
#: Answers to a part (its groups' numbers and ids, packed), and the frequent groups themselves.
BACK = StructType([StructField("part", LongType()), StructField("size", IntegerType()), StructField("rows", BinaryType()), StructField("id", LongType()), StructField("head", LongType()), StructField("tail", LongType()), StructField("f", LongType())])


def _pack(*columns: np.ndarray) -> bytes:
    """Whole numbers, their bytes of equal weight side by side, compressed."""
    rows = np.stack(columns).astype(np.int64, copy=False)
    return pa.compress(rows.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes(), "zstd", asbytes=True)


def _unpack(rows: bytes, size: int, columns: int) -> np.ndarray:
    raw = pa.decompress(rows, columns * size * 8, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(columns, 8, size).transpose(0, 2, 1)).view(np.int64).reshape(columns, size)


def _pack_sequence(seq: np.ndarray) -> bytes:
    """An occurrence relation; places between two that join nothing are one break."""
    seq = seq.astype(np.int32, copy=False)
    seq = seq[np.concatenate([[True], (seq[1:] >= 0) | (seq[:-1] >= 0)])] if len(seq) else seq
    return len(seq).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(seq.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _sequence(rows: bytes) -> np.ndarray:
    n = int.from_bytes(rows[:8], "little")
    raw = pa.decompress(rows[8:], 4 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view(np.int32).reshape(n)


def _batch(schema: StructType, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {LongType(): pa.int64(), StringType(): pa.string(), BinaryType(): pa.binary(), IntegerType(): pa.int32()}
    n = len(next(iter(columns.values())))
    arrays = [columns[f.name].cast(kinds[f.dataType]) if f.name in columns else pa.nulls(n, kinds[f.dataType]) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])


def word_sequence(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(the distinct words, the number of the word at each place with -1 between pieces) of the
    lower-case texts that ``offsets`` cut out of ``data``."""
    starts, stops, first = word_bounds(data, offsets, BETWEEN)
    if not len(starts):
        return [], np.zeros(0, np.int32)
    # The words one after another, so that the cuts are the words.
    size = stops - starts
    begin = np.cumsum(size) - size
    joined = data[np.repeat(starts - begin, size) + np.arange(int(size.sum()))]
    each, which = distinct(joined, begin)
    piece = np.cumsum(ENDS[data])[starts]
    new = np.concatenate([[False], piece[1:] != piece[:-1]])
    new[first[:-1][(first[:-1] > 0) & (first[:-1] < len(starts))]] = True
    out = np.full(len(starts) + int(new.sum()), -1, np.int32)
    out[np.arange(len(starts)) + np.cumsum(new)] = which
    return each, out


class _Part:
    """The words of one lang that a task holds."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.runs: list[np.ndarray] = []

    def add(self, each: list[bytes], seq: np.ndarray) -> None:
        number = self.number
        to = np.array([number.setdefault(w, len(number)) for w in each] + [-1], np.int32)
        self.runs.append(np.append(to[seq], np.int32(-1)))

    def batches(self, part: int, lang: str) -> Iterator[pa.RecordBatch]:
        seq = np.concatenate(self.runs)
        yield _batch(WORDS, part=pa.array([part]), lang=pa.array([lang]), seq=pa.array([seq.tobytes()], pa.binary()))
        words, n = list(self.number), np.bincount(seq[seq >= 0], minlength=len(self.number))
        for a in range(0, len(words), ROWS):
            cut = words[a:a + ROWS]
            yield _batch(WORDS, part=pa.array([part] * len(cut)), lang=pa.array([lang] * len(cut)), local=pa.array(np.arange(a, a + len(cut))),
                         word=pa.array([w.decode() for w in cut], pa.string()), n=pa.array(n[a:a + ROWS]))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrence relations of the words, and their counts in each part."""
    from pyspark import TaskContext

    task, used, held, size = TaskContext.get().partitionId() * PARTS, 0, {}, 0

    def full() -> Iterator[pa.RecordBatch]:
        nonlocal used, held, size
        for lang, part in held.items():
            if used >= PARTS:
                raise ValueError("a task of more parts than it can number: read the corpus in smaller partitions")
            yield from part.batches(task + used, lang)
            used += 1
        held, size = {}, 0

    for b in pieces(batches, "text", CHUNK):
        langs = batch_rows(b, "lang")
        for lang in pc.unique(langs).to_pylist():
            data, offsets = text_bytes(batch_rows(b, "text").filter(pc.equal(langs, lang)))
            each, seq = word_sequence(LOWER_BYTES[data], offsets)
            if len(seq):
                held.setdefault(lang, _Part()).add(each, seq)
                size += len(seq)
        if size >= PART:
            yield from full()
    yield from full()


def _table(batches: Iterator[pa.RecordBatch], schema: StructType) -> pa.Table:
    return pa.Table.from_batches([*batches] or [_batch(schema, part=pa.array([], pa.int64()))])


def _answers(right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A part's frequent groups, by id: their numbers in the part and their ids."""
    if "local" in right.column_names:
        local, ids = np.asarray(right["local"]).astype(np.int64), np.asarray(right["id"]).astype(np.int64)
    else:
        local, ids = np.concatenate([_unpack(r, n, 2) for r, n in zip(right["rows"].to_pylist(), right["size"].to_pylist(), strict=True)], axis=1)
    order = np.argsort(ids)
    return local[order], ids[order]


def _extend(first: bool, last: bool, buckets: int):
    """The merge-join of one part's relation with itself, once cut to its frequent groups."""
    def run(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        if not left.num_rows or not right.num_rows:
            return
        rows = left["seq"][0].as_py()
        seq, (local, ids) = np.frombuffer(rows, np.int32) if first else _sequence(rows), _answers(right)
        to = np.full(max(int(seq.max()), int(local.max())) + 2, -1, np.int64)
        to[local] = np.arange(len(ids))
        place = to[seq]                                  # -1 is the last entry: no group
        at = np.flatnonzero((place[:-1] >= 0) & (place[1:] >= 0))
        key, which, n = np.unique(place[at] * len(ids) + place[at + 1], return_inverse=True, return_counts=True)
        if not len(key):
            return
        part = left["part"][0].as_py()
        head, tail = ids[key // len(ids)], ids[key % len(ids)]
        bucket = (mix64(mix64(head.view(np.uint64)) + tail.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")        # in a bucket, by head and tail
        if not last:
            number = np.empty(len(key), np.int32)
            number[order] = np.arange(len(key))
            joined = np.full(len(seq), -1, np.int32)
            joined[at] = number[which]
            yield _batch(PHRASES, part=pa.array([part]), seq=pa.array([_pack_sequence(joined)], pa.binary()))
        head, tail, n, bucket = head[order], tail[order], n[order], bucket[order]
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        stops = np.append(starts[1:], len(key))
        for a in range(0, len(starts), PACKETS):
            of = list(zip(starts[a:a + PACKETS].tolist(), stops[a:a + PACKETS].tolist(), strict=True))
            yield _batch(PHRASES, part=pa.array([part] * len(of)), bucket=pa.array(bucket[starts[a:a + PACKETS]]), first=pa.array([i for i, _ in of]),
                         size=pa.array([j - i for i, j in of]), rows=pa.array([_pack(np.diff(head[i:j], prepend=0), tail[i:j], n[i:j]) for i, j in of], pa.binary()))

    return lambda left, right: _table(run(left, right), PHRASES)


def _count(least: int, buckets: int):
    """Group-count and semi-join of one bucket's phrases: the answers to its parts, and one row a
    frequent phrase."""
    def run(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        size, first = np.asarray(rows["size"]).astype(np.int64), np.asarray(rows["first"]).astype(np.int64)
        each = [_unpack(r, n, 3) for r, n in zip(rows["rows"].to_pylist(), size.tolist(), strict=True)]
        head, tail, n = np.concatenate([np.cumsum(e[0]) for e in each]), np.concatenate([e[1] for e in each]), np.concatenate([e[2] for e in each])
        del each
        order = np.lexsort((tail, head))
        head, tail, n = head[order], tail[order], n[order]
        new = np.concatenate([[True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])])
        starts = np.flatnonzero(new)
        f = np.add.reduceat(n, starts)
        frequent = f >= least
        if not frequent.any():
            return
        group = np.cumsum(new) - 1
        ids = (np.cumsum(frequent) - 1) * buckets + rows["bucket"][0].as_py()
        of = np.full(len(order), -1, np.int64)           # the id of each row, as the rows came
        of[order] = np.where(frequent, ids, -1)[group]
        begin = np.cumsum(size) - size
        local = np.arange(len(order)) + np.repeat(first - begin, size)
        part = np.asarray(rows["part"]).astype(np.int64)
        answers = []
        for p, a, k in zip(part.tolist(), begin.tolist(), size.tolist(), strict=True):
            hit = a + np.flatnonzero(of[a:a + k] >= 0)
            if len(hit):
                answers.append((p, len(hit), _pack(local[hit], of[hit])))
        for a in range(0, len(answers), PACKETS):
            p, k, r = zip(*answers[a:a + PACKETS], strict=True)
            yield _batch(BACK, part=pa.array(p), size=pa.array(k), rows=pa.array(r, pa.binary()))
        at = starts[frequent]
        for a in range(0, len(at), ROWS):
            cut = at[a:a + ROWS]
            yield _batch(BACK, id=pa.array(ids[frequent][a:a + ROWS]), head=pa.array(head[cut]), tail=pa.array(tail[cut]), f=pa.array(f[frequent][a:a + ROWS]))

    return lambda rows: _table(run(rows), BACK)


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each lang: those of 2 to
    ``longest`` words and at least ``least`` occurrences, by the cut at which their parts are
    least bound to each other, without those that a longer phrase mostly takes the place of."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "collocations", drop_shuffles=True)
    read = packed(docs).select(F.coalesce(field("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(field("text").cast("string"), F.lit("")).alias("text"))
    held = scratch.write(read.mapInArrow(_words, WORDS), "words")
    total = scratch.write(held.where("word is not null").groupBy("lang").agg(F.sum("n").alias("n")), "total")
    words = total.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, min(words // LEAST_BUCKET, BUCKETS), words // BUCKET)
    back = scratch.write(_frequent(held.where("word is not null"), ["lang", "word"], least), "back-1")
    one = _first(back).select("id", "lang", "f", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("f").alias("heads"), F.array("f").alias("tails"))
    found = [scratch.write(one, "frequent-1")]
    for k in range(2, longest + 1):
        relation = held.where("seq is not null").select("part", "seq")
        answers = back.where("part is not null").select(F.col("part").alias("to"), *(["local", "id"] if k == 2 else ["size", "rows"]))
        joined = relation.groupBy("part").cogroup(answers.groupBy("to")).applyInArrow(_extend(k == 2, k == longest, buckets), PHRASES)
        held = scratch.write(joined, f"held-{k}")
        scratch.drop("words" if k == 2 else f"held-{k - 1}", f"back-{k - 1}")
        counted = held.where("seq is null").select("bucket", "part", "first", "size", "rows").groupBy("bucket").applyInArrow(_count(least, buckets), BACK)
        back = scratch.write(counted, f"back-{k}")
        found.append(scratch.write(_phrase(back.where("part is null"), found[-1]), f"frequent-{k}"))
    scratch.drop(f"held-{longest}", f"back-{longest}")
    return _ranked(found, total, share, top)


def _frequent(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Group-count and semi-join: the parts' rows of frequent groups with the group's count and id."""
    group = Window.partitionBy(*keys)
    place = F.col("part") * PLACES + F.col("local")
    counted = rows.select("part", "local", *keys, F.sum("n").over(group).alias("f"), F.min(place).over(group).alias("id"))
    return counted.where(F.col("f") >= least)


def _first(rows: DataFrame) -> DataFrame:
    """One row a group: that of its first place."""
    return rows.where(F.col("id") == F.col("part") * PLACES + F.col("local"))


def _phrase(pairs: DataFrame, parents: DataFrame) -> DataFrame:
    """Frequent pairs of overlapping phrases with their words and the counts of their heads and tails."""
    head = parents.select(F.col("id").alias("head"), "lang", F.col("phrase").alias("begins"), "heads")
    tail = parents.select(F.col("id").alias("tail"), "last", "tails")
    both = pairs.select("id", "head", "tail", "f").join(head, "head").join(tail, "tail")
    return both.select(
        "id", "head", "tail", "lang", "f", F.concat("begins", F.lit(" "), "last").alias("phrase"), "last",
        F.array_append("heads", F.col("f")).alias("heads"), F.array_append("tails", F.col("f")).alias("tails"))


def _cut(words: int) -> Column:
    """The lowest-scoring cut of a phrase: (score, k, l, r)."""
    cuts = []
    for k in range(1, words):
        left, right = F.col("heads")[k - 1], F.col("tails")[words - k - 1]
        cuts.append(F.struct(scaled(2 * F.col("f"), left + right, 2).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def _ranked(frequent: list[DataFrame], total: DataFrame, share: int, top: int) -> DataFrame:
    """Scores and ranks. A phrase inside any longer one with enough of its count lies inside one
    that is a single word longer with at least that count, so those alone are looked at."""
    out = None
    for i, level in enumerate(frequent[1:], 1):
        kept = level.select("id", "lang", "phrase", F.col("f").alias("a"), _cut(i + 1).alias("cut"))
        if i + 1 < len(frequent):
            longer = frequent[i + 1]
            over = longer.select(F.col("head").alias("id"), "f").unionByName(longer.select(F.col("tail").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("over"))
            kept = kept.join(over, "id", "left").where(F.col("over").isNull() | (100 * F.col("over") < share * F.col("a")))
        kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        out = kept if out is None else out.unionByName(kept)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return first.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
