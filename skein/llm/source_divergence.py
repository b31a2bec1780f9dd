"""How the sources of a language differ in their terms: an audit in exact integers.

Counting. Inside a task the terms of a chunk of texts are dealt into buckets by their length: terms
of up to 8 bytes are packed into one unsigned 64-bit word, those of up to 16 bytes into two, each
bucket as wide as its longest term may be; a stable radix sort by digits of 16 bits (a bucket
of 2 bytes needs one pass, one of 16 bytes eight) brings equal terms together, and runs are
counted in numpy. Longer terms have buckets of their own (twice as wide each), sorted by
their bytes. The texts of a chunk are ordered by (lang, source) first and every sort is stable,
so one order gives occurrences per group and documents per term. Spark adds the runs up.

Shares. A group (lang, source) and its lang give each of the V kept terms a share
p = 1 + floor(10**9 * (count + 1) / (N + V)), without a table of groups times terms: all
terms that a group lacks have the one share p0. For two groups g, h the sum of
f(p, q) = floor((p - q)**2 / q) over all kept terms is therefore, exactly,

    V f(p0, q0) + sum over terms of g of [f(p, q0) - f(p0, q0)]
                + sum over terms of h of [f(p0, q) - f(p0, q0)]
                + sum over terms of both of [f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)].

The two middle sums need only how often each share occurs in a group; the last is summed in
numpy where the groups of a term lie side by side (at most the sources of a lang, whose pairs
are the result), one matrix a task.

Defined results: null text, lang and source read as ''; rows count one by one, repeated
ones too; a text without terms still makes its group; a lang without kept terms gives every
pair the value 0 and no term rows; ties rank by the item's bytes; an empty table gives no rows. Texts
of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import LOWER_BYTES, Scratch, batch_rows, field, packed, pieces, scaled, ship, text_bytes, word_bounds

CHUNK = 8 << 20     # bytes of text counted at once
SHORT = (2, 4, 6, 8, 12, 16)
BILLION = 3         # 10**9 as a power of 1000
DOCUMENTS, RANKS = 3, 200

#: Bytes that are in no term: ASCII but its letters.
BETWEEN = np.zeros(256, bool)
BETWEEN[:128] = True
BETWEEN[65:91] = BETWEEN[97:123] = False


def _buckets(size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(width, places) of the terms by their length; beyond 16 bytes widths double."""
    if not len(size):
        return
    widths = list(SHORT)
    while widths[-1] < size.max():
        widths.append(2 * widths[-1])
    slot = np.searchsorted(widths, size)
    for i, width in enumerate(widths):
        at = np.flatnonzero(slot == i)
        if len(at):
            yield width, at


def _bytes_of(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """The terms as rows of ``width`` bytes, padded with zeros (no term holds one)."""
    out = np.zeros((len(start), width), np.uint8)
    if width <= 64:
        for j in range(width):
            at = np.flatnonzero(size > j) if j else slice(None)
            out[at, j] = data[start[at] + j]
    else:
        for i, (a, n) in enumerate(zip(start.tolist(), size.tolist(), strict=True)):
            out[i, :n] = data[a:a + n]
    return out


def _order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a stable order that brings equal rows together, whether a row differs from the one before)."""
    n, width = rows.shape
    if width <= SHORT[-1]:
        words = np.zeros((n, 8 if width <= 8 else 16), np.uint8)
        words[:, :width] = rows
        packed_words = words.view("<u8")            # one or two unsigned 64-bit words a term
        order = np.arange(n)
        for w in range(packed_words.shape[1]):
            for digit in range(min(4, -(-(width - 8 * w) // 2))):
                key = (packed_words[:, w] >> np.uint64(16 * digit)).astype(np.uint16)
                order = order[np.argsort(key[order], kind="stable")]
        sorted_words = packed_words[order]
        other = (sorted_words[1:] != sorted_words[:-1]).any(axis=1)
    else:
        key = rows.view(f"S{width}").ravel()
        order = np.argsort(key, kind="stable")
        other = key[order[1:]] != key[order[:-1]]
    return order, np.concatenate([[True], other])


def count_terms(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(start, size, group, occurrences, documents) of each term and group; the documents that
    ``offsets`` cut out of ``data`` (in lower case) are in the order of their groups."""
    starts, stops, first = word_bounds(data, offsets, BETWEEN)
    size = stops - starts
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    for width, at in _buckets(size):
        order, new = _order(_bytes_of(data, starts[at], size[at], width))
        here = at[order]
        d = doc[here]
        g = group[d]
        new_doc = new.copy()
        new_doc[1:] |= d[1:] != d[:-1]
        new_group = new.copy()
        new_group[1:] |= g[1:] != g[:-1]
        run = np.flatnonzero(new_group)
        yield starts[here[run]], size[here[run]], g[run], np.diff(np.append(run, len(here))), np.add.reduceat(new_doc.astype(np.int64), run)


def _strings(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    stop = np.cumsum(size)
    at = np.repeat(start - (stop - size), size) + np.arange(int(stop[-1]))
    offsets = np.concatenate([[0], stop]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes())).cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "d"]
    for b in pieces(batches, "text", CHUNK):
        keys = pa.table({"lang": batch_rows(b, "lang"), "source": batch_rows(b, "source"), "i": pa.array(np.arange(b.num_rows))}).sort_by([("lang", "ascending"), ("source", "ascending"), ("i", "ascending")]).combine_chunks()
        lang, source = keys["lang"].combine_chunks(), keys["source"].combine_chunks()
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(source[1:], source[:-1]))
        group = np.concatenate([[0], np.cumsum(~np.asarray(same).astype(bool))])
        head = pa.array(np.flatnonzero(np.concatenate([[True], np.diff(group) > 0])))
        data, offsets = text_bytes(batch_rows(b, "text").take(keys["i"].combine_chunks()))
        data = LOWER_BYTES[data]
        for start, size, g, n, d in count_terms(data, offsets, group):
            for a in range(0, len(g), 200_000):
                cut = slice(a, a + 200_000)
                which = pa.array(g[cut])
                yield pa.RecordBatch.from_arrays([lang.take(head).take(which), source.take(head).take(which), _strings(data, start[cut], size[cut]), pa.array(n[cut]), pa.array(d[cut])], names)


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows hold the groups of one term; the last sum of the docstring for each two groups."""
    total: dict[tuple[int, int], int] = {}
    for b in batches:
        col = batch_rows(b, "xs")
        flat = pc.list_flatten(col)
        if not len(flat):
            continue
        gid, p, p0 = (np.asarray(pc.struct_field(flat, i)).astype(np.int64) for i in range(3))
        size = np.asarray(pc.list_value_length(col)).astype(np.int64)
        last = np.repeat(np.cumsum(size), size)      # end of the term of each entry
        names, code = np.unique(gid, return_inverse=True)
        sums = np.zeros(len(names) ** 2, np.int64)
        for step in range(1, int(size.max())):
            a = np.flatnonzero(np.arange(len(gid)) + step < last)
            for i, j in ((a, a + step), (a + step, a)):
                f = (p[i] - p[j]) ** 2 // p[j] - (p[i] - p0[j]) ** 2 // p0[j] - (p0[i] - p[j]) ** 2 // p[j] + (p0[i] - p0[j]) ** 2 // p0[j]
                np.add.at(sums, code[i] * len(names) + code[j], f)
        for k in np.flatnonzero(sums).tolist():
            pair = int(names[k // len(names)]), int(names[k % len(names)])
            total[pair] = total.get(pair, 0) + int(sums[k])
    if total:
        g, h = zip(*total, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(h, pa.int64()), pa.array(list(total.values()), pa.int64())], ["g", "h", "value"])


def divergence(docs: DataFrame, documents: int = DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank: how far the source's shares
    are from each other source's of its lang, summed over all terms in at least ``documents``
    documents of the lang; and the ``ranks`` terms that it uses most above its lang's share."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "divergence")
    read = packed(docs).select(*[F.coalesce(field(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    runs = read.mapInArrow(_count, "lang string, source string, term string, n long, d long")
    counts = scratch.write(runs.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")), "counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("d").alias("d")).where(F.col("d") >= documents).drop("d")
    terms = scratch.write(terms, "terms")
    kept = scratch.write(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "kept")
    scratch.drop("counts")

    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = read.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
    groups = groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("total_lang", F.lit(0)).alias("total_lang"))
    groups = groups.select("*", F.monotonically_increasing_id().alias("gid"), F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v"))).alias("p0"))
    groups = scratch.write(groups, "groups")

    held = kept.join(groups, ["lang", "source"])
    held = held.select("lang", "source", "term", "gid", "p0", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), _share(F.col("n_lang"), F.col("total_lang"), F.col("v")).alias("q"))
    held = scratch.write(held, "held")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    top = held.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    top = top.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)

    pairs = _pairs(held, groups)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    return scratch.write(top.unionByName(pairs), "result")


def _share(count: Column, total: Column, terms: Column) -> Column:
    return 1 + scaled(count + F.lit(1).cast("long"), total + terms, BILLION)


def _pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    """The sum over all kept terms for each two sources of a lang (the result's own pairs)."""
    me = groups.select("lang", "source", "v", F.col("gid").alias("g"), F.col("p0").alias("p0"))
    you = groups.select("lang", F.col("source").alias("item"), F.col("gid").alias("h"), F.col("p0").alias("q0"))
    pair = me.join(you, "lang").where(F.col("g") != F.col("h"))
    # How often each share occurs in a group: few shares, however many terms.
    shares = held.groupBy("lang", F.col("gid").alias("g"), "p0", "p").agg(F.count(F.lit(1)).alias("n"))
    other = shares.join(you.select("lang", "h", "q0"), "lang").where(F.col("g") != F.col("h"))
    p, p0, q0, n = (F.col(c) for c in ("p", "p0", "q0", "n"))
    mine = other.groupBy("g", "h").agg(F.sum(n * (_f(p, q0) - _f(p0, q0))).alias("value"))
    yours = other.groupBy(F.col("h").alias("g"), F.col("g").alias("h")).agg(F.sum(n * (_f(q0, p) - _f(q0, p0))).alias("value"))
    side = held.groupBy("lang", "term").agg(F.collect_list(F.struct("gid", "p", "p0")).alias("xs"))
    both = side.select("xs").where(F.size("xs") > 1).mapInArrow(_shared, "g long, h long, value long")
    base = pair.where(F.col("v") > 0).select("g", "h", (F.col("v") * _f(p0, q0)).alias("value"))
    total = base.unionByName(mine).unionByName(yours).unionByName(both).groupBy("g", "h").agg(F.sum("value").alias("value"))
    return pair.join(total, ["g", "h"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
