"""Benchmark decontamination: prefix-filtered set join with exact verification.

A window is 10 consecutive words of a benchmark item (the whole item if it has fewer).
Its shingles (runs of up to 3 words) are its set; a document contains the window only if
it contains all of them, so the prefix a join needs is one shingle: the rarest, by the
shingle's count over all documents. A hit at word p of a shingle that starts at offset o
of a window of L words leaves one possible place, p - o; the positional and length bounds
are p - o >= 0 and p - o + L <= words of the document. There the words are compared.

Documents are never shuffled: the shingles of a text are generated, joined with the
broadcast windows and verified inside one stage, and only hits leave it. A broadcast side
is a block of at most ``BLOCK_WINDOWS`` windows and ``BLOCK_BYTES`` bytes of their words
(the counts are checked); a larger benchmark is taken in several blocks, each against all
documents.

Defined results: null and empty texts have no words and are clean; an item without words
has no window; a null item id is not listed though its windows count as hits; rows that
repeat an id and a text each get their row; equal windows of several items count for each.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import Scratch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 50_000
BLOCK_BYTES = 16 << 20
BLOCK_SHINGLES = 500_000


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case; ``lower`` does just that to a text of ASCII alone."""
    t = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _shingle(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(words, at + j) for j in range(width)])


def _blocks(df: DataFrame, key: Column, n: int) -> list[DataFrame]:
    return [df] if n <= 1 else [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def item_windows(items: DataFrame, id_col: str, text: str, window: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(distinct windows: win, size, gid), (gid, item) where gid is a set of items."""
    w = items.select(F.col(f"`{id_col}`").alias("item"), words_of(F.col(f"`{text}`")).alias("w")).where(F.size("w") > 0)
    each = w.select("item", "w", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("i"))
    wins = each.groupBy(F.slice("w", F.col("i") + 1, F.lit(window)).alias("win")).agg(F.sort_array(F.collect_set("item")).alias("items"))
    wins = scratch.write(wins.withColumn("wid", F.monotonically_increasing_id()), "windows")
    groups = wins.groupBy("items").agg(F.min("wid").alias("gid"))
    named = scratch.write(wins.join(groups, "items").select("win", F.size("win").alias("size"), "gid"), "named")
    return named, scratch.write(groups, "groups")


def _positions(docs: DataFrame, widths: list[int], base: bool) -> DataFrame:
    """A row for every shingle of every document; with ``base`` also one with place -1."""
    many, at = len(widths), F.col("q")
    spans = docs.withColumn("q", F.explode_outer(F.sequence(F.lit(-1 if base else 0), F.greatest(F.size("w") * many - 1, F.lit(-1 if base else 0)))))
    place = F.floor(at / F.lit(many)).cast("int") if many > 1 else at
    token = reduce(lambda x, i: x.when(at % many == i, _shingle(F.col("w"), place, widths[i])), range(many - 1), F.when(at < 0, F.lit(0).cast("long"))).otherwise(_shingle(F.col("w"), place, widths[-1]))
    return spans.withColumn("p", place).withColumn("token", token)


def _offsets(windows: DataFrame, shingle: int) -> DataFrame:
    """Every shingle of every window: win, size, gid, offset, token."""
    width = F.least(F.col("size"), F.lit(shingle))
    rows = windows.withColumn("o", F.explode_outer(F.sequence(F.lit(0), F.col("size") - width)))
    token = F.coalesce(*[F.when(width == k, _shingle(F.col("win"), F.col("o"), k)) for k in range(1, shingle + 1)])
    return rows.withColumn("width", width).withColumn("token", token)


def rarest(docs_words: DataFrame, windows: DataFrame, widths: list[int], shingle: int, scratch: Scratch) -> DataFrame:
    """The windows with their rarest shingle (its token and offset)."""
    parts = scratch.write(_offsets(windows, shingle), "parts")
    tokens = scratch.write(parts.select("token").distinct(), "tokens")
    n = math.ceil(tokens.count() / BLOCK_SHINGLES)
    where = _positions(docs_words, widths, False).select("token")
    counted = [where.join(F.broadcast(b), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")) for b in _blocks(tokens, F.col("token"), n)]
    counts = scratch.write(reduce(DataFrame.union, counted), "counts")
    ranked = parts.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    # A window with a shingle that no document has is nowhere.
    return ranked.groupBy("win", "size", "gid").agg(F.min(F.struct("n", "token", "o")).alias("r")).where("r.n > 0").select("win", "size", "gid", "r.token", "r.o")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document: the id, ``text_hash``, ``n_words``, ``n_hit``, ``item_ids`` (sorted as
    strings) and ``contaminated``."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    windows, groups = item_windows(items, item_col, item_text, window, scratch)
    sizes = windows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.concat_ws(" ", "win")).cast("long")).alias("bytes"), F.collect_set(F.least(F.col("size"), F.lit(shingle))).alias("widths")).first()
    widths = sorted(sizes["widths"]) or [shingle]
    n_blocks = max(1, math.ceil(sizes["n"] / BLOCK_WINDOWS), math.ceil((sizes["bytes"] or 0) / BLOCK_BYTES))

    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), words_of(F.col(f"`{text}`")).alias("w"))
    index = scratch.write(rarest(read.select("w"), windows, widths, shingle, scratch), "index")

    found = None
    for i, block in enumerate(_blocks(index, F.concat_ws(" ", "win"), n_blocks)):
        places = _positions(read, widths, i == 0)
        start = F.col("p") - F.col("o")
        fits = (start >= 0) & (start + F.col("size") <= F.size("w"))
        same = F.when(fits, F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("size")) == F.col("win"))
        probe = F.broadcast(_with_base(block) if i == 0 else block)
        hits = places.join(probe, "token").where((F.col("p") < 0) & F.col("win").isNull() | (F.col("p") >= 0) & same)
        hits = hits.select("id", "th", F.when(F.col("p") < 0, F.size("w").cast("long")).alias("n_words"), F.when(F.col("p") >= 0, F.struct(start.alias("s"), (start + F.col("size")).alias("e"))).alias("span"), F.when(F.col("p") >= 0, F.col("gid")).alias("gid"))
        found = hits if found is None else found.union(hits)
    per_doc = found.groupBy(F.xxhash64("id").alias("idh"), "th").agg(
        F.min("id").alias("id"), F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"),
        F.sort_array(F.collect_set("span")).alias("spans"), F.collect_set("gid").alias("gids"),
    )
    per_doc = scratch.write(per_doc, "per_doc")
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], x["e"]).alias("end"))
    n_hit = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"].cast("long"))
    names = per_doc.where(F.size("gids") > 0).select("idh", "th", F.explode("gids").alias("gid")).join(groups, "gid").select("idh", "th", F.explode("items").alias("item"))
    names = names.groupBy("idh", "th").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("item_ids"))
    out = per_doc.select("idh", "th", "id", "n_words", "copies", n_hit.alias("n_hit")).join(names, ["idh", "th"], "left")
    return out.select(
        F.col("id").alias(id_col), F.col("th").alias("text_hash"), "n_words", "n_hit",
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")


def _with_base(index: DataFrame) -> DataFrame:
    """The index and a row that meets the place -1 of every document."""
    one = index.sparkSession.range(1).select(F.lit(None).cast("array<string>").alias("win"), F.lit(0).alias("size"), F.lit(-1).cast("long").alias("gid"), F.lit(0).cast("long").alias("token"), F.lit(0).alias("o"))
    return index.unionByName(one)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The input's rows that hold no window of a benchmark item."""
    judged = decontaminate(docs, items, id_col, text, **options)
    bad = judged.where("contaminated").select(F.xxhash64(F.col(id_col)).alias("k1"), F.col("text_hash").alias("k2")).distinct()
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    src = src.select("row", F.xxhash64(F.col("row").getField(id_col)).alias("k1"), F.xxhash64(F.col("row").getField(text)).alias("k2"))
    return src.join(bad, ["k1", "k2"], "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
