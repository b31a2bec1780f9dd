"""The ``opN_*`` queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import configure
from skein.llm import (
    byte_bpe, collocations, decontaminate, piece_bpe, quality_knn, quality_rules, recompress, sharding, simhash_cover, source_divergence,
    token_store, url_rules, warc_bundle,
)
from skein.llm.common import field, table

SHARDS = 16
THRESHOLD = 0.7


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents by the hash tree, and with one more shard."""
    tree = sharding.default_tree(SHARDS)
    out = sharding.assign(table(spark, sf_dir, "documents"), tree, sharding.grown(tree, SHARDS))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    read = token_store.store(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_rules.judge(table(spark, sf_dir, "pages"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    scored = quality_knn.score(docs, quality_knn.train(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 35 words removed from all documents."""
    done = recompress.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(field("doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules on all documents."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(field("doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = simhash_cover.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the rank file, and what they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern, decoded=True)
    return both.select(
        field("doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of all pages, read back from the bundles."""
    records, _ = warc_bundle.archive(table(spark, sf_dir, "pages"))
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents, and what they decode to."""
    both = piece_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return both.select(
        field("doc_id").alias("doc_id"), F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each lang differ in their terms."""
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most bound phrases of each lang."""
    return collocations.phrases(table(spark, sf_dir, "documents"))


def _ready(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir.rstrip("/"))

    run.__doc__ = fn.__doc__
    return run


QUERIES = {
    "op1_hash_tree_shards": _ready(_op1),
    "op2_token_dac": _ready(_op2),
    "op3_decontaminate": _ready(_op3),
    "op4_url_rules": _ready(_op4),
    "op5_quality_knn": _ready(_op5),
    "op6_recompress": _ready(_op6),
    "op7_quality_rules": _ready(_op7),
    "op8_simhash_cover": _ready(_op8),
    "op9_byte_bpe": _ready(_op9),
    "op10_warc_bundles": _ready(_op10),
    "op11_piece_bpe": _ready(_op11),
    "op12_source_divergence": _ready(_op12),
    "op13_collocations": _ready(_op13),
}

_UP, _LOW = decontaminate.UPPER, decontaminate.LOWER
_SPACE = r"[^\x20\x09-\x0D]+"


def _kept_sql() -> str:
    """The rule table as SQL."""
    out = []
    for _, ratio, compare, bound, fewest in quality_rules.RULES:
        a, b = (x.strip() for x in ratio.split("/"))
        holds = f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0) {compare} {bound}, true)"
        out.append(f"({holds} OR n_words < {fewest})" if fewest else holds)
    return " AND ".join(out)


_STOP = ", ".join(f"'{v}'" for s in quality_rules.STOP_WORDS for v in (s, s.capitalize()))

ORACLE = {
    "op3_decontaminate": f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{decontaminate.WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{decontaminate.WORD}') AS w FROM benchmark),
bw AS (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
iw AS MATERIALIZED (SELECT DISTINCT item_id, l, array_to_string(w[i + 1 : i + l], ' ') AS win FROM bw),
ls AS (SELECT DISTINCT l FROM iw),
dp AS (SELECT rid, w, l, unnest(range(0, len(w) - l + 1)) AS s FROM d, ls WHERE len(w) >= l),
hit AS MATERIALIZED (SELECT rid, item_id, s, iw.l AS l FROM (SELECT rid, l, s, array_to_string(w[s + 1 : s + l], ' ') AS win FROM dp) AS dw JOIN iw ON dw.l = iw.l AND dw.win = iw.win),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + l)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)""",
    "op6_recompress": f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w FROM documents),
p AS MATERIALIZED (SELECT rid, i, array_to_string(w[i + 1 : i + 35], ' ') AS win FROM (SELECT rid, w, unnest(range(0, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT win FROM p GROUP BY win HAVING count(*) > 1),
gone AS MATERIALIZED (SELECT DISTINCT rid, q FROM (SELECT rid, unnest(range(i, i + 35)) AS q FROM p JOIN twice USING (win))),
words AS (SELECT rid, unnest(range(0, len(w))) AS q, unnest(w) AS x FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t FROM words ANTI JOIN gone USING (rid, q) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)""",
    "op7_quality_rules": f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACE}')) AS lines FROM documents),
g AS (SELECT rid, i, array_to_string(w[i + 1 : i + 5], ' ') AS win FROM (SELECT rid, w, unnest(range(0, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS q FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g) WHERE n > 1) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words
  FROM d LEFT JOIN r USING (rid)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_kept_sql()} AS kept FROM f""",
    "op10_warc_bundles": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha1(h) AS digest FROM p),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS best FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN best <> page_id THEN best END AS refers_to
FROM r""",
    "op12_source_divergence": f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS MATERIALIZED (SELECT lang, source, term, rid, count(*) AS n FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n) AS nl FROM o GROUP BY ALL HAVING count(*) >= {source_divergence.DOCUMENTS}),
l AS (SELECT lang, count(*) AS v, sum(nl) AS tl FROM k GROUP BY ALL),
c AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS t FROM c GROUP BY ALL),
g AS MATERIALIZED (SELECT lang, source, coalesce(t, 0) AS t FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN t USING (lang, source)),
s AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1))::HUGEINT // (g.t + l.v)::HUGEINT AS p,
    1 + (1000000000 * (k.nl + 1))::HUGEINT // (l.tl + l.v)::HUGEINT AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM s WHERE n > 0 AND p > q),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM s AS a JOIN s AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) AS x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
r AS (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms QUALIFY rank <= {source_divergence.RANKS}
  UNION ALL SELECT lang, source, 'pair', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM pairs)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r""",
    "op13_collocations": f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[.,;:!?\\x0A-\\x0D]') AS ps FROM documents),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT lang, unnest(ps) AS piece FROM d)),
g AS (SELECT lang, k, array_to_string(w[i + 1 : i + k], ' ') AS phrase, any_value(w[i + 1 : i + k]) AS ws, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM p, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE len(w) >= k) GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT * FROM g WHERE f >= {collocations.LEAST}),
cuts AS (SELECT lang, phrase, k, f, c, array_to_string(ws[1:c], ' ') AS x, array_to_string(ws[c + 1 : k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.k, cuts.f AS a, a.f AS l, b.f AS r, 2000000::HUGEINT * cuts.f // (a.f + b.f) AS score, c
  FROM cuts JOIN f AS a ON a.lang = cuts.lang AND a.phrase = x AND a.k = c JOIN f AS b ON b.lang = cuts.lang AND b.phrase = y AND b.k = cuts.k - c),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (SELECT lang, array_to_string(ws[i + 1 : i + m], ' ') AS phrase, max(f) AS over FROM (SELECT *, unnest(range(0, k - m + 1)) AS i FROM f, (VALUES (2), (3)) AS ms(m) WHERE m < k) GROUP BY 1, 2),
kept AS (SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase) WHERE over IS NULL OR 100 * over < {collocations.SHARE} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= {collocations.TOP}""",
}
