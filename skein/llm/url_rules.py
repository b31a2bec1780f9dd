"""URL filtering by association rules.

Given rules (host, path, verdict) come first. For the other urls, Spark's FP-growth mines
combinations of url tokens from all urls; rules that conclude a label are pruned by
confidence and support and matched by an inverted index: every rule is listed under its
rarest token, a url looks up its tokens, and a listed rule fires if the url has all its
tokens. Of the firing rules the most confident decides, then the longer, then the better
supported, then block; a url on which none fires is allowed.

Confidence and support are shares of all urls: those without a label are baskets too and
count against every rule whose tokens they have, so a rule holds outside the given rules'
own selection or goes.

The index is one map, a scalar subquery bounded by the support (``index``) and not by the number
of urls; every url is matched in the stage that reads it, so no url is shuffled, however many
share their tokens. All steps are DataFrame operations.

Defined results: null urls and urls without ``://`` have empty host and path, no tokens and
no given rule, and are allowed; equal rows get equal results; without labelled urls no rule
is mined.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict): fits the host and its subdomains if the path starts so.
GIVEN = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
SUPPORT = 0.01
CONFIDENCE = 0.9
WIDTH = 9  # tokens of a url at most
LABEL = "="


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules=GIVEN) -> tuple[Column, Column]:
    """(the longest fitting rule as text, its verdict), null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, top domains, first label, directory, file kind, query."""
    labels = F.split(host, r"\.")
    part = lambda kind, x: F.concat(F.lit(kind + ":"), x)
    where = F.when
    some = host != ""
    folder = F.regexp_extract(path, r"^/([^/]+)/", 1)
    kind = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    every = F.array(
        where(some, part("scheme", F.lower(F.substring_index(url, "://", 1)))),
        where(some, part("top", F.element_at(labels, -1))),
        where(F.size(labels) > 1, part("domain", F.get(labels, F.size(labels) - 2))),
        where(F.size(labels) > 2, part("site", F.get(labels, F.size(labels) - 3))),
        where(F.size(labels) > 2, part("first", F.get(labels, F.lit(0)))),
        where(folder != "", part("dir", folder)),
        where(kind != "", part("kind", kind)),
        where(some & F.contains(url, F.lit("?")), F.lit("query")),
        where(some & F.contains(url, F.lit("#")), F.lit("fragment")),
    )
    return F.sort_array(F.array_distinct(F.filter(every, lambda x: x.isNotNull())))


def mine(labelled: DataFrame, scratch: Scratch, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support, key) from ``labelled(tokens, verdict)``;
    ``key`` is the rule's rarest token. Rows of null verdict are background: they have no
    label and count in every confidence and support."""
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double, key string")
    baskets = scratch.write(labelled.select(F.when(F.isnull("verdict"), F.col("tokens")).otherwise(F.array_append("tokens", F.concat(F.lit(LABEL), "verdict"))).alias("items")), "baskets")
    if baskets.isEmpty():
        return empty
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    verdict = F.get("consequent", F.lit(0))
    found = model.associationRules.where(F.startswith(verdict, F.lit(LABEL)) & ~F.exists("antecedent", lambda x: F.startswith(x, F.lit(LABEL))))
    found = found.select(F.sort_array("antecedent").alias("tokens"), F.substr(verdict, F.lit(2)).alias("verdict"), "confidence", "support")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.get("items", F.lit(0)).alias("token"), "freq")
    rarest = found.select("tokens", "verdict", F.explode("tokens").alias("token")).join(single, "token").groupBy("tokens", "verdict").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    return scratch.write(found.join(rarest, ["tokens", "verdict"]).select("tokens", "verdict", "confidence", "support", "key"), "rules")


def index(rules: DataFrame) -> DataFrame:
    """One row: a map from token to the rules whose rarest token it is.

    Support bounds it: a url has at most ``WIDTH`` tokens, so at most 2^WIDTH sets of them, and
    every rule's set is in a share ``support`` of all urls: at most 2^WIDTH / support rules.
    """
    by_key = rules.groupBy("key").agg(F.collect_list(F.struct("confidence", F.size("tokens").alias("n"), "support", "verdict", "tokens")).alias("rules"))
    return by_key.agg(F.map_from_entries(F.collect_list(F.struct("key", "rules"))).alias("index"))


def match(tokens: Column, found: Column) -> Column:
    """The verdict of the best rule whose tokens are all there (null: none), by the inverted index."""
    rule = "struct<confidence:double,n:int,support:double,verdict:string,tokens:array<string>>"
    none = F.array().cast(f"array<{rule}>")
    met = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(found, t), none)))
    fits = F.filter(met, lambda r: F.size(F.array_except(r["tokens"], tokens)) == 0)
    return F.array_max(F.transform(fits, lambda r: F.struct(r["confidence"], r["n"], r["support"], r["verdict"].alias("verdict"))))["verdict"]


def judge(pages: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url: str = "url", rules=GIVEN, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """id, host, path, rule and verdict of every url.

    ``labelled(url, verdict)``: urls to learn from, those of null verdict as background; by
    default all urls of ``pages``, with the verdicts of the given rules.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = parts(F.col("url"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    read = lambda df: df.select("*", host.alias("host"), path.alias("path")).select("*", tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    seen = read(pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"))).select("id", "host", "path", "tokens", rule.alias("rule"), verdict.alias("given"))
    seen = scratch.write(seen, "seen")
    known = seen.select("tokens", F.col("given").alias("verdict")) if labelled is None else read(labelled.select("url", "verdict")).select("tokens", "verdict")
    out = seen.withColumn("index", index(mine(known, scratch, support, confidence)).scalar())
    mined = F.when(F.isnull("given"), match(F.col("tokens"), F.col("index")))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("given", mined, F.lit("allow")).alias("verdict"))
