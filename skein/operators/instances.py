"""Event lines -> labelled (user, item, label) instances (EV-01..04, PRJ-04/05/11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.constants import READ_SOURCES, REFRESH_ARTICLE_TYPE, REFRESH_REQ_MODE
from skein.functions import events as EV
from skein.functions.text import strip_pair_line


def keep_where(df: DataFrame, cond: Column) -> DataFrame:
    """Filter on a condition over expensive columns (parsed JSON) without a pushable Filter.

    A plain ``where`` is pushed below the projection that parses (and below a spreading
    repartition), so the parser would run twice, the first time in the scan task. Here
    the condition feeds an outer generator and the filter reads the generator's output,
    which the optimizer cannot push below it.
    """
    gen = F.explode_outer(F.when(cond, F.array(F.lit(True)))).alias("__keep")
    return df.select("*", gen).where(F.col("__keep")).drop("__keep")


def prefilter(lines: DataFrame, col: str = "line") -> DataFrame:
    """Keep lines that mention ``user_seq_id`` (PRJ-04)."""
    return lines.where(F.col(col).contains("user_seq_id"))


def parse_events(lines: DataFrame, col: str = "line") -> DataFrame:
    """One parsed row per line: kind, the parse its kind selects, and a corrupt flag (FN-07).

    Each line is parsed once, into its own projection; fields are read from that
    struct afterwards, so the JSON parser does not run once per extracted field.
    """
    line = F.col(col)
    is_read = EV.is_read(line)
    keep = [c for c in lines.columns if c != col]
    parsed = lines.select(
        *keep, col, F.when(is_read, "read").otherwise("refresh").alias("kind"),
        F.when(is_read, EV.parse_read(line)).alias("r"),
        F.when(~is_read, EV.parse_refresh(line)).alias("f"),
    )
    r, f = F.col("r"), F.col("f")

    def pick(name, read_val, refresh_val):
        return F.when(F.col("kind") == "read", read_val).otherwise(refresh_val).alias(name)

    p = F.struct(
        pick("user_seq_id", r["user_seq_id"], f["user_seq_id"]),
        pick("articles", F.array(r["article_seq_id"]), f["article_seq_id"]),
        pick("article_type", r["article_type"], f["article_type"]),
        pick("lang", r["lang"], f["lang"]),
        pick("ts", r["ts"], f["ts"]),
        pick("source", r["source"], F.lit(None).cast("string")),
        pick("req_mode", F.lit(None).cast("string"), f["req_mode"]),
        pick("custom_categories", r["custom_categories"], f["custom_categories"]),
        pick("corrupt", r[EV.CORRUPT], f[EV.CORRUPT]),
    )
    return parsed.select(*keep, col, "kind", p.alias("p"))


def _accepted(lang: str) -> Column:
    p = F.col("p")
    read_ok = (p["lang"] == lang) & p["source"].isin(*READ_SOURCES)
    refresh_ok = (p["lang"] == lang) & (p["article_type"] == REFRESH_ARTICLE_TYPE) & (p["req_mode"] == REFRESH_REQ_MODE)
    return F.coalesce(F.when(F.col("kind") == "read", read_ok).otherwise(refresh_ok), F.lit(False))


def filtered_events(lines: DataFrame, lang: str, col: str = "line") -> DataFrame:
    """Parsed events that pass the kind's filter (PRJ-05); corrupt lines excluded."""
    parsed = parse_events(prefilter(lines, col), col)
    return keep_where(parsed, F.col("p.corrupt").isNull() & _accepted(lang))


def rejected_events(lines: DataFrame, col: str = "line") -> DataFrame:
    """Lines that fail their kind's schema (Q2, Q3): the strict reference would fail the job."""
    parsed = parse_events(prefilter(lines, col), col)
    return parsed.where(F.col("p.corrupt").isNotNull()).select(*[c for c in lines.columns], "kind")


def routed_lines(lines: DataFrame, lang: str, col: str = "line") -> DataFrame:
    """Every line once, with where it goes: ``out`` is ``instances`` (accepted, ``items`` holds its
    articles, perhaps none), ``rejected`` (fails its kind's schema, ``reason`` names the kind) or
    ``skipped`` (no user line, or well formed but not this model's; null lines too). One parse a line."""
    ev = parse_events(lines, col)
    p, user = F.col("p"), F.coalesce(F.col(col).contains("user_seq_id"), F.lit(False))
    out = F.when(~user, "skipped").when(p["corrupt"].isNotNull(), "rejected").when(_accepted(lang), "instances").otherwise("skipped")
    taken = F.col("out") == "instances"
    return ev.withColumn("out", out).select(
        *lines.columns, "out", F.when(F.col("out") == "rejected", F.col("kind")).alias("reason"),
        F.when(taken, F.coalesce(p["user_seq_id"], F.lit(0)).cast("string")).alias("user"),
        F.when(taken, F.coalesce(F.transform(p["articles"], lambda a: F.coalesce(a, F.lit(0)).cast("string")), F.array().cast("array<string>"))).alias("items"),
        F.when(taken, F.when(F.col("kind") == "read", 1.0).otherwise(0.0)).alias("label"))


def _instances(lines: DataFrame, lang: str, col: str, plus: bool, strict: bool = False) -> DataFrame:
    # Accepted lines keep their article list, others an empty one; the explode then drops
    # them. No Filter references the parsed struct, so the optimizer cannot push a copy of
    # the JSON parse below the projection that computes it (the parse runs once per line).
    ev = parse_events(prefilter(lines, col), col)
    ok = F.col("p.corrupt").isNull() & _accepted(lang)
    items = F.when(ok, F.transform("p.articles", lambda a: F.struct(a.alias("a"))))
    if strict:
        bad = F.raise_error(F.concat(F.lit("malformed event line: "), F.col(col)))
        items = F.when(F.col("p.corrupt").isNotNull(), bad.cast("array<struct<a:int>>")).otherwise(items)
    label = F.when(F.col("kind") == "read", F.lit(1.0)).otherwise(F.lit(0.0))
    # Refreshes fan out to one instance per listed article; an empty list gives none (PRJ-11).
    # An outer explode: a plain one makes the optimizer infer size(items) > 0 and push it,
    # with the parse, below the projection.
    out = ev.select(
        F.coalesce(F.col("p.user_seq_id"), F.lit(0)).cast("string").alias("user"),
        F.explode_outer(items).alias("item_s"),
        label.alias("label"),
        F.col("p.custom_categories").alias("custom_categories"),
    ).where(F.col("item_s").isNotNull()).select(
        "user", F.coalesce(F.col("item_s.a"), F.lit(0)).cast("string").alias("item"), "label", "custom_categories")
    if plus:
        return out
    return out.drop("custom_categories")


def parse_instances(lines: DataFrame, lang: str, col: str = "line", strict: bool = False) -> DataFrame:
    """(user STRING, item STRING, label DOUBLE) — EV-01. A malformed line is left out (see
    ``rejected_events``); ``strict`` fails the job on it, as the original does (Q2)."""
    return _instances(lines, lang, col, plus=False, strict=strict)


def parse_instances_plus(lines: DataFrame, lang: str, col: str = "line") -> DataFrame:
    """Instances with their custom categories (EV-02)."""
    return _instances(lines, lang, col, plus=True)


def parse_instances_pair(pair_lines: DataFrame, lang: str, col: str = "line") -> DataFrame:
    """Instances from ``(null,<json>)`` lines (EV-03)."""
    return parse_instances(pair_lines.withColumn(col, strip_pair_line(F.col(col))), lang, col)


def explode_impressions(lines: DataFrame, lang: str, col: str = "line") -> DataFrame:
    """Accepted refreshes, one row per listed article (PRJ-11)."""
    ev = filtered_events(lines, lang, col).where(F.col("kind") == "refresh")
    keep = [c for c in lines.columns if c != col]
    return ev.select(*keep, F.col("p.user_seq_id").alias("user_seq_id"), F.explode("p.articles").alias("article_seq_id"))


def parse_user_actions(lines: DataFrame, col: str = "line") -> DataFrame:
    """(user_seq_id, version, custom_categories) of action lines (EV-04)."""
    p = EV.parse_action(F.col(col))
    keep = [c for c in lines.columns if c != col]
    return keep_where(lines.select(*keep, p.alias("a")), F.col(f"a.{EV.CORRUPT}").isNull()).select(
        *keep, F.col("a.user_seq_id").cast("string").alias("user_seq_id"),
        F.col("a.version").alias("version"), F.col("a.custom_categories").alias("custom_categories"),
    )


def version_filter(actions: DataFrame, version: str) -> DataFrame:
    """``version = x OR version IS NULL`` (PRJ-06)."""
    return keep_where(actions, (F.col("version") == version) | F.col("version").isNull())


def active_users(action_lines: DataFrame, version: str, col: str = "line") -> DataFrame:
    """Distinct users of one batch of actions (STR-02's body)."""
    return version_filter(parse_user_actions(action_lines, col), version).select(
        F.col("user_seq_id").alias("user")).distinct()
