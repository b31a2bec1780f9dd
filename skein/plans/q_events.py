"""Event parsing, instances, user actions (EV-*, PRJ-04/05/06/11, FN-07..09, SET-01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import events as EV
from skein.functions.text import strip_pair_line
from skein.operators import instances as I
from skein.plans import common as C
from skein.plans.oracle_ctes import sql
from skein.plans.registry import query
from skein.sources import fixtures as fx


@query("parse_instances", sql('SELECT "user", item, label FROM inst', "inst"))
def parse_instances(spark, d):
    """EV-01: event lines -> (user, item, label)."""
    return C.instances(spark, d)


@query("parse_instances_plus", sql(
    'SELECT "user", item, label, unnest(custom_categories) AS custom_category FROM inst_plus', "inst_plus"))
def parse_instances_plus(spark, d):
    """EV-02: instances with one row per custom category."""
    df = I.parse_instances_plus(fx.lines(spark, d), fx.LANG)
    return df.select("user", "item", "label", F.explode_outer("custom_categories").alias("custom_category"))


@query("parse_instances_pair", sql('SELECT "user", item, label FROM inst', "inst"))
def parse_instances_pair(spark, d):
    """EV-03: instances from ``(null,<json>)`` pair lines."""
    return I.parse_instances_pair(fx.pair_lines(spark, d), fx.LANG)


@query("parse_user_actions", sql(
    "SELECT event_id, user_seq_id, version, CAST(len(CAST(line->'$.custom_categories' AS VARCHAR[])) AS BIGINT) AS n_custom "
    "FROM act", "act"))
def parse_user_actions(spark, d):
    """EV-04: (user_seq_id, version, custom categories) of user-action lines."""
    df = I.parse_user_actions(fx.actions(spark, d))
    return df.select("event_id", "user_seq_id", "version", F.size("custom_categories").cast("bigint").alias("n_custom"))


@query("prefilter_contains", sql("SELECT event_id, line FROM lines WHERE line LIKE '%user_seq_id%'", "lines"))
def prefilter_contains(spark, d):
    """PRJ-04: lines that mention ``user_seq_id``."""
    return I.prefilter(fx.lines(spark, d))


@query("filter_events", sql(
    "SELECT event_id, CASE WHEN is_read THEN 'read' ELSE 'refresh' END AS kind, CAST(user_seq_id AS BIGINT) AS user_seq_id "
    "FROM ev_ok", "ev_ok"))
def filter_events(spark, d):
    """PRJ-05: reads from main/hot/trending and online article refreshes, in the language."""
    ev = I.filtered_events(fx.lines(spark, d), fx.LANG)
    return ev.select("event_id", "kind", F.col("p.user_seq_id").cast("bigint").alias("user_seq_id"))


@query("version_filter", sql(
    "SELECT event_id, user_seq_id FROM act WHERE version = 'v1' OR version IS NULL", "act"))
def version_filter(spark, d):
    """PRJ-06: keep actions of the served model version, or without a version."""
    df = I.version_filter(I.parse_user_actions(fx.actions(spark, d)), fx.USER_FILTER)
    return df.select("event_id", "user_seq_id")


@query("explode_impressions", sql(
    "SELECT event_id, CAST(user_seq_id AS BIGINT) AS user_seq_id, "
    "CAST(unnest(CAST(line->'$.article_seq_id' AS INT[])) AS BIGINT) AS article_seq_id FROM ev_ok WHERE NOT is_read",
    "ev_ok"))
def explode_impressions(spark, d):
    """PRJ-11: an accepted refresh becomes one row per listed article."""
    df = I.explode_impressions(fx.lines(spark, d), fx.LANG)
    return df.select("event_id", F.col("user_seq_id").cast("bigint").alias("user_seq_id"),
                     F.col("article_seq_id").cast("bigint").alias("article_seq_id"))


@query("json_parse", sql(
    "SELECT event_id, CASE WHEN is_read THEN 'read' ELSE 'refresh' END AS kind, "
    "CAST(line->>'$.user_seq_id' AS BIGINT) AS user_seq_id, line->>'$.lang' AS lang, "
    "CAST(line->>'$.ts' AS BIGINT) AS ts, line->>'$.source' AS source, line->>'$.req_mode' AS req_mode, "
    "CAST(CASE WHEN is_read THEN 1 ELSE len(CAST(line->'$.article_seq_id' AS INT[])) END AS BIGINT) AS n_articles "
    "FROM ev", "ev"))
def json_parse(spark, d):
    """FN-07: typed parse of every user line, by the kind rule."""
    df = I.parse_events(I.prefilter(fx.lines(spark, d)))
    return df.select(
        "event_id", "kind", F.col("p.user_seq_id").cast("bigint").alias("user_seq_id"),
        F.col("p.lang").alias("lang"), F.col("p.ts").cast("bigint").alias("ts"),
        F.col("p.source").alias("source"), F.col("p.req_mode").alias("req_mode"),
        F.size("p.articles").cast("bigint").alias("n_articles"),
    )


@query("strip_pair_line", sql("SELECT event_id, line FROM lines", "lines"))
def strip_pair(spark, d):
    """FN-08: ``(null,<json>)`` -> ``<json>``."""
    return fx.pair_lines(spark, d).select("event_id", strip_pair_line(F.col("line")).alias("line"))


@query("event_ts", sql(
    "SELECT event_id, coalesce(CAST(line->>'$.ts' AS BIGINT), 0) AS ts FROM lines", "lines"))
def event_ts(spark, d):
    """FN-09: ``ts`` of either event kind from a pair line (no user prefilter)."""
    p = fx.pair_lines(spark, d)
    return p.select("event_id", EV.event_ts(strip_pair_line(F.col("line"))).cast("bigint").alias("ts"))


@query("event_union", sql(
    "SELECT topic, event_id, line FROM topic_lines WHERE topic = 'impression' "
    "UNION ALL SELECT topic, event_id, line FROM topic_lines WHERE topic = 'click'", "topic_lines"))
def event_union(spark, d):
    """SET-01: impressions ∪ clicks, duplicates kept."""
    t = fx.lines_with_topic(spark, d)
    return t.where(F.col("topic") == "impression").unionByName(t.where(F.col("topic") == "click")).select(
        "topic", "event_id", "line")


@query("distinct_users", sql('SELECT DISTINCT "user" FROM inst', "inst"))
def distinct_users(spark, d):
    """AGG-02: distinct users of the instances."""
    return C.instances(spark, d).select("user").distinct()


@query("distinct_items", sql("SELECT DISTINCT item FROM inst", "inst"))
def distinct_items(spark, d):
    """AGG-02: distinct items of the instances."""
    return C.instances(spark, d).select("item").distinct()


@query("line_routes", sql("""
SELECT t.event_id, CASE WHEN whole NOT LIKE '%user_seq_id%' THEN 'skipped' WHEN t.event_id%11=0 THEN 'rejected'
    WHEN o.event_id IS NULL THEN 'skipped' ELSE 'instances' END AS "out",
  CASE WHEN whole LIKE '%user_seq_id%' AND t.event_id%11=0 THEN CASE WHEN whole LIKE '%source%' THEN 'read' ELSE 'refresh' END END AS reason,
  CAST(CASE WHEN o.event_id IS NULL OR t.event_id%11=0 THEN 0 WHEN o.is_read THEN 1
    ELSE len(CAST(o.line->'$.article_seq_id' AS INT[])) END AS BIGINT) AS n_items
FROM torn t LEFT JOIN ev_ok o ON o.event_id = t.event_id""", "torn", "ev_ok"), own=True)
def line_routes(spark, d):
    """STR-01: where each line goes (instances, rejected, skipped), torn lines among them."""
    r = I.routed_lines(fx.torn_lines(fx.lines(spark, d)), fx.LANG)
    return r.select("event_id", "out", "reason", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"))
