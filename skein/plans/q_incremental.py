"""Window starts, dictionary upserts and state versions (INC-*, SET-03/04, JN-04, AGG-09, STR-04)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skein.config import scratch_path
from skein.constants import PROFILE_WINDOW_MS
from skein.functions import encode as E
from skein.functions.text import epoch_ms, r6, tsv_key
from skein.operators import features as FT
from skein.operators import incremental as INC
from skein.plans import common as C
from skein.plans.oracle_ctes import LAST, enc, idx_str, no_null, r6 as R6, sql, vsum
from skein.plans.registry import query
from skein.plans.scenario import Scenario
from skein.sinks import store as ST
from skein.sinks.keyed import KeyedTable
from skein.sources import fixtures as fx
from skein.sources import profiles as P

W = PROFILE_WINDOW_MS


def _ms(ts: dt.datetime) -> int:
    return int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


BATCH_MS, LAST_MS = _ms(fx.BATCH_TS), _ms(fx.LAST_TS)


@query("start_ms", sql(f"""
SELECT event_id, target_ms, last_ms,
  CASE WHEN target_ms <= {W} THEN 0 WHEN last_ms < 0 OR target_ms - last_ms > {W} THEN target_ms - {W} ELSE last_ms END AS start_ms
FROM refresh_pairs""", "refresh_pairs"))
def start_ms(spark, d):
    """INC-00: start of the profile window from (target, last) times."""
    p = fx.refresh_pairs(spark, d)
    return p.select("event_id", "target_ms", "last_ms", INC.start_ms(F.col("target_ms"), F.col("last_ms")).alias("start_ms"))


@query("periodic_refresh", sql("""
SELECT event_id, last_ms < 0 OR target_ms - last_ms >= 3600000 AS refresh FROM refresh_pairs""", "refresh_pairs"))
def periodic_refresh(spark, d):
    """STR-04: reload profiles when ``batch − last >= interval`` (first batch always)."""
    from skein.streaming.recommend import refresh_due
    p = fx.refresh_pairs(spark, d)
    return p.select("event_id", refresh_due(F.col("target_ms"), F.col("last_ms"), 3_600_000).alias("refresh"))


USER_VALID = "user_seq_id IS NOT NULL AND user_seq_id <> '' AND " + no_null("custom_categories")


@query("user_dict_upsert", sql(f"""
WITH coll AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_seq_id ORDER BY updated_at DESC) AS rn
              FROM (SELECT * FROM user_profile UNION ALL SELECT * FROM user_profile_v2)) WHERE rn = 1),
upd AS (SELECT user_seq_id, {enc('custom_categories')} AS cat FROM coll WHERE updated_at > {LAST} AND {USER_VALID}),
old AS (SELECT user_seq_id, {enc('custom_categories')} AS cat FROM user_profile WHERE {USER_VALID})
SELECT user_seq_id, {idx_str('cat')} AS category_idx FROM upd
UNION ALL SELECT user_seq_id, {idx_str('cat')} FROM old WHERE user_seq_id NOT IN (SELECT user_seq_id FROM upd)""",
    "user_profile", "user_profile_v2"))
def user_dict_upsert(spark, d):
    """INC-01: rescan users updated since the last refresh and upsert them into the dictionary."""
    old = P.user_categories_since(fx.user_profile(spark, d), None)
    start = INC.user_dict_start(BATCH_MS, LAST_MS, dict_empty=False)
    now = P.latest_per_key(fx.user_profile(spark, d).unionByName(fx.user_profile_v2(spark, d)), "user_seq_id", "updated_at")
    upd = P.user_categories_since(now, start)
    out = INC.upsert(old.select("user_seq_id", "category_idx"), upd.select("user_seq_id", "category_idx"), "user_seq_id")
    return out.select("user_seq_id", E.idx_string("category_idx").alias("category_idx"))


def _article_dict(spark, d, fields, inclusive, since_old, last, start):
    """The dictionary at ``last`` and the rescan from ``start``, each article by its latest crawl."""
    a = fx.art_crawls(spark, d)
    scan = lambda since: P.scan_profiles(a, fields + ["crawled_at"], since=since, inclusive=inclusive)
    old = scan(since_old).where(F.col("crawled_at") <= F.lit(last).cast("timestamp_ntz"))
    return INC.upsert(P.latest_per_key(old, "article_seq_id", "crawled_at"), scan(start), "article_seq_id", "crawled_at")


def _dict_sql(select_cols, valid, op, since_old, last, start):
    latest = "QUALIFY row_number() OVER (PARTITION BY article_seq_id ORDER BY crawled_at DESC) = 1"
    return sql(f"""
WITH old AS (SELECT * FROM art_crawls WHERE crawled_at {op} TIMESTAMP '{since_old}' AND crawled_at <= TIMESTAMP '{last}' AND {valid} {latest}),
upd AS (SELECT * FROM art_crawls WHERE crawled_at {op} TIMESTAMP '{start}' AND {valid} {latest})
SELECT {select_cols} FROM upd
UNION ALL SELECT {select_cols} FROM old WHERE article_seq_id NOT IN (SELECT article_seq_id FROM upd)""", "art_crawls")


CAT_VALID = no_null("category") + " AND article_seq_id <> ''"
CAT = f"{idx_str(enc('category'))} AS category_idx"


def _vec_sql(name):
    p = name.split("_")[0]
    return f"CAST(len({name}) AS BIGINT) AS {p}_n, {vsum(name)} AS {p}_sum"


def _vec(name):
    c = F.col(name)
    p = name.split("_")[0]
    return [F.size(c).cast("bigint").alias(f"{p}_n"), r6(F.aggregate(c, F.lit(0.0), lambda a, x: a + x)).alias(f"{p}_sum")]


# INC-02 runs with a previous refresh four days back: the gap rule restarts the window.
INC02_LAST = dt.datetime(2024, 1, 27)


@query("category_dict_upsert", _dict_sql("article_seq_id, " + CAT, CAT_VALID, ">", "2024-01-24 00:00:00",
                                         "2024-01-27 00:00:00", "2024-01-28 00:00:00"))
def category_dict_upsert(spark, d):
    """INC-02: gap over the window -> rescan from batch − 3 days, upsert category vectors."""
    start = INC.article_dict_start(BATCH_MS, _ms(INC02_LAST), dict_empty=False)
    out = _article_dict(spark, d, ["category"], False, dt.datetime(2024, 1, 24), INC02_LAST, start)
    return out.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"))


V3 = f"{CAT_VALID} AND {no_null('text_vector')} AND {no_null('title_vector')}"


@query("profile3_dict_upsert", _dict_sql(f"article_seq_id, {CAT}, {_vec_sql('text_vector')}, {_vec_sql('title_vector')}",
                                         V3, ">=", "2024-01-26 00:00:00", "2024-01-29 00:00:00", "2024-01-29 00:00:00"))
def profile3_dict_upsert(spark, d):
    """INC-03: start from INC-00, inclusive scan of text/title/category, upsert."""
    start = INC.profile_start(BATCH_MS, LAST_MS)
    out = _article_dict(spark, d, ["text_vector", "title_vector", "category"], True, dt.datetime(2024, 1, 26), fx.LAST_TS, start)
    return out.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"), *_vec("text_vector"),
                      *_vec("title_vector"))


V2 = f"article_seq_id <> '' AND {no_null('text_vector')} AND {no_null('title_vector')}"


@query("profile2_dict_upsert", _dict_sql(f"article_seq_id, {_vec_sql('text_vector')}, {_vec_sql('title_vector')}",
                                         V2, ">=", "2024-01-26 00:00:00", "2024-01-29 00:00:00", "2024-01-29 00:00:00"))
def profile2_dict_upsert(spark, d):
    """INC-04: start as INC-02, inclusive scan of text and title vectors, upsert."""
    start = INC.article_dict_start(BATCH_MS, LAST_MS, dict_empty=False)
    out = _article_dict(spark, d, ["text_vector", "title_vector"], True, dt.datetime(2024, 1, 26), fx.LAST_TS, start)
    return out.select("article_seq_id", *_vec("text_vector"), *_vec("title_vector"))


V1 = f"article_seq_id <> '' AND {no_null('text_vector')}"


@query("text_dict_upsert", _dict_sql(f"article_seq_id, {_vec_sql('text_vector')}", V1, ">=", "2024-01-26 00:00:00",
                                     "2024-01-29 00:00:00", "2024-01-29 00:00:00"))
def text_dict_upsert(spark, d):
    """INC-05: start as INC-02, inclusive scan of text vectors, upsert."""
    start = INC.article_dict_start(BATCH_MS, LAST_MS, dict_empty=False)
    out = _article_dict(spark, d, ["text_vector"], True, dt.datetime(2024, 1, 26), fx.LAST_TS, start)
    return out.select("article_seq_id", *_vec("text_vector"))


@query("dict_upsert", sql(f"""
WITH old AS (SELECT user_seq_id, updated_at, custom_categories FROM user_profile),
upd AS (SELECT user_seq_id, updated_at, custom_categories FROM user_profile_v2)
SELECT user_seq_id, {idx_str(enc('custom_categories'))} AS category_idx, epoch_ms(updated_at) AS updated_ms FROM upd
UNION ALL SELECT user_seq_id, {idx_str(enc('custom_categories'))}, epoch_ms(updated_at) FROM old
WHERE user_seq_id NOT IN (SELECT user_seq_id FROM upd)""", "user_profile", "user_profile_v2"))
def dict_upsert(spark, d):
    """SET-03: new entries override old ones (union + latest per key)."""
    old = fx.user_profile(spark, d)
    out = INC.upsert(old, fx.user_profile_v2(spark, d), "user_seq_id", order_col="updated_at")
    return out.select("user_seq_id", E.idx_string(E.encode_category(F.col("custom_categories"))).alias("category_idx"),
                      epoch_ms(F.col("updated_at")).alias("updated_ms"))


@query("last_per_key", sql("""
WITH v AS (
  SELECT CAST(doc_id AS VARCHAR) AS key, TIMESTAMP '2024-01-01' + to_hours(CAST((doc_id*37)%720 AS INT)) AS ts, lang AS value FROM documents
  UNION ALL
  SELECT CAST(doc_id AS VARCHAR), TIMESTAMP '2024-01-01' + to_hours(CAST((doc_id*37)%720 AS INT) + 1), 'q'||CAST(quality AS VARCHAR) FROM labels)
SELECT key, epoch_ms(ts) AS ts_ms, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, value DESC) AS rn FROM v) WHERE rn = 1"""))
def last_per_key(spark, d):
    """AGG-09: one value per key — latest time wins, then greatest value (Q5)."""
    out = P.latest_per_key(fx.doc_versions(spark, d), "key", "ts")
    return out.select("key", epoch_ms(F.col("ts")).alias("ts_ms"), "value")


STATE_SQL = sql(f"""
SELECT kind, k1, k2, {R6('weight')} AS weight FROM w2 WHERE kind <> 't' OR weight > 0
UNION ALL SELECT kind, k1, k2, {R6('weight')} FROM state s
WHERE NOT EXISTS (SELECT 1 FROM w2 u WHERE u.kind = s.kind AND u.k1 = s.k1 AND u.k2 = s.k2)""", "w2", "state")


@query("state_snapshot", STATE_SQL)
def state_snapshot(spark, d):
    """INC-06: replace the trained keys, carry over the others, into a new state version."""
    s = Scenario(spark, d)
    snap = INC.snapshot(s.state, s.trained(2, 1.0, 1.0))
    path = INC.write_version(snap, scratch_path(spark, "state"), "state", "1")
    return spark.read.parquet(path).select("kind", "k1", "k2", r6(F.col("weight")).alias("weight"))


def _state_table(spark, s):
    """The scenario's state as a keyed table: base of batch 0."""
    table = KeyedTable(spark, scratch_path(spark, "statetable"), ["kind", "k1", "k2"], s.state.select("kind", "k1", "k2", "weight").schema)
    table.apply(s.state, 0)
    return table


@query("state_deltas", STATE_SQL, own=True)
def state_deltas(spark, d):
    """INC-06 merge-on-read: the batch writes its trained keys as a delta of the bucketed state."""
    s = Scenario(spark, d)
    table = _state_table(spark, s)
    INC.snapshot_delta(table, s.trained(2, 1.0, 1.0), 1)
    return table.read().select("kind", "k1", "k2", r6(F.col("weight")).alias("weight"))


@query("state_lookup", sql(f"SELECT feat, {R6('weight')} AS weight FROM w0", "w0"), own=True)
def state_lookup(spark, d):
    """JN-06/ML-03: the batch's weights from the bucketed state, which is not shuffled."""
    s = Scenario(spark, d)
    found = _state_table(spark, s).lookup(s.batch.symbols())
    return found.select("feat", r6(F.coalesce("weight", F.lit(0.0))).alias("weight"))


@query("dict_deltas", _dict_sql("article_seq_id, " + CAT, CAT_VALID, ">", "2024-01-24 00:00:00",
                                "2024-01-27 00:00:00", "2024-01-28 00:00:00"), own=True)
def dict_deltas(spark, d):
    """INC-02/SET-03 merge-on-read: base, a delta for each of two rescans, folded between them."""
    a = fx.art_crawls(spark, d)
    scan = P.latest_per_key(P.scan_profiles(a, ["category", "crawled_at"], since=dt.datetime(2024, 1, 24)).where(
        F.col("crawled_at") <= F.lit(INC02_LAST).cast("timestamp_ntz")), "article_seq_id", "crawled_at")
    table = KeyedTable(spark, scratch_path(spark, "dicttable"), ["article_seq_id"], scan.schema)
    table.apply(scan, 0)
    start = INC.article_dict_start(BATCH_MS, _ms(INC02_LAST), dict_empty=False)
    new, cut = P.scan_profiles(a, ["category", "crawled_at"], since=start), F.lit(dt.datetime(2024, 1, 30)).cast("timestamp_ntz")
    INC.upsert_delta(table, new.where(F.col("crawled_at") <= cut), 1, "crawled_at")
    table.compact()
    INC.upsert_delta(table, new.where(F.col("crawled_at") > cut), 2, "crawled_at")
    return table.read().select("article_seq_id", E.idx_string("category_idx").alias("category_idx"))


@query("keep_untouched", sql(f"""
SELECT "user"||chr(9)||CAST(c AS VARCHAR)||chr(9)||CAST(weight AS VARCHAR) AS value FROM st_user
WHERE "user" NOT IN (SELECT "user" FROM inst)""", "st_user", "inst"))
def keep_untouched(spark, d):
    """JN-04: old state lines whose key (first TSV field) this batch did not update."""
    lines = ST.state_lines(fx.state_user_inferred(spark, d), ["user", "c", "weight"])
    touched = C.instances(spark, d).select(F.col("user").alias("key"))
    return INC.keep_untouched(lines.withColumn("key", tsv_key(F.col("value"))), touched, "key").select("value")


@query("generation_union", sql(f'SELECT "user", CAST(c AS BIGINT) AS c, {R6("weight")} AS weight FROM st_user', "st_user"))
def generation_union(spark, d):
    """SET-04: a ``prefix*`` read brings the update and keep parts of a state together."""
    root = scratch_path(spark, "gen")
    users = fx.state_user_inferred(spark, d)
    touched = C.instances(spark, d).select("user").distinct()
    ST.save_lines(ST.state_lines(users.join(touched, "user", "left_semi"), ["user", "c", "weight"]),
                  f"{root}/user_inferred_update")
    ST.save_lines(ST.state_lines(users.join(touched, "user", "left_anti"), ["user", "c", "weight"]),
                  f"{root}/user_inferred_keep")
    parts = F.split(F.col("value"), "\t")
    return ST.read_lines(spark, f"{root}/user_inferred*").select(
        parts[0].alias("user"), parts[1].cast("bigint").alias("c"), r6(parts[2].cast("double")).alias("weight"))
