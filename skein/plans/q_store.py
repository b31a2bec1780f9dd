"""Model-store formats, dumps, publishing and keys (SRC-18..24, SNK-*, TOP-03, AGG-05/06, FN-14..16)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skein.config import scratch_path, store
from skein.functions.text import batch_path, fmt6, key_template, r6, tsv_key
from skein.operators import features as FT
from skein.plans import common as C
from skein.plans.oracle_ctes import fmt6 as F6, r6 as R6, sql
from skein.plans.registry import query
from skein.plans.scenario import Scenario
from skein.sinks import publish as PB
from skein.sinks import store as ST
from skein.sources import fixtures as fx

BATCH_MS = int(fx.BATCH_TS.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
WINDOW_MS = int(fx.WINDOW_START_TS.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def _registry(s: Scenario):
    return FT.feature_registry(s.batch.symbols())


@query("registry_save", sql("SELECT '('||feat||','||CAST(idx AS VARCHAR)||')' AS value FROM registry", "registry"))
def registry_save(spark, d):
    """SNK-01: ``(feat,idx)`` lines sorted by index (what the writer stores)."""
    return ST.registry_lines(_registry(Scenario(spark, d)))


@query("registry_load", sql("SELECT feat, idx FROM registry", "registry"))
def registry_load(spark, d):
    """SRC-22: write the registry lines, read them back and parse them (last comma splits)."""
    path = scratch_path(spark, "registry")
    ST.save_registry(_registry(Scenario(spark, d)), path)
    return ST.load_registry(spark, path)


@query("registry_sorted", sql("SELECT idx, feat FROM registry ORDER BY idx", "registry"))
def registry_sorted(spark, d):
    """TOP-03: the registry ordered by index."""
    return _registry(Scenario(spark, d)).orderBy("idx").select("idx", "feat")


def _indexed_weights(s: Scenario, trained: bool = False):
    w = s.trained(2, 1.0, 1.0) if trained else store(s.initial_weights().select("feat", "weight"), "weights")[0]
    return FT.indexed_weights(s.features(), w, s.batch.buckets)


@query("weights_save", sql(f"SELECT r.idx, {R6('CAST(CAST(w.weight AS FLOAT) AS DOUBLE)')} AS weight "
                           "FROM registry r JOIN w0 w USING (feat)", "registry", "w0"))
def weights_save(spark, d):
    """SNK-02: dense weights with their index, rounded to float as stored."""
    rows = ST.weight_rows(_indexed_weights(Scenario(spark, d)))
    return rows.select("idx", r6(F.col("weight")).alias("weight"))


@query("weights_load", sql(f"SELECT r.idx, {R6('CAST(CAST(w.weight AS FLOAT) AS DOUBLE)')} AS weight "
                           "FROM registry r JOIN w0 w USING (feat)", "registry", "w0"))
def weights_load(spark, d):
    """SRC-23: write dense weights as ``idx<TAB>weight`` and read them back."""
    path = scratch_path(spark, "weights")
    ST.save_weights(_indexed_weights(Scenario(spark, d)), path)
    return ST.load_weights(spark, path).select("idx", r6(F.col("weight")).alias("weight"))


@query("sparse_weights_save", sql(f"""
SELECT r.idx, {R6('CAST(CAST(w.weight AS FLOAT) AS DOUBLE)')} AS weight FROM registry r JOIN w2 w USING (feat)
WHERE CAST(w.weight AS FLOAT) <> 0""", "registry", "w2"))
def sparse_weights_save(spark, d):
    """SNK-03: non-zero trained weights as ``idx<TAB>float`` (4,000,000 rows per file at most)."""
    rows = ST.sparse_rows(_indexed_weights(Scenario(spark, d), trained=True))
    return rows.select("idx", r6(F.col("weight")).alias("weight"))


@query("sparse_weights_load", sql(f"""
SELECT r.idx, {R6('coalesce(CAST(CAST(w.weight AS FLOAT) AS DOUBLE), 0.0)')} AS weight
FROM registry r LEFT JOIN w0 w ON w.feat = r.feat AND CAST(w.weight AS FLOAT) <> 0""", "registry", "w0"))
def sparse_weights_load(spark, d):
    """SRC-24: read sparse weight lines back into a vector of the registry's length (densified)."""
    s = Scenario(spark, d)
    path = scratch_path(spark, "sparse")
    iw = store(_indexed_weights(s), "indexed")[0]
    ST.save_sparse_weights(iw, path)
    length = iw.count()
    return ST.load_sparse_weights(spark, path, length).select("idx", r6(F.col("weight")).alias("weight"))


@query("lines_save", sql('SELECT "user"||chr(9)||item||chr(9)||CAST(label AS VARCHAR) AS value FROM inst', "inst"))
def lines_save(spark, d):
    """SNK-04: instances written as text lines, read back."""
    path = scratch_path(spark, "lines")
    inst = C.instances(spark, d)
    ST.save_lines(inst.select(F.concat_ws("\t", "user", "item", F.col("label").cast("string")).alias("value")), path)
    return ST.read_lines(spark, path)


@query("text_lines", sql("SELECT unnest(string_split(text, chr(10))) AS value FROM documents"))
def text_lines(spark, d):
    """SRC-18: lines of text files (the documents written as text, then read)."""
    path = scratch_path(spark, "docs")
    ST.save_lines(fx.table(spark, d, "documents").select("text"), path, "text")
    return ST.read_lines(spark, path)


@query("profile_dump", sql(f"SELECT CAST(count(*) AS VARCHAR)||' since {WINDOW_MS}' AS value FROM prof", "prof"))
def profile_dump(spark, d):
    """SNK-06: the ``<count> since <start>`` summary of a profile refresh."""
    n = C.window_profiles(spark, d).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.concat(F.col("n").cast("string"), F.lit(f" since {WINDOW_MS}")).alias("value"))


@query("candidate_dump", sql(f"""
SELECT c.item||chr(9)||{F6('c.score')}||chr(9)||string_agg(
  CASE WHEN f.value = 1 THEN f.feat||': '||{F6('coalesce(f.weight,0.0)')} ELSE f.feat||': ('||{F6('coalesce(f.weight,0.0)')}||')' END,
  ', ' ORDER BY f.feat) AS value
FROM cand c JOIN cand_feat f ON f.item = c.item GROUP BY c.item, c.score""", "cand", "cand_feat"))
def candidate_dump(spark, d):
    """SNK-07: ``item<TAB>score<TAB>explanation`` lines of the candidates."""
    c = Scenario(spark, d).candidates(explain=True)
    return c.select(F.concat_ws("\t", "item", fmt6(F.col("score")), "explanation").alias("value"))


@query("rec_feature_dump", sql(f"""
SELECT "user", "user"||chr(10)||string_agg(item||chr(9)||{F6('score')}||chr(9)||explanation, chr(10) ORDER BY rank) AS block
FROM rec GROUP BY "user" """, "rec"))
def rec_feature_dump(spark, d):
    """SNK-08: one block per active user: its items with score and explanation, by rank."""
    return PB.rec_feature_blocks(Scenario(spark, d).recommended(explain=True))


@query("batch_info", sql("""
SELECT 'model_path = '||path AS value FROM (
  SELECT path, row_number() OVER (ORDER BY published_at DESC, path DESC) AS rn FROM model_pointer WHERE model_key = 'model_click')
WHERE rn = 1
UNION ALL SELECT '#user = '||CAST(count(*) AS VARCHAR) FROM active""", "model_pointer", "active"))
def batch_info(spark, d):
    """SNK-09: the model path in use and the number of users of the batch."""
    path = PB.latest_model_path(fx.model_pointer(spark, d)).where(F.col("model_key") == fx.MODEL_KEY)
    n = C.active_users(spark, d).agg(F.count(F.lit(1)).alias("n"))
    return (path.select(F.concat(F.lit("model_path = "), "path").alias("value"))
            .unionByName(n.select(F.concat(F.lit("#user = "), F.col("n").cast("string")).alias("value"))))


EXPIRES = BATCH_MS + fx.EXPIRE_HOURS * 3600 * 1000


@query("rec_publish", sql(f"""
SELECT "user", 'rec:'||"user" AS key, item, rank, score, CAST({EXPIRES} AS BIGINT) AS expires_ms FROM rec
UNION ALL
SELECT "user", 'rec:'||"user", item, CAST(0 AS BIGINT), CAST(0.0 AS DOUBLE), CAST({BATCH_MS} AS BIGINT) FROM rec_log
WHERE "user" NOT IN (SELECT "user" FROM active)""", "rec", "rec_log", "active"))
def rec_publish(spark, d):
    """SNK-10: replace each batch user's published list (old lists of other users stay)."""
    s = Scenario(spark, d)
    old = fx.rec_log(spark, d).select(
        "user", key_template(fx.RESULT_TEMPLATE, F.col("user")).alias("key"), "item", F.lit(0).cast("bigint").alias("rank"),
        F.lit(0.0).alias("score"), F.lit(BATCH_MS).cast("bigint").alias("expires_ms"))
    return PB.publish(old, s.users(), s.recommended(), BATCH_MS, fx.EXPIRE_HOURS, fx.RESULT_TEMPLATE)


@query("kafka_payload", sql(f"""
SELECT "user" AS key, '{{"user":"'||"user"||'","item":"'||item||'","rank":'||CAST(rank AS VARCHAR)||',"score":'||{F6('score')}||'}}' AS value
FROM rec""", "rec"))
def kafka_payload(spark, d):
    """SNK-11: each recommendation serialised to a (key, value) message."""
    return PB.fixed_payload(Scenario(spark, d).recommended(), F.col("user"))


def _ue_lines(s: Scenario):
    return ST.state_lines(s.user_entity_w, ["user", "entity", "weight"])


UE_LINE = '"user"||chr(9)||entity||chr(9)||CAST(weight AS VARCHAR)'


@query("sized_output", sql(f"""
SELECT CAST(sum(length({UE_LINE}) + 1) AS BIGINT) AS total_bytes,
  CAST(1 + floor(sum(length({UE_LINE}) + 1) / 80000000) AS BIGINT) AS n_files FROM st_ue""", "st_ue"))
def sized_output(spark, d):
    """SNK-12: output files for the user-tag state lines: ``1 + total_bytes / 80,000,000``."""
    return ST.sized_output(_ue_lines(Scenario(spark, d)))


@query("total_bytes", sql(f"""
SELECT CAST(coalesce(sum(length("user"||chr(9)||CAST(c AS VARCHAR)||chr(9)||CAST(weight AS VARCHAR)) + 1), 0) AS BIGINT) AS total_bytes
FROM st_user""", "st_user"))
def total_bytes(spark, d):
    """AGG-06: Σ(line length + 1) of the user-category state lines."""
    return ST.total_bytes(ST.state_lines(fx.state_user_inferred(spark, d), ["user", "c", "weight"]))


@query("tsv_key", sql(f"SELECT {UE_LINE} AS value, \"user\" AS key FROM st_ue", "st_ue"))
def tsv_key_q(spark, d):
    """FN-15: key of each ``key<TAB>rest`` state line."""
    return _ue_lines(Scenario(spark, d)).select("value", tsv_key(F.col("value")).alias("key"))


@query("count_rows", sql("""
SELECT (SELECT count(*) FROM prof) AS n_profiles, (SELECT count(*) FROM active) AS n_users,
  (SELECT count(*) FROM inst) AS n_instances""", "prof", "active", "inst"))
def count_rows(spark, d):
    """AGG-05: counts of profiles, active users and instances."""
    a = C.window_profiles(spark, d).agg(F.count(F.lit(1)).alias("n_profiles"))
    n_users = C.active_users(spark, d).agg(F.count(F.lit(1))).scalar()
    n_inst = C.instances(spark, d).agg(F.count(F.lit(1))).scalar()
    return a.select("n_profiles", n_users.alias("n_users"), n_inst.alias("n_instances"))


@query("reclog_lookup", sql('SELECT a."user", l.item FROM active a LEFT JOIN rec_log l ON l."user" = a."user"', "active", "rec_log"))
def reclog_lookup(spark, d):
    """SRC-20: each active user with the items already shown to it."""
    return PB.reclog_lookup(C.active_users(spark, d), fx.rec_log(spark, d))


@query("latest_model_path", sql("""
SELECT model_key, path FROM (SELECT model_key, path,
  row_number() OVER (PARTITION BY model_key ORDER BY published_at DESC, path DESC) AS rn FROM model_pointer) WHERE rn = 1""",
    "model_pointer"))
def latest_model_path(spark, d):
    """SRC-21: newest model path per model key."""
    return PB.latest_model_path(fx.model_pointer(spark, d))


@query("key_template", sql("""SELECT "user", 'rec:'||"user" AS result_key, 'reclog:'||"user" AS reclog_key FROM active""", "active"))
def key_template_q(spark, d):
    """FN-14: printf-style keys of each active user."""
    u = C.active_users(spark, d)
    return u.select("user", key_template(fx.RESULT_TEMPLATE, F.col("user")).alias("result_key"),
                    key_template(fx.RECLOG_TEMPLATE, F.col("user")).alias("reclog_key"))


@query("batch_path", sql("SELECT event_id, 'out/'||strftime(ts, '%Y-%m-%d/%H_%M_%S')||'/rec' AS path FROM events"))
def batch_path_q(spark, d):
    """FN-16: time-formatted batch directories (with a tag)."""
    e = fx.table(spark, d, "events")
    return e.select("event_id", batch_path("out", F.col("ts"), "rec").alias("path"))
