"""Structured Streaming keys: sources, instance stream, per-batch users, micro-batch recommend.

Each query runs its stream with ``availableNow`` over the events file and returns
what the sink wrote, so the result equals the batch twin's (one file = one batch).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.config import scratch_path
from skein.operators import features as FT
from skein.operators import incremental as INC
from skein.operators.instances import active_users
from skein.plans import common as C
from skein.plans.oracle_ctes import sql
from skein.plans.q_store import BATCH_MS
from skein.plans.registry import query
from skein.plans.scenario import Scenario
from skein.sinks import publish as PB
from skein.sources import fixtures as fx
from skein.streaming import instances as SI
from skein.streaming import recommend as SR
from skein.streaming.sources import file_stream, run_available


def _events(spark, d):
    return file_stream(spark, d, "events.parquet", max_files_per_trigger=1)


@query("event_source", sql("SELECT topic, event_id, line FROM topic_lines", "topic_lines"))
def event_source(spark, d):
    """SRC-17: the click and impression topics as line streams (file source stand-in)."""
    ev, n = _events(spark, d), fx.n_documents(spark, d)
    clicks = fx.lines_from_events(ev.where(F.col("event_type") == "click"), n).withColumn("topic", F.lit("click"))
    imps = fx.lines_from_events(ev.where(F.col("event_type") != "click"), n).withColumn("topic", F.lit("impression"))
    out = scratch_path(spark, "topics")
    run_available(imps.unionByName(clicks), f"{out}/_ckpt", sink_path=f"{out}/data")
    return spark.read.parquet(f"{out}/data").select("topic", "event_id", "line")


@query("instance_stream", sql('SELECT "user", item, label FROM inst', "inst"))
def instance_stream(spark, d):
    """STR-01: two topics -> union -> parse -> instances, per micro-batch."""
    ev, n = _events(spark, d), fx.n_documents(spark, d)
    clicks = fx.lines_from_events(ev.where(F.col("event_type") == "click"), n)
    imps = fx.lines_from_events(ev.where(F.col("event_type") != "click"), n)
    out = scratch_path(spark, "inst_stream")
    run_available(SI.instance_stream(imps, clicks, fx.LANG), f"{out}/_ckpt", sink_path=f"{out}/data")
    return spark.read.parquet(f"{out}/data").select("user", "item", "label")


@query("instance_dump", sql('SELECT "user", item, label FROM inst', "inst"))
def instance_dump(spark, d):
    """SNK-05: each micro-batch's instances written below ``yyyy-MM-dd/HH_mm_ss/data/instance``."""
    ev, n = _events(spark, d), fx.n_documents(spark, d)
    inst = SI.instance_stream(fx.lines_from_events(ev.where(F.col("event_type") != "click"), n),
                              fx.lines_from_events(ev.where(F.col("event_type") == "click"), n), fx.LANG)
    out = scratch_path(spark, "inst_dump")
    run_available(inst, f"{out}/_ckpt", batch_fn=SI.dump_instances(f"{out}/dump", lambda: BATCH_MS))
    return spark.read.parquet(f"{out}/dump/*/*/data/instance/*").select("user", "item", "label")


@query("stream_dead_letters", sql("""
SELECT line, CASE WHEN whole LIKE '%source%' THEN 'read' ELSE 'refresh' END AS reason
FROM torn WHERE event_id%11=0 AND whole LIKE '%user_seq_id%'""", "torn"), own=True)
def stream_dead_letters(spark, d):
    """STR-01: malformed lines of the event stream, kept apart in the same write as its instances."""
    root = scratch_path(spark, "routes")
    lines = fx.torn_lines(fx.lines_from_events(_events(spark, d), fx.n_documents(spark, d)))
    run_available(lines.select("line"), f"{root}_ckpt", batch_fn=SI.route_batches(root, fx.LANG))
    return SI.dead_letters(spark, root).select("line", "reason")


@query("active_users_batch", sql('SELECT "user" FROM active', "active"))
def active_users_batch(spark, d):
    """STR-02: parse actions, filter the version, distinct users within each micro-batch."""
    acts = fx.actions_from_events(_events(spark, d))
    out = scratch_path(spark, "users_stream")

    def handle(batch, batch_id):
        active_users(batch, fx.USER_FILTER).write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

    run_available(acts, f"{out}/_ckpt", batch_fn=handle)
    return spark.read.parquet(f"{out}/data").select("user")


@query("recommend_batch", sql('SELECT "user", rank, item, score FROM rec', "rec"))
def recommend_batch(spark, d):
    """STR-03/05: per micro-batch refresh-if-due, rank, exclude shown, top N, publish."""
    s = Scenario(spark, d)
    root = scratch_path(spark, "rec_stream")
    # The state is stored as a model version and published; every batch reads the pointer.
    INC.write_version(s.state.select(*FT.KEY, "weight"), f"{root}/models", fx.MODEL_KEY, "1")
    pointers = f"{root}/pointers"
    PB.publish_model(spark, pointers, fx.MODEL_KEY, f"{root}/models/{fx.MODEL_KEY}/v=1", BATCH_MS)

    def load_model(batch_ms):
        return SR.Model(profiles=C.window_profiles(spark, d, batch_ms), tfidf=C.window_tfidf(spark, d, batch_ms),
                        global_w=s.global_w, user_w=s.user_w, item_w=s.item_w, user_entity_w=s.user_entity_w)

    rec = SR.Recommender(spark, load_model, lambda: fx.rec_log(spark, d), f"{root}/published", fx.USER_FILTER,
                         fx.N_TOP, fx.N_CANDIDATES, fx.ENTITY_SCALAR, interval_ms=3_600_000,
                         expire_hours=fx.EXPIRE_HOURS, result_template=fx.RESULT_TEMPLATE, now_ms=lambda: BATCH_MS,
                         pointers=lambda: spark.read.parquet(pointers), model_key=fx.MODEL_KEY,
                         load_state=lambda path: FT.split_state(spark.read.parquet(path)),
                         dump_root=f"{root}/dump", rounded=True)
    run_available(fx.actions_from_events(_events(spark, d)), f"{root}/_ckpt", batch_fn=rec.handle)
    return rec.current(BATCH_MS).select("user", "rank", "item", "score")
