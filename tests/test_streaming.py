"""Batch/stream twins and the per-batch distinct of user actions (Q8)."""

import json

import pytest
import os

from pyspark.sql import functions as F

from skein.operators import instances as I
from skein.streaming import instances as SI
from skein.streaming.recommend import active_users


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_same_user_in_two_files_is_active_in_both_batches(spark, tmp_dir):
    src = tmp_dir + "/actions"
    _write(src, "a.txt", [json.dumps({"user_seq_id": 7, "version": "v1"}), json.dumps({"user_seq_id": 8})])
    _write(src, "b.txt", [json.dumps({"user_seq_id": 7, "version": "v1"}), json.dumps({"user_seq_id": 9, "version": "v2"})])
    seen = []

    def handle(batch, batch_id):
        seen.append(sorted(r["user"] for r in active_users(batch.withColumnRenamed("value", "line"), "v1").collect()))

    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)
    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", tmp_dir + "/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(seen) == [["7"], ["7", "8"]]


def test_instance_stream_equals_batch(spark, tmp_dir):
    read = {"user_seq_id": 1, "article_seq_id": 10, "article_type": "article", "lang": "en", "ts": 5,
            "source": "hot", "custom_categories": []}
    refresh = {"user_seq_id": 2, "article_seq_id": [20, 21], "article_type": "article", "lang": "en", "ts": 6,
               "subtype": "x", "req_mode": "online", "custom_categories": []}
    _write(tmp_dir + "/clicks", "c.txt", [json.dumps(read)])
    _write(tmp_dir + "/imps", "i.txt", [json.dumps(refresh), "{broken"])
    clicks = spark.readStream.format("text").load(tmp_dir + "/clicks").withColumnRenamed("value", "line")
    imps = spark.readStream.format("text").load(tmp_dir + "/imps").withColumnRenamed("value", "line")
    inst = SI.instance_stream(imps, clicks, "en")
    q = (inst.writeStream.format("parquet").option("path", tmp_dir + "/out")
         .option("checkpointLocation", tmp_dir + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(tmp_dir + "/out").collect())
    batch_lines = spark.read.text([tmp_dir + "/clicks", tmp_dir + "/imps"]).withColumnRenamed("value", "line")
    batch = sorted(tuple(r) for r in I.parse_instances(batch_lines, "en").collect())
    assert streamed == batch == [("1", "10", 1.0), ("2", "20", 0.0), ("2", "21", 0.0)]


def test_recommender_refreshes_on_interval_and_publishes_each_batch(spark, tmp_dir):
    from skein.streaming.recommend import Model, Recommender

    loads = []

    def load_model(batch_ms):
        loads.append(batch_ms)
        prof = spark.createDataFrame([("a", [1]), ("b", [2])], "article_seq_id string, category_idx array<int>")
        return Model(
            profiles=prof,
            tfidf=spark.createDataFrame([("a", "x", 0.5)], "article_seq_id string, entity string, tfidf double"),
            global_w=spark.createDataFrame([(1, 0.1), (2, 0.2)], "c int, weight double"),
            user_w=spark.createDataFrame([("7", 1, 0.3)], "user string, c int, weight double"),
            item_w=spark.createDataFrame([("a", 0.05), ("b", 0.01)], "item string, weight double"),
            user_entity_w=spark.createDataFrame([("7", "x", 0.4)], "user string, entity string, weight double"),
        )

    clock = iter([1_000, 2_000, 10_000])
    rec = Recommender(spark, load_model, lambda: spark.createDataFrame([("8", "a")], "user string, item string"),
                      tmp_dir + "/published", "v1", n_top=5, n_candidates=10, entity_scalar=0.5, interval_ms=5_000,
                      expire_hours=6, result_template="rec:%s", now_ms=lambda: next(clock))
    src = tmp_dir + "/actions"
    _write(src, "a.txt", [json.dumps({"user_seq_id": 7, "version": "v1"})])
    _write(src, "b.txt", [json.dumps({"user_seq_id": 8})])
    _write(src, "c.txt", [json.dumps({"user_seq_id": 7})])
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src).withColumnRenamed("value", "line")
    q = (stream.writeStream.foreachBatch(rec.handle).option("checkpointLocation", tmp_dir + "/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert loads == [1_000, 10_000]                       # first batch, then only after the interval
    cur = sorted((r["user"], r["rank"], r["item"]) for r in rec.current().collect())
    # user 7: a (0.1 + 0.3 + 0.05 + 0.4·0.5·0.5) before b (0.2 + 0.01); user 8 has seen a.
    assert cur == [("7", 1, "a"), ("7", 2, "b"), ("8", 1, "b")]


def test_a_retried_batch_overwrites_its_own_dump(spark, tmp_dir):
    times = iter([0, 3_600_000])
    dump = SI.dump_instances(tmp_dir + "/dump", lambda: next(times))
    rows = spark.createDataFrame([("1", "10", 1.0)], "user string, item string, label double")
    dump(rows, 4)
    dump(rows, 4)          # the retry comes later, yet has the time of the batch
    assert spark.read.parquet(tmp_dir + "/dump/*/*/data/instance/*").count() == 1


def test_recommender_reads_the_pointer_in_every_batch_and_dumps(spark, tmp_dir):
    from skein.operators.features import split_state
    from skein.sinks.publish import publish_model
    from skein.streaming.recommend import Model, Recommender
    schema = "kind string, k1 string, k2 string, weight double"
    for v, best in ((1, "a"), (2, "b")):
        spark.createDataFrame([("i", best, "", 1.0)], schema).write.parquet(f"{tmp_dir}/m{v}")
    state = split_state(spark.createDataFrame([], schema))

    def load_model(batch_ms):
        return Model(spark.createDataFrame([("a", [1]), ("b", [1])], "article_seq_id string, category_idx array<int>"),
                     spark.createDataFrame([("a", "x", 0.5)], "article_seq_id string, entity string, tfidf double"),
                     state["global"], state["user_inferred"], state["item_inferred"], state["user_entity"])

    pointers = tmp_dir + "/pointers"
    rec = Recommender(spark, load_model, lambda: spark.createDataFrame([], "user string, item string"), tmp_dir + "/out", "v1",
                      n_top=1, n_candidates=2, entity_scalar=0.5, interval_ms=10**9, expire_hours=6, result_template="rec:%s",
                      now_ms=lambda: 1_000, pointers=lambda: spark.read.parquet(pointers), model_key="m",
                      load_state=lambda p: split_state(spark.read.parquet(p)), dump_root=tmp_dir + "/dump")
    users = spark.createDataFrame([(json.dumps({"user_seq_id": 7}),)], "line string")
    for v, best in ((1, "a"), (2, "b")):
        publish_model(spark, pointers, "m", f"{tmp_dir}/m{v}", v)
        rec.handle(users, v)
        assert [r["item"] for r in rec.current().collect()] == [best]
    info = sorted(r[0] for r in spark.read.text(tmp_dir + "/dump/*/*/info").collect())
    assert "#user = 1" in info and f"model_path = {tmp_dir}/m2" in info
    for name in ("users", "rec_feature", "candidate", "profile_info"):
        assert spark.read.text(f"{tmp_dir}/dump/*/*/{name}").count() > 0, name
    assert spark.read.parquet(tmp_dir + "/dump/*/*/profile_dump").count() == 2


def test_a_restart_after_a_compaction_goes_on_where_it_was(spark, tmp_dir, monkeypatch):
    """The new log root, folded batches and refresh time outlive the recommender; failed tries leave nothing."""
    import skein.sinks.publish as PUB
    from skein.operators.features import split_state
    from skein.streaming.recommend import Model, Recommender
    state = split_state(spark.createDataFrame([], "kind string, k1 string, k2 string, weight double"))
    loads, clock = [], [1_000]

    def load_model(batch_ms):
        loads.append(batch_ms)
        return Model(spark.createDataFrame([("a", [1]), ("b", [1])], "article_seq_id string, category_idx array<int>"),
                     spark.createDataFrame([("a", "x", 0.5)], "article_seq_id string, entity string, tfidf double"),
                     state["global"], state["user_inferred"], state["item_inferred"], state["user_entity"])

    def start():
        return Recommender(spark, load_model, lambda: spark.createDataFrame([], "user string, item string"), tmp_dir + "/out", "v1",
                           n_top=1, n_candidates=2, entity_scalar=0.5, interval_ms=10_000, expire_hours=6, result_template="rec:%s", now_ms=lambda: clock[0])

    def lists(rec):
        return sorted(tuple(r) for r in rec.current().select("user", "item", "score", "expires_ms").collect())

    batch = lambda *users: spark.createDataFrame([(json.dumps({"user_seq_id": u}),) for u in users], "line string")
    rec = start()
    for k, users in enumerate([(7, 8), (8, 9), (9, 10)]):
        clock[0] = 1_000 * (k + 1)
        rec.handle(batch(*users), k)
    before = lists(rec)
    assert [u for u, *_ in before] == ["10", "7", "8", "9"] and loads == [1_000]

    save = PUB.save_pointer
    with monkeypatch.context() as m:     # the first try dies before the move counts
        m.setattr("skein.streaming.recommend.save_pointer", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            rec.compact(tmp_dir + "/out2", 1)
    assert lists(start()) == before and start().published_root == tmp_dir + "/out"
    again = start()
    again.compact(tmp_dir + "/out2", 1)
    assert spark.read.parquet(tmp_dir + "/out2").where("batch_id = 2").count() == spark.read.parquet(tmp_dir + "/out").where("batch_id = 2").count()

    restarted = start()
    assert restarted.published_root == tmp_dir + "/out2" and restarted.last_refresh_ms == 1_000
    assert lists(restarted) == before
    restarted.handle(batch(1), 1)        # a retry of a folded batch must not write over the base
    assert lists(restarted) == before
    clock[0] = 5_000
    restarted.handle(batch(7), 3)        # not due: the same window as before the restart
    assert loads == [1_000, 1_000] and [u for u, *_ in lists(restarted)] == ["10", "7", "8", "9"]
    assert save is PUB.save_pointer


def test_start_recommender_with_processing_time_trigger(spark, tmp_dir):
    from skein.streaming.recommend import start_recommender

    calls = []

    class Probe:
        def handle(self, batch, batch_id):
            calls.append(batch.count())

    src = tmp_dir + "/actions"
    _write(src, "a.txt", [json.dumps({"user_seq_id": 1})])
    stream = spark.readStream.format("text").load(src).withColumnRenamed("value", "line")
    q = start_recommender(stream, Probe(), tmp_dir + "/ck", batch_seconds=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert calls and calls[0] == 1


def test_every_line_has_one_home_also_after_a_retry(spark, tmp_dir):
    read = json.dumps({"user_seq_id": 1, "article_seq_id": 10, "article_type": "article", "lang": "en", "ts": 5,
                       "source": "hot", "custom_categories": []})
    refresh = {"user_seq_id": 2, "article_seq_id": [20, 21], "article_type": "article", "lang": "en", "ts": 6,
               "subtype": "x", "req_mode": "online", "custom_categories": []}
    _write(tmp_dir + "/in", "a.txt", [read, read, json.dumps(refresh), read[:-1], "", "{\"device_id\":1}"])
    _write(tmp_dir + "/in", "b.txt", [json.dumps({**refresh, "lang": "hi"}), json.dumps({**refresh, "article_seq_id": []}),
                                      json.dumps({**refresh, "article_seq_id": "x"})])
    src = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(tmp_dir + "/in").withColumnRenamed("value", "line")
    handle, root = SI.route_batches(tmp_dir + "/out", "en"), tmp_dir + "/out"

    def twice(batch, batch_id):
        handle(batch, batch_id)
        handle(batch, batch_id)

    q = (src.writeStream.foreachBatch(twice).option("checkpointLocation", tmp_dir + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    lines = spark.read.text(tmp_dir + "/in").withColumnRenamed("value", "line")
    kept = [SI.routed(spark, root, out).select("line") for out in ("instances", "rejected", "skipped")]
    assert [k.count() for k in kept] == [4, 2, 3]
    together = kept[0].unionByName(kept[1]).unionByName(kept[2])
    assert sorted(r[0] for r in together.collect()) == sorted(r[0] for r in lines.collect())
    assert sorted(map(tuple, SI.routed_instances(spark, root).collect())) == sorted(map(tuple, I.parse_instances(lines, "en").collect()))
    bad = SI.dead_letters(spark, root).select("line", "reason")
    assert sorted(map(tuple, bad.collect())) == sorted(map(tuple, I.rejected_events(lines).select("line", "kind").collect()))


def test_null_lines_are_skipped_and_lines_are_parsed_once(spark):
    df = spark.createDataFrame([(None,), ("{",), ('{"user_seq_id":',)], "line string")
    got = I.routed_lines(df, "en")
    assert sorted((str(r["line"]), r["out"], r["reason"]) for r in got.collect()) == [
        ("None", "skipped", None), ("{", "skipped", None), ('{"user_seq_id":', "rejected", "refresh")]
    assert got._jdf.queryExecution().executedPlan().toString().count("from_json") == 2
