"""Properties: idempotent upsert, snapshot round trip, exclusion and top-N bounds, SGD = MLlib."""

import math

import pytest

from pyspark.sql import functions as F

from conftest import SF001
from skein.operators import incremental as INC
from skein.operators import train as TR
from skein.operators.dealt import deal, drawn, gradient_parts
from skein.plans.scenario import Scenario
from skein.sources import fixtures as fx


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_twice_equals_once(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    upd = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = INC.upsert(old, upd, "k")
    assert _set(once) == [("a", 1), ("b", 3), ("c", 4)]
    assert _set(INC.upsert(once, upd, "k")) == _set(once)


def test_snapshot_round_trip(spark, tmp_dir):
    old = spark.createDataFrame([("u", "1", "2", 0.5), ("u", "2", "3", 0.1), ("i", "9", "", 0.2)],
                                "kind string, k1 string, k2 string, weight double")
    upd = spark.createDataFrame([("u", "1", "2", 0.7)], "kind string, k1 string, k2 string, weight double")
    snap = INC.snapshot(old, upd)
    path = INC.write_version(snap, tmp_dir, "state", "1")
    assert _set(spark.read.parquet(path)) == _set(snap) == [("i", "9", "", 0.2), ("u", "1", "2", 0.7), ("u", "2", "3", 0.1)]


def test_recommendations_exclude_shown_and_respect_n(spark):
    s = Scenario(spark, SF001)
    rec = s.recommended()
    log = fx.rec_log(spark, SF001)
    assert rec.join(log, ["user", "item"], "left_semi").count() == 0
    assert rec.groupBy("user").count().agg(F.max("count")).first()[0] <= fx.N_TOP
    # Every active user with at least one unshown candidate gets a list.
    users_with_rows = rec.select("user").distinct().count()
    assert 0 < users_with_rows <= s.users().count()


def test_sgd_equals_mllib(spark):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import SparseVector
    from pyspark.mllib.regression import LabeledPoint

    data = [  # (user, item, label, {feat_idx: value})
        ("u1", "a", 1.0, {0: 1.0, 2: 0.5}),
        ("u1", "b", 0.0, {1: 1.0, 2: 0.25}),
        ("u2", "a", 1.0, {0: 1.0, 3: 1.0}),
        ("u2", "c", 0.0, {1: 1.0, 3: 1.0, 4: 2.0}),
    ]
    w0 = [0.1, -0.2, 0.05, 0.0, 0.3]
    feats = spark.createDataFrame(
        [(u, i, y, 1, "f", str(k), "", f"f:{k}", v) for u, i, y, xs in data for k, v in xs.items()],
        "user string, item string, label double, mult long, kind string, k1 string, k2 string, feat string, value double")
    weights = spark.createDataFrame([("f", str(k), "", f"f:{k}", w) for k, w in enumerate(w0)],
                                    "kind string, k1 string, k2 string, feat string, weight double")
    ours = {r["feat"]: r["weight"] for r in TR.sgd(feats, weights, 3, 1.0, 1.0, convergence_tol=0.0).collect()}
    rdd = spark.sparkContext.parallelize(
        [LabeledPoint(y, SparseVector(5, sorted(xs), [xs[k] for k in sorted(xs)])) for _, _, y, xs in data], 2)
    model = LogisticRegressionWithSGD.train(rdd, iterations=3, step=1.0, miniBatchFraction=1.0, initialWeights=w0,
                                            regParam=0.0, intercept=False, convergenceTol=0.0)
    for k, w in enumerate(model.weights.toArray()):
        assert math.isclose(ours[f"f:{k}"], w, rel_tol=1e-9, abs_tol=1e-12)


def test_publication_log_keeps_latest_list_per_user(spark, tmp_dir):
    from skein.sinks.publish import current_lists, publication_rows
    recs1 = spark.createDataFrame([("u", "1", 1, 0.9), ("v", "2", 1, 0.8)], "user string, item string, rank int, score double")
    users1 = spark.createDataFrame([("u",), ("v",)], "user string")
    recs2 = spark.createDataFrame([("u", "3", 1, 0.7)], "user string, item string, rank int, score double")
    users2 = spark.createDataFrame([("u",), ("v",)], "user string")   # v is active but gets nothing
    publication_rows(users1, recs1, 0, 6, "rec:%s").write.parquet(tmp_dir + "/log/batch_id=0")
    publication_rows(users2, recs2, 1, 6, "rec:%s").write.parquet(tmp_dir + "/log/batch_id=1")
    cur = current_lists(spark.read.parquet(tmp_dir + "/log"))
    assert _set(cur.select("user", "item")) == [("u", "3")]


def test_lbfgs_reaches_the_mllib_optimum(spark):
    """Distributed L-BFGS and MLlib's L-BFGS end at the same minimum of the logistic loss."""
    import random
    from pyspark.mllib.classification import LogisticRegressionWithLBFGS
    from pyspark.mllib.linalg import SparseVector
    from pyspark.mllib.regression import LabeledPoint

    rnd = random.Random(7)
    data = []
    for e in range(60):
        xs = {k: round(rnd.uniform(-1, 1), 3) for k in rnd.sample(range(4), 3)}
        p = 1 / (1 + math.exp(-(0.8 * xs.get(0, 0) - 0.5 * xs.get(1, 0) + 0.3 * xs.get(2, 0))))
        data.append((f"u{e}", "i", 1.0 if rnd.random() < p else 0.0, xs))
    feats = spark.createDataFrame(
        [(u, i, y, 1, f"f:{k}", v) for u, i, y, xs in data for k, v in xs.items()],
        "user string, item string, label double, mult long, feat string, value double")
    weights = spark.createDataFrame([("f", str(k), "", f"f:{k}", 0.0) for k in range(4)],
                                    "kind string, k1 string, k2 string, feat string, weight double")
    ours = {r["feat"]: r["weight"] for r in TR.lbfgs(feats, weights, iterations=60, memory=5, tolerance=1e-12).weights.collect()}

    def loss(w):
        tot = 0.0
        for _, _, y, xs in data:
            m = sum(w[k] * v for k, v in xs.items())
            tot += math.log1p(math.exp(-abs(m))) + max(m, 0) - y * m
        return tot / len(data)

    rdd = spark.sparkContext.parallelize(
        [LabeledPoint(y, SparseVector(4, sorted(xs), [xs[k] for k in sorted(xs)])) for _, _, y, xs in data], 2)
    model = LogisticRegressionWithLBFGS.train(rdd, iterations=200, regParam=0.0, intercept=False, tolerance=1e-12)
    mine = loss([ours[f"f:{k}"] for k in range(4)])
    theirs = loss(list(model.weights.toArray()))
    start = loss([0.0] * 4)
    assert mine < start
    assert abs(mine - theirs) < 1e-6


def test_compaction_keeps_current_lists(spark, tmp_dir):
    from skein.sinks.publish import compact, current_lists, publication_rows
    schema = "user string, item string, rank int, score double"
    batches = [
        ([("u", "1", 1, 0.9), ("v", "2", 1, 0.8)], ["u", "v"]),
        ([("u", "3", 1, 0.7)], ["u", "v"]),          # v emptied
        ([("w", "4", 1, 0.6), ("u", "5", 1, 0.5)], ["w", "u"]),
    ]
    for b, (recs, users) in enumerate(batches):
        publication_rows(spark.createDataFrame(users, "string").toDF("user"), spark.createDataFrame(recs, schema),
                         b, 6, "rec:%s").write.parquet(f"{tmp_dir}/log/batch_id={b}")
    full = _set(current_lists(spark.read.parquet(tmp_dir + "/log")).select("user", "item"))
    compact(spark.read.parquet(tmp_dir + "/log"), 1, tmp_dir + "/new")
    spark.read.parquet(tmp_dir + "/log").where("batch_id > 1").write.partitionBy("batch_id").parquet(tmp_dir + "/new", mode="append")
    assert _set(current_lists(spark.read.parquet(tmp_dir + "/new")).select("user", "item")) == full == [("u", "5"), ("w", "4")]


def test_filter_save_keeps_untouched_lines(spark, tmp_dir):
    from skein.sinks.store import filter_save
    lines = spark.createDataFrame(["u1\tx\t0.1", "u2\ty\t0.2", "u3", "u1\tz\t0.3"], "string")
    touched = spark.createDataFrame([("u1",)], "key string")
    filter_save(lines, touched, tmp_dir + "/keep")
    assert sorted(r[0] for r in spark.read.text(tmp_dir + "/keep").collect()) == ["u2\ty\t0.2", "u3"]


def test_message_payload_through_a_file_sink(spark, tmp_dir):
    from pyspark.sql import functions as F
    from skein.sinks.publish import fixed_payload, json_payload, write_messages
    recs = spark.createDataFrame([("u", "a", 1, 0.1234567)], "user string, item string, rank bigint, score double")
    fixed = fixed_payload(recs, F.col("user")).first()
    assert (fixed["key"], fixed["value"]) == ("u", '{"user":"u","item":"a","rank":1,"score":0.123457}')
    write_messages(json_payload(recs, F.col("user"), ["item", "rank"]), fmt="json", path=tmp_dir + "/msgs")
    got = spark.read.json(tmp_dir + "/msgs").first()
    assert got["key"] == "u" and got["value"] == '{"item":"a","rank":1}'


def _forced_shuffle(spark, run):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        return run()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_training_is_alike_by_broadcast_and_by_shuffle(spark):
    feats = spark.createDataFrame(
        [("u1", "a", 1.0, 2, "f:0", 1.0), ("u1", "a", 1.0, 2, "f:1", -0.5), ("u2", "b", 0.0, 1, "f:1", 1.0),
         ("u3", "c", 1.0, 1, "f:0", 0.3), ("u3", "c", 1.0, 1, "f:1", 0.7), ("u4", "d", 0.0, 1, "f:0", -0.2)],
        "user string, item string, label double, mult long, feat string, value double")
    weights = spark.createDataFrame([("f", str(k), "", f"f:{k}", 0.1 * k) for k in range(2)],
                                    "kind string, k1 string, k2 string, feat string, weight double")
    for run in (lambda: TR.sgd(feats, weights, 3, 0.5, convergence_tol=0.0),
                lambda: TR.lbfgs(feats, weights, iterations=4, memory=3).weights):
        fast = {r["feat"]: r["weight"] for r in run().collect()}
        slow = _forced_shuffle(spark, lambda: {r["feat"]: r["weight"] for r in run().collect()})  # noqa: B023
        assert fast.keys() == slow.keys()
        for k in fast:
            assert math.isclose(fast[k], slow[k], rel_tol=1e-9, abs_tol=1e-12)


def test_shared_and_split_features_train_like_the_plain_gradient(spark):
    """Features of one bucket, of many, and of a hot user spread over buckets: the same sums."""
    import random
    import skein.operators.dealt as D
    rnd = random.Random(8)
    rows = []
    for e in range(400):
        u, i, y, m = ("hot" if e % 3 == 0 else f"u{rnd.randint(0, 40)}"), f"i{e}", float(rnd.random() < 0.4), rnd.randint(1, 3)
        for f in {f"g:{rnd.randint(0, 2)}", f"i:{i}", f"t:{u}:{rnd.randint(0, 5)}"}:
            rows.append((u, i, y, m, f, round(rnd.uniform(-1, 1), 3)))
    feats = spark.createDataFrame(rows, "user string, item string, label double, mult long, feat string, value double")
    names = sorted({r[4] for r in rows}) + ["g:unused"]
    weights = spark.createDataFrame([(f[0], f[2:], "", f, round(rnd.uniform(-1, 1), 3)) for f in names], "kind string, k1 string, k2 string, feat string, weight double")
    old, D.LEAST_HOT = D.LEAST_HOT, 10
    try:
        d = deal(feats, weights, buckets=5)
    finally:
        D.LEAST_HOT = old
    assert d.features.where("b >= 0").select("b").distinct().count() > 5
    assert d.weights.groupBy("fid").agg({"b": "count"}).where("`count(b)` > 1").count() > 3
    got = {r["feat"]: r["grad"] for r in d.total(d.weights, gradient_parts(d, d.weights)).join(d.weights.where("lead"), ["b", "fid"]).join(d.symbols, "fid").collect()}
    want = {r["feat"]: r["grad"] for r in TR.gradient(feats, weights).collect()} | {"g:unused": 0.0}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12) for k in want)
    # The copies of a shared feature stay equal through training.
    w = {r["feat"]: r["weight"] for r in TR.sgd(feats, weights, 2, 1.0, convergence_tol=0.0, dealt=d).collect()}
    plain = {r["feat"]: r["weight"] for r in TR.sgd(feats, weights, 2, 1.0, convergence_tol=0.0).collect()}
    assert w.keys() == plain.keys() == set(names) and all(math.isclose(w[k], plain[k], rel_tol=1e-9, abs_tol=1e-12) for k in w)
    d.close()


@pytest.mark.parametrize("bad", [1, 3])
def test_clashing_keys_get_others(spark, monkeypatch, bad):
    """Hashes that clash under the first seed, or under all: other keys, the same sums."""
    import skein.operators.dealt as D
    plain = D.hashed
    monkeypatch.setattr(D, "hashed", lambda cols, seed: F.pmod(plain(cols, seed), F.lit(3)) if seed < bad else plain(cols, seed))
    rows = [(f"u{k % 5}", f"i{k % 7}", float(k % 2), 1, f, 0.5) for k in range(70) for f in (f"i:{k % 7}", f"u:{k % 5}:{k % 2}")]
    feats = spark.createDataFrame(sorted(set(rows)), "user string, item string, label double, mult long, feat string, value double")
    weights = feats.select(F.lit("x").alias("kind"), F.lit("").alias("k1"), F.lit("").alias("k2"), "feat", F.lit(0.1).alias("weight")).distinct()
    d = deal(feats, weights, buckets=3)
    got = {r["feat"]: r["grad"] for r in d.total(d.weights, gradient_parts(d, d.weights)).join(d.weights.where("lead"), ["b", "fid"]).join(d.symbols, "fid").collect()}
    want = {r["feat"]: r["grad"] for r in TR.gradient(feats, weights).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12) for k in want)
    d.close()


def test_train_step_says_how_a_fit_ended(spark):
    feats = spark.createDataFrame([("u1", "a", 1.0, 1, "f:0", 1.0), ("u2", "b", 0.0, 1, "f:0", 1.0), ("u3", "b", 1.0, 1, "f:0", 1.0)],
                                  "user string, item string, label double, mult long, feat string, value double")
    weights = spark.createDataFrame([("f", "0", "", "f:0", 0.0)], "kind string, k1 string, k2 string, feat string, weight double")
    done = TR.train_step(feats, weights, -1, 1.0, 1.0)
    assert done.route == "lbfgs" and done.fit.converged and done.weights is done.fit.weights
    none = TR.train_step(feats.withColumn("label", F.lit(0.0)), weights, -1, 1.0, 1.0)
    assert none.route == "base" and none.fit is None and none.weights is weights


def test_lbfgs_reports_how_it_ended(spark):
    feats = spark.createDataFrame(
        [("u1", "a", 1.0, 1, "f:0", 1.0), ("u2", "b", 0.0, 1, "f:0", 1.0), ("u3", "b", 1.0, 1, "f:0", 1.0)],
        "user string, item string, label double, mult long, feat string, value double")
    weights = spark.createDataFrame([("f", "0", "", "f:0", 0.0)], "kind string, k1 string, k2 string, feat string, weight double")
    fit = TR.lbfgs(feats, weights)
    assert fit.converged and fit.reason in ("loss", "gradient")
    assert math.isclose(fit.weights.first()["weight"], math.log(2), rel_tol=1e-2)
    short = TR.lbfgs(feats, weights, iterations=1)
    assert not short.converged and short.reason == "iterations"
    none = TR.lbfgs(feats.where("label < 0"), weights)
    assert not none.converged and none.reason == "no positive label"


def test_mini_batches_draw_copies_on_their_own(spark):
    feats = spark.createDataFrame([("u", "i", 1.0, 1000, "f:0", 1.0)],
                                  "user string, item string, label double, mult long, feat string, value double")
    weights = spark.createDataFrame([("f", "0", "", "f:0", 0.0)], "kind string, k1 string, k2 string, feat string, weight double")
    d = deal(feats, weights)
    n = d.examples.select(drawn(0.3, 1)).first()[0]
    assert 200 < n < 400 and d.examples.select(drawn(0.3, 1)).first()[0] == n
    assert gradient_parts(d, d.weights, drawn(1e-9, 1)).count() == 0
    part = gradient_parts(d, d.weights, drawn(0.3, 1)).first()["part"]
    assert math.isclose(part, -0.5 * n)
    d.close()


def test_snapshot_keeps_untrained_weights_and_drops_negative_tags(spark):
    """A user with 13 category weights of which one is trained keeps the other 12."""
    old = [("u", "5", str(c), 0.1 * c) for c in range(13)] + [("t", "5", "a", 0.5), ("t", "5", "b", 0.6), ("t", "7", "c", 0.7), ("g", "1", "", 0.2)]
    schema = "kind string, k1 string, k2 string, weight double"
    trained = [("u", "5", "3", 0.9), ("t", "5", "a", 0.4), ("t", "7", "c", -0.1), ("t", "7", "d", 0.3)]
    got = {r[:3]: r[3] for r in _set(INC.snapshot(spark.createDataFrame(old, schema), spark.createDataFrame(trained, schema)))}
    assert sum(k[0] == "u" for k in got) == 13 and got["u", "5", "3"] == 0.9
    assert got["t", "5", "a"] == 0.4 and got["t", "5", "b"] == 0.6          # the unseen tag stays
    assert ("t", "7", "c") not in got and got["t", "7", "d"] == 0.3
    both = INC.snapshot(spark.createDataFrame(old, schema), spark.createDataFrame(trained, schema), only_positive_tags=False)
    assert ("t", "7", "c", -0.1) in _set(both)


def test_state_lines_keep_full_precision(spark, tmp_dir):
    from skein.sinks import store as ST
    rows = spark.createDataFrame([("u", 4e-7), ("v", 1 / 3)], "user string, weight double")
    ST.save_lines(ST.state_lines(rows, ["user", "weight"]), tmp_dir + "/s")
    back = {line.split("\t")[0]: float(line.split("\t")[1]) for (line,) in ST.read_lines(spark, tmp_dir + "/s").collect()}
    assert back == {"u": 4e-7, "v": 1 / 3}


def test_latest_per_key_takes_map_columns(spark):
    from skein.sources import profiles as P
    df = spark.createDataFrame([("a", 1, {"x": 0.1}), ("a", 2, {"y": 0.2}), ("b", 1, {})], "k string, t int, m map<string,double>")
    assert _set(P.latest_per_key(df, "k", "t").select("k", "t", F.to_json("m"))) == [("a", 2, '{"y":0.2}'), ("b", 1, "{}")]


def test_dictionary_update_reports_count_and_start(spark):
    d = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert tuple(INC.update_info(d, 77).first()) == (2, 77)


def test_scenario_data_exercises_the_model(spark):
    """Features of all four kinds, replaced and carried state of each, categories, exclusions."""
    s = Scenario(spark, SF001)
    kinds = {r["kind"]: r["count"] for r in s.features().groupBy("kind").count().collect()}
    assert set(kinds) == {"g", "u", "i", "t"}
    key = ["kind", "k1", "k2"]
    trained = s.features().select(*key).distinct()
    replaced = {r["kind"] for r in s.state.join(trained, key, "left_semi").select("kind").distinct().collect()}
    carried = {r["kind"] for r in s.state.join(trained, key, "left_anti").select("kind").distinct().collect()}
    assert replaced == {"g", "u", "i", "t"} and {"u", "i", "t"} <= carried
    assert s.profiles.where(F.size("category_idx") > 0).join(s.instances, F.col("article_seq_id") == F.col("item"), "left_semi").count() > 0
    shown = fx.rec_log(spark, SF001)
    assert shown.count() <= spark.read.parquet(f"{SF001}/events.parquet").where("event_type = 'purchase'").count()
    assert s.scored().join(shown, ["user", "item"], "left_semi").count() > 0
    assert s.profiles.groupBy("article_seq_id").count().where("count > 1").count() == 0


def test_two_batches_train_save_reload_and_rank(spark, tmp_dir):
    """The solution protocol: the second batch starts from the weights that the first saved."""
    from skein.operators.solution import CategoryEntitySolution
    prof = spark.createDataFrame([("a", [1]), ("b", [2])], "article_seq_id string, category_idx array<int>")
    tags = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 1.0)], "article_seq_id string, entity string, tfidf double")
    spark.createDataFrame([], "kind string, k1 string, k2 string, weight double").write.parquet(tmp_dir + "/m0/state")
    sol = CategoryEntitySolution(spark, lambda start: (prof, tags), 0.5)
    sol.set_info_dir(tmp_dir + "/info")
    sol.init(tmp_dir + "/m0")
    sol.prepare(10 * 24 * 3600 * 1000)
    inst = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 0.0), ("v", "b", 1.0)], "user string, item string, label double")
    seen = []
    for k in (1, 2):
        f = sol.features(inst)
        base = sol.gen_weights()
        seen.append({r["feat"]: r["weight"] for r in base.collect()})
        reg = base.select("feat").distinct().withColumn("idx", F.monotonically_increasing_id())
        done = TR.train_step(f, base, 2, 1.0, 1.0, reg, f"{tmp_dir}/batch{k}")
        w = done.weights
        assert done.route == "sgd" and done.fit is None
        sol.update_by_weights(w)
        sol.save(f"{tmp_dir}/m{k}")
        sol.init(f"{tmp_dir}/m{k}")
    assert set(seen[0].values()) == {0.0} and seen[1]["i:a"] > 0
    assert spark.read.text(f"{tmp_dir}/batch1/sparse_weights").count() > 0
    ranked = {(r["user"], r["item"]): r["score"] for r in sol.rank(spark.createDataFrame([("u",), ("v",)], "user string"), 10).collect()}
    assert ranked["u", "a"] > ranked["u", "b"] and ranked["v", "b"] > ranked["u", "b"]
    assert sol.latest_weights().count() > 0
    assert spark.read.text(tmp_dir + "/info/profile_info").first()[0].startswith("2 since")


def test_expired_lists_are_not_in_force(spark, tmp_dir):
    from skein.sinks.publish import compact, current_lists, publication_rows
    hour = 3600 * 1000
    schema = "user string, item string, rank int, score double"
    for b, at in ((0, 0), (1, 5 * hour)):
        user = spark.createDataFrame([(f"u{b}",)], "user string")
        publication_rows(user, spark.createDataFrame([(f"u{b}", "x", 1, 0.5)], schema), at, 6, "rec:%s").write.parquet(f"{tmp_dir}/log/batch_id={b}")
    log = spark.read.parquet(tmp_dir + "/log")
    users = lambda now: sorted(r["user"] for r in current_lists(log, now).collect())
    assert users(None) == users(hour) == ["u0", "u1"] and users(7 * hour) == ["u1"] and users(12 * hour) == []
    compact(log, 1, tmp_dir + "/base", 7 * hour)
    assert [r["user"] for r in spark.read.parquet(tmp_dir + "/base").collect()] == ["u1"]


def test_messages_are_valid_json(spark):
    import json
    from skein.sinks.publish import fixed_payload
    recs = spark.createDataFrame([('u"x', "a\\b", 1, 0.0)], "user string, item string, rank bigint, score double")
    assert json.loads(fixed_payload(recs, F.col("user")).first()["value"]) == {"user": 'u"x', "item": "a\\b", "rank": 1, "score": 0.0}


def test_malformed_lines_have_no_time_and_strict_mode_fails(spark):
    import pytest
    from skein.functions.events import event_ts
    from skein.operators.instances import parse_instances
    lines = spark.createDataFrame([('{"user_seq_id": "x", "source": 1',), ('{"user_seq_id": 1, "ts": 5}',), ('{"user_seq_id": 1}',)], "line string")
    assert [r[0] for r in lines.select(event_ts(F.col("line"))).collect()] == [None, 5, 0]
    assert parse_instances(lines, "en").count() == 0
    with pytest.raises(Exception, match="malformed event line"):
        parse_instances(lines, "en", strict=True).collect()
