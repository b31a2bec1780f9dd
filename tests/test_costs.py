"""What steps store, shuffle and leave behind: not more than their job needs."""

import time

from pyspark.sql import functions as F

from skein.operators import dealt as D
from skein.operators import features as FT
from skein.operators import train as TR

FEATS = "user string, item string, label double, mult long, feat string, value double"


def _feats(spark):
    rows = [(f"u{k % 7}", f"i{k % 5}", float(k % 2), 1, f, 1.0) for k in range(40) for f in ("g:1", f"i:i{k % 5}", f"t:u{k % 7}:{k % 3}")]
    feats = spark.createDataFrame(list(dict.fromkeys(rows)), FEATS)
    return feats, feats.select(F.lit("x").alias("kind"), F.lit("").alias("k1"), F.lit("").alias("k2"), "feat", F.lit(0.1).alias("weight")).distinct()


def test_lbfgs_keeps_its_vectors_by_example(spark, monkeypatch):
    """A generation is one row an example; no vector of the features is stored between iterations."""
    feats, weights = _feats(spark)
    kept, keep = [], D.Dealt.keep
    monkeypatch.setattr(D.Dealt, "keep", lambda self, df, name: kept.append(df.columns) or keep(self, df, name))
    fit = TR.lbfgs(feats, weights, iterations=2, memory=2, tolerance=0.0)
    assert kept and all("ex" in cols and "fid" not in cols for cols in kept)
    assert fit.loss < fit.start_loss and fit.weights.count() == weights.count()


def test_names_are_stored_once(spark, monkeypatch):
    """Where a hash numbers features and examples, they are not stored again beside it."""
    feats, weights = _feats(spark)
    stored, store = [], D.store
    monkeypatch.setattr(D, "store", lambda df, name: stored.append(name) or store(df, name))
    d = D.deal(feats, weights, buckets=3)
    assert sorted(stored) == ["examples", "weights"]
    assert d.symbols.count() == weights.count() and d.examples.count() == feats.select("user", "item", "label").distinct().count()
    d.close()


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_symbols_meet_the_state_after_one_shuffle(spark):
    """Null and repeated keys as in a plain join: null keys meet nothing, repeated ones every time."""
    rows = [("t", "u1", "a"), ("t", "u1", "a"), ("t", "u2", None), ("g", "3", ""), ("i", "x", "")]
    feats = spark.createDataFrame(rows, "kind string, k1 string, k2 string").withColumn("feat", FT._feat_of(F.col("kind"), F.col("k1"), F.col("k2")))
    state = spark.createDataFrame([("t", "u1", "a", 0.5), ("t", "u1", "a", 0.25), ("t", "u2", None, 0.75), ("g", "3", "", 1.0)],
                                  "kind string, k1 string, k2 string, weight double")
    want = sorted([("t:u1:a", 0.25), ("t:u1:a", 0.5), ("t:u2", 0.0), ("g:3", 1.0), ("i:x", 0.0)])
    for key_hash in (False, True):
        got = FT.gather_weights(FT.batch_symbols(feats, key_hash), state)
        assert got.columns == ["kind", "k1", "k2", "feat", "weight"]
        assert sorted((r["feat"], r["weight"]) for r in got.collect()) == want
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _shuffles(FT.gather_weights(FT.batch_symbols(feats, key_hash=True), state)) == 2   # symbols, state
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_older_tags_are_made_distinct_with_the_others(spark):
    inst = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 0.0), ("v", "a", 0.0)], "user string, item string, label double")
    prof = spark.createDataFrame([("a",), ("b",)], "article_seq_id string")
    tags = spark.createDataFrame([("a", "x", 0.5), ("a", "y", 0.5), ("b", "x", 1.0)], "article_seq_id string, entity string, tfidf double")
    older = spark.createDataFrame([("u", "x"), ("w", "z"), ("w", "z")], "user string, entity string")
    out = FT.user_entity_set(inst, prof, tags, older)
    assert sorted(tuple(r) for r in out.collect()) == [("u", "x"), ("u", "y"), ("v", "x"), ("v", "y"), ("w", "z")]


def test_scratch_tables_leave_no_shuffle_files(spark):
    from skein.llm.common import Scratch
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles().mkString("\n").split("\n")
        return {f for f in found if "/shuffle_" in f}

    before = files()
    scratch = Scratch(spark, "costs", drop_shuffles=True)
    out = scratch.write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert out.count() == 7 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") != "true"


def _batch(spark):
    rows = [(f"{k % 7 if k % 3 else 99}", f"{k % 11}", float(k % 2), 1 + k % 2) for k in range(90)]
    ex = spark.createDataFrame(list(dict.fromkeys(rows)), "user string, item string, label double, mult long").dropDuplicates(["user", "item", "label"])
    prof = spark.createDataFrame([(str(k), [k % 3, 5]) for k in range(8)], "article_seq_id string, category_idx array<int>")
    tags = spark.createDataFrame([(str(k), e, 0.25) for k in range(8) for e in ("a", f"e{k % 2}")], "article_seq_id string, entity string, tfidf double")
    return ex, prof, tags


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_a_placed_batch_is_the_same_and_moves_no_own_features(spark, monkeypatch):
    """In buckets by user, also with a user that is spread over them: the features, the weights, the gradient
    and the training of the plain forms; own features and weights meet without an exchange."""
    from skein.operators import incremental as INC
    from skein.operators import placed as PL
    ex, prof, tags = _batch(spark)
    plain = FT.train_features(ex, prof, tags, 0.5)
    state = [("t", "1", "a", 0.5), ("t", "99", "a", -0.5), ("t", "99", "z", 0.125), ("u", "99", "5", 0.25), ("u", "2", "5", 0.75), ("g", "5", "", 1.0), ("i", "3", "", -1.0)]
    state = spark.createDataFrame(state, "kind string, k1 string, k2 string, weight double")
    weights = FT.gather_weights(FT.batch_symbols(plain), state)
    trained = TR.sgd(plain, weights, 2, 1.0, convergence_tol=0.0)
    for hot in (1000, 5):
        monkeypatch.setattr(PL, "LEAST_HOT", hot)
        p = PL.place(ex, prof, tags, 0.5, buckets=4, rows_per_salt=10)
        assert (p.hot is not None) == (hot == 5)
        assert _rows(p.features().select(*plain.columns)) == _rows(plain)
        none = state.where("false")
        stored = p.keep(none.withColumn("b", F.lit(0)), lambda _: state, "state")
        own, others = p.gather(stored)
        got = FT.with_feat(own.drop("b").unionByName(others)).select("feat", "weight")
        assert _rows(got) == _rows(weights.select("feat", "weight"))
        for df in (own, own.groupBy("b").count()):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert _rows(p.gradient(own, others)) == _rows(TR.gradient(plain, weights))
        assert _rows(p.dots(own, others).select("user", "item", "label", "dot")) == _rows(FT.sparse_dot(plain, weights))
        d = PL.deal_placed(p, own, others)
        new = TR.sgd(plain, weights, 2, 1.0, convergence_tol=0.0, dealt=d)
        d.close()
        assert _rows(new.select("feat", "weight")) == _rows(trained.select("feat", "weight"))
        assert _rows(INC.snapshot(stored, new).select("kind", "k1", "k2", "weight")) == _rows(INC.snapshot(state, trained))
        assert _rows(p.symbols().select("feat")) == _rows(plain.select("feat").distinct())


def test_tags_of_a_placed_batch_are_those_of_the_set(spark, monkeypatch):
    from skein.operators import placed as PL
    from skein.config import store
    ex, prof, tags = _batch(spark)
    older = spark.createDataFrame([("99", "a"), ("1", "a"), ("1", "z"), ("1", "z"), ("nobody", "a")], "user string, entity string")
    want = _rows(FT.user_entity_set(ex, prof, tags, older))
    for hot in (1000, 5):
        monkeypatch.setattr(PL, "LEAST_HOT", hot)
        p = PL.place(ex, prof, tags, 0.5, buckets=4)
        held = store(p.user_entities(), "held")[0]
        assert _rows(held.select("user", "entity").unionByName(p.more_entities(held, older))) == want


def test_own_features_are_made_distinct_by_user(spark, monkeypatch):
    """Not by hashing a table of all features; a user of too many features for one list is spread."""
    from skein.operators import placed as PL
    ex, prof, tags = _batch(spark)
    plain = FT.train_features(ex, prof, tags, 0.5)
    want, many = _rows(plain.select("kind", "k1", "k2").distinct()), {r["user"] for r in plain.groupBy("user").count().where("count > 50").collect()}
    assert 0 < len(many) < 8
    for most in (1000, 50):
        monkeypatch.setattr(PL, "MOST_NESTED", most)
        p = PL.place(ex, prof, tags, 0.5, buckets=4)
        assert (set() if p.hot is None else {r["user"] for r in p.hot.collect()}) == (many if most == 50 else set())
        for df in (p.own_symbols(), p.user_entities()):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "HashAggregate" not in plan.replace("ObjectHashAggregate", "") and "Exchange" not in plan
        assert _rows(p.own_symbols().drop("b").unionByName(p.other_symbols())) == want
        assert _rows(p.features().select(*plain.columns)) == _rows(plain)


def test_a_table_in_buckets_is_scanned_by_them(spark):
    """Also by a plain projection, which Spark would read by bytes: each task would hold parts of many buckets."""
    from skein.config import buckets_scanned, drop_bucketed, store_bucketed
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(key, None)
    df, name = store_bucketed(spark.range(1000).select(F.col("id").alias("b"), "id"), "scanned", 16, "b", deal=True)
    with buckets_scanned(spark):
        assert df.where("id > 3").select("b").rdd.getNumPartitions() == 16
    assert spark.conf.get(key, None) == before
    drop_bucketed(spark, name)


def test_a_repeated_weight_keeps_its_index(spark):
    """One index a feature, in key order, also where a feature has two weights."""
    feats = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "feat string")
    one = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("c", 3.0)], "feat string, weight double")
    assert _rows(FT.indexed_weights(feats, one, 2).select("idx", "feat", "weight")) == [(0, "a", 2.0), (1, "b", 1.0), (2, "c", 3.0)]
    two = one.unionByName(spark.createDataFrame([("b", 4.0)], one.schema))
    assert _rows(FT.indexed_weights(feats, two, 2).select("idx", "feat", "weight")) == [(0, "a", 2.0), (1, "b", 1.0), (1, "b", 4.0), (2, "c", 3.0)]


def test_lbfgs_needs_few_iterations_for_features_of_unlike_scale(spark):
    """Features that few examples have, and with small values, beside one that all have: scaled, they need no more
    iterations for it. The weights are those of the features as they are."""
    rows = []
    for u in range(40):
        for i in range(3):
            own = [(f"t:{u}:{k}", 0.02 * (1 + (u * k) % 7)) for k in range(4) if (u + i + k) % 3]
            rows += [(f"u{u}", f"i{i}", float((u + i) % 2), 1, f, v) for f, v in [("g:1", 1.0), (f"i:{i}", 1.0), *own]]
    feats = spark.createDataFrame(rows, FEATS)
    weights = feats.select(F.lit("x").alias("kind"), F.lit("").alias("k1"), F.lit("").alias("k2"), "feat", F.lit(0.1).alias("weight")).distinct()
    fit = TR.lbfgs(feats, weights, iterations=6, tolerance=0.0, gradient_tolerance=0.05)
    assert fit.converged and fit.reason == "gradient" and fit.loss < fit.start_loss
    norm = [g.agg(F.sqrt(F.sum(F.col("grad") ** 2))).first()[0] for g in (TR.gradient(feats, weights), TR.gradient(feats, fit.weights))]
    assert norm[1] <= 0.05 * norm[0]


def test_buckets_of_a_batch_are_even(spark):
    """What a task hashes of its bucket has to fit in memory: the fullest of many buckets has no multiple of its share."""
    from skein.operators import placed as PL
    ex = spark.range(20_000).select(F.col("id").cast("string").alias("user"), F.lit("i").alias("item"), F.lit(1.0).alias("label"), F.lit(1).cast("long").alias("mult"))
    _, prof, tags = _batch(spark)
    n = 40
    p = PL.place(ex, prof, tags, 0.5, buckets=n)
    held = [r["count"] for r in p.examples.groupBy(F.pmod(F.hash("b"), F.lit(n))).count().collect()]
    assert sum(held) == 20_000 and len(held) == n
    assert max(held) <= 1.5 * 20_000 / n


def test_a_bucket_holds_what_two_hashed_relations_may(spark):
    """``dots`` hashes a bucket's state and its weights in one task: 600,000 features are too many for one bucket, and
    for one user's place. The products are those of the plain form."""
    from skein.operators import placed as PL
    ex = spark.range(600).select(F.when(F.col("id") < 300, "a").otherwise("b").alias("user"), F.concat(F.lit("i"), F.col("id") % 300).alias("item"),
                                 (F.col("id") % 2).cast("double").alias("label"), F.lit(1).cast("long").alias("mult"))
    prof = spark.range(300).select(F.concat(F.lit("i"), "id").alias("article_seq_id"), F.array(F.lit(1)).alias("category_idx"))
    tags = prof.select("article_seq_id", F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("entity"), F.lit(0.001).alias("tfidf")).withColumn("entity", F.col("entity").cast("string"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        p = PL.place(ex, prof, tags, 0.5)
        assert p.buckets == 3 and {r["user"] for r in p.hot.collect()} == {"a", "b"}
        state = spark.createDataFrame([("t", "a", "7", 0.5), ("u", "b", "1", 0.25), ("g", "1", "", 1.0)], "kind string, k1 string, k2 string, weight double")
        stored = p.keep(state.where("false").withColumn("b", F.lit(0)), lambda _: state, "state")
        got = p.dots(*p.gather(stored)).groupBy("user", F.round("dot", 9).alias("dot")).count()
        assert _rows(got) == [("a", 1.00025, 300), ("b", 1.25, 300)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
