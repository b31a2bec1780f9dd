"""Keyed tables with deltas: latest wins, deletions, compaction, restarts, retries, plans."""

import os

from pyspark.sql import functions as F

from skein.operators import incremental as INC
from skein.sinks.keyed import GONE, KeyedTable
from test_plans import formatted

SCHEMA = "k string, n int, v string"


def _table(spark, root):
    return KeyedTable(spark, root, ["k", "n"], SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _files(parts):
    return {f"{p['path']}/{f}": os.path.getmtime(f"{p['path'].removeprefix('file:')}/{f}")
            for p in parts for f in os.listdir(p["path"].removeprefix("file:"))}


def _frame(spark, rows):
    return spark.createDataFrame([(k, n, v) for k, n, v in rows], SCHEMA)


def test_any_order_of_deltas_and_compactions_reads_the_same(spark, tmp_dir):
    base = [("a", i, f"b{i}") for i in range(50)]
    batches = [([("a", i, f"x{b}") for i in range(b, 50, 7)] + [("new", b, "y")], [("a", b + 20), ("none", b)]) for b in (1, 2, 3)]
    want = {r[:2]: r[2] for r in base}
    for up, gone in batches:
        want.update({r[:2]: r[2] for r in up})
        for g in gone:
            want.pop(g, None)
    for case, folds in enumerate(((), (0, 2))):
        t = _table(spark, f"{tmp_dir}/c{case}")
        assert t.read().count() == 0
        t.apply(_frame(spark, base), 0)
        for b, (up, gone) in enumerate(batches, 1):
            up = [r for r in up if r[:2] not in gone]
            assert t.apply(_frame(spark, up), b, spark.createDataFrame(gone, "k string, n int"))
            if b - 1 in folds:
                t.compact()
        assert {r[:2]: r[2] for r in _rows(t.read())} == want
        t.compact()
        t.expire()
        assert {r[:2]: r[2] for r in _rows(t.read())} == want and len(t._parts()) == 1


def test_a_delta_leaves_older_files_and_a_retry_changes_nothing(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.apply(_frame(spark, [("a", i, "0") for i in range(100)]), 0)
    old = _files(t._parts())
    assert t.apply(_frame(spark, [("a", 3, "1")]), 1)
    assert old.items() <= _files(t._parts()).items()
    assert not t.apply(_frame(spark, [("a", 3, "2")]), 1)
    assert ("a", 3, "1") in _rows(t.read())


def test_a_new_session_reads_the_same_and_an_uncommitted_part_is_not_seen(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.apply(_frame(spark, [("a", i, "0") for i in range(20)]), 0)
    t.apply(_frame(spark, [("a", 3, "1")]), 1)
    want = _rows(t.read())
    for p in t._parts():
        spark.sql(f"DROP TABLE {p['part']}")         # what another session's catalog looks like
    from skein.config import store_bucketed
    store_bucketed(_frame(spark, [("a", 4, "lost")]).withColumn(GONE, F.lit(False)), "part", t.buckets, ["k", "n"])
    assert _rows(_table(spark, tmp_dir).read()) == want


def test_lookup_and_read_do_not_shuffle_what_is_stored(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t.apply(_frame(spark, [("a", i, "0") for i in range(500)]), 0)
        t.apply(_frame(spark, [("a", i, "1") for i in range(5)]), 1, spark.createDataFrame([("a", 7)], "k string, n int"))
        assert "Exchange" not in formatted(t.read())
        keys = spark.createDataFrame([("a", 2, 0.5), ("a", 7, 0.25), ("a", 9, 1.0), ("z", 1, 2.0), (None, 1, 3.0)], "k string, n int, w double")
        found = t.lookup(keys)
        tree = formatted(found).split("\n\n")[0]
        assert tree.count("Exchange") == 1
        assert sorted(((r["w"], r["v"]) for r in found.collect())) == [(0.25, None), (0.5, "1"), (1.0, "0"), (2.0, None), (3.0, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_state_delta_equals_the_rewritten_snapshot(spark, tmp_dir):
    state = spark.createDataFrame([("u", "1", "2", 0.5), ("t", "1", "tag", 0.25), ("t", "2", "tag", 0.75), ("g", "3", "", 1.0)],
                                  "kind string, k1 string, k2 string, weight double")
    trained = spark.createDataFrame([("u", "1", "2", -0.5), ("t", "1", "tag", -0.1), ("t", "3", "x", 0.0), ("i", "9", "", 0.3)], state.schema)
    for positive in (True, False):
        t = KeyedTable(spark, f"{tmp_dir}/{positive}", ["kind", "k1", "k2"], state.schema)
        t.apply(state, 0)
        INC.snapshot_delta(t, trained, 1, positive)
        assert _rows(t.read()) == _rows(INC.snapshot(state, trained, positive))
        assert not t.room() and t.room(2)
        assert _rows(t.read()) == _rows(INC.snapshot(state, trained, positive))
