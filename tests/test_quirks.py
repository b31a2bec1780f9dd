"""Hand-made edge rows, one test per quirk with behaviour (FIXTURES.md §3, SURVEY §2.14)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skein.functions import encode as E
from skein.functions.text import space_words, strip_pair_line, tsv_key
from skein.operators import incremental as INC
from skein.operators import instances as I
from skein.operators import rank as RK
from skein.sinks import publish as PB
from skein.sinks import store as ST
from skein.sources import profiles as P

READ = '{"user_seq_id":1,"article_seq_id":10,"article_type":"article","lang":"en","ts":5,"source":"main","custom_categories":["sports"]}'
REFRESH = '{"user_seq_id":2,"article_seq_id":[20,21],"article_type":"article","lang":"en","ts":6,"subtype":"x","req_mode":"online","custom_categories":["cricket"]}'

PROFILE_SCHEMA = ("article_seq_id string, crawled_at timestamp_ntz, usable boolean, category array<string>, "
                  "title_name_entities array<string>, content_name_entities array<string>, "
                  "content_name_entities_tfidf map<string,double>, text_vector array<string>")


def lines(spark, *xs):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "event_id long, line string")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_good_lines_make_instances(spark):
    out = I.parse_instances(lines(spark, READ, REFRESH), "en")
    assert rows(out, "user", "item", "label") == [("1", "10", 1.0), ("2", "20", 0.0), ("2", "21", 0.0)]


@pytest.mark.parametrize("bad", [
    '{bad user_seq_id',                                   # malformed JSON (Q2)
    '{"user_seq_id":9999999999,"source":"main"}',          # integer overflow (Q2)
    REFRESH.replace('["cricket"]', '["open-source"]'),    # "source" inside a refresh: read rule, fails (Q3)
])
def test_rejects(spark, bad):
    df = lines(spark, bad)
    assert I.parse_instances(df, "en").count() == 0
    assert I.rejected_events(df).count() == 1


def test_empty_refresh_and_missing_lang(spark):
    empty = REFRESH.replace("[20,21]", "[]")
    no_lang = READ.replace('"lang":"en",', "")
    assert I.parse_instances(lines(spark, empty, no_lang), "en").count() == 0


def test_read_sources_and_refresh_modes(spark):
    push = READ.replace('"main"', '"push"')
    offline = REFRESH.replace('"online"', '"offline"')
    video = REFRESH.replace('"article_type":"article"', '"article_type":"video"')
    assert I.parse_instances(lines(spark, push, offline, video), "en").count() == 0


def test_pair_lines_and_ts(spark):
    pair = lines(spark, "(null," + READ + ")")
    assert pair.select(strip_pair_line(F.col("line"))).first()[0] == READ
    assert rows(I.parse_instances_pair(pair, "en"), "user", "item") == [("1", "10")]


def _profiles(spark, rows_):
    return spark.createDataFrame(rows_, PROFILE_SCHEMA)


T0 = dt.datetime(2024, 1, 28)


def test_profile_bad_rows_dropped(spark):
    df = _profiles(spark, [
        ("a", T0 + dt.timedelta(hours=1), True, ["sports", None], [], [], {}, ["0.1"]),    # null element (Q1)
        ("b", T0 + dt.timedelta(hours=1), True, None, [], [], {}, ["0.1"]),                # null list
        ("", T0 + dt.timedelta(hours=1), True, ["sports"], [], [], {}, ["0.1"]),           # empty id
        ("c", T0 + dt.timedelta(hours=1), True, ["photo"], [], [], {}, ["0.1", "x"]),      # unknown name is fine
        ("d", T0 + dt.timedelta(hours=1), True, ["sports"], [], [], {}, ["0.1", "0.2"]),
    ])
    cat = P.scan_profiles(df, ["category"], since=T0)
    assert rows(cat, "article_seq_id") == [("c",), ("d",)]
    assert [r["category_idx"] for r in cat.orderBy("article_seq_id").collect()] == [[], [1]]
    vec = P.scan_profiles(df, ["category", "text_vector"], since=T0)
    assert rows(vec, "article_seq_id") == [("d",)]          # non-numeric element drops "c" (Q1)
    rej = P.rejected_profiles(df, ["category", "text_vector"], since=T0)
    assert dict(rows(rej, "article_seq_id", "reason")) == {"": "id", "a": "category", "b": "category", "c": "text_vector"}


def test_time_bounds(spark):
    df = _profiles(spark, [("a", T0, True, ["sports"], [], [], {}, [])])
    assert P.scan_profiles(df, ["category"], since=T0).count() == 0                  # strict >
    assert P.scan_profiles(df, ["category"], since=T0, inclusive=True).count() == 1  # inclusive >=


def test_entities_case(spark):
    df = _profiles(spark, [("a", T0 + dt.timedelta(hours=1), True, ["sports"], [], ["Delhi", "delhi"],
                            {"Delhi": 0.5, "delhi": 0.5}, [])])
    ents = P.scan_profiles(df, ["content_entities"], since=T0).first()["content_entities"]
    assert ents == ["delhi"]                                                          # set form (Q20)
    tf = P.scan_profiles(df, ["content_tfidf"], since=T0).first()["content_tfidf"]
    assert sorted(tf) == ["Delhi", "delhi"]                                            # keys keep case


def test_encoders(spark):
    df = spark.createDataFrame([(["cricket", "sports", "photo", "sports"],), (["zzz", "hhh", "x"],)], "c array<string>")
    r = df.select(E.encode_category(F.col("c")).alias("a"), E.encode_category_city(F.col("c")).alias("b"),
                  E.encode_custom_category(F.col("c")).alias("u")).collect()
    assert r[0]["a"] == [1, 2] and r[0]["b"] == [] and r[0]["u"] == [0, 2, 3]
    assert r[1]["a"] == [] and r[1]["b"] == [0, 2] and r[1]["u"] == [0]


def test_start_ms_edges(spark):
    W = 3 * 24 * 3600 * 1000
    df = spark.createDataFrame([(W, 5), (10 * W, 10 * W - W), (10 * W, -1), (10 * W, 10 * W - W - 1)], "t long, l long")
    got = [r[0] for r in df.select(INC.start_ms(F.col("t"), F.col("l"))).collect()]
    assert got == [0, 9 * W, 9 * W, 9 * W]
    assert INC.article_dict_start(10 * W, 10 * W - W, dict_empty=False) == 9 * W
    assert INC.article_dict_start(10 * W, 10 * W - 2, dict_empty=True) == 9 * W
    assert INC.user_dict_start(10 * W, -1, dict_empty=False) == 0


def test_duplicate_profile_latest_wins(spark):
    df = spark.createDataFrame([("a", T0, "old"), ("a", T0 + dt.timedelta(hours=1), "new"), ("b", T0, "x")],
                               "k string, ts timestamp_ntz, v string")
    assert rows(P.latest_per_key(df, "k", "ts"), "k", "v") == [("a", "new"), ("b", "x")]


def test_equal_scores_item_descending(spark):
    df = spark.createDataFrame([("u", "10", 0.5), ("u", "9", 0.5), ("u", "11", 0.1)], "user string, item string, score double")
    top = RK.top_per_user(df, 2)
    assert rows(top, "rank", "item") == [(1, "9"), (2, "10")]    # "9" > "10" as strings (Q6)


def test_all_shown_removes_published_rows(spark):
    old = spark.createDataFrame([("u", "rec:u", "1", 1, 0.3, 1), ("v", "rec:v", "2", 1, 0.2, 1)],
                                "user string, key string, item string, rank bigint, score double, expires_ms bigint")
    users = spark.createDataFrame([("u",)], "user string")
    new = spark.createDataFrame([], "user string, item string, rank int, score double")
    out = PB.publish(old, users, new, 0, 6, "rec:%s")
    assert rows(out, "user") == [("v",)]                                               # Q16


def test_registry_key_with_comma(spark, tmp_dir):
    spark.createDataFrame(["(a,b,7)", "(x,0)"], "string").write.text(tmp_dir + "/reg")
    got = rows(ST.load_registry(spark, tmp_dir + "/reg"), "feat", "idx")
    assert got == [("a,b", 7), ("x", 0)]                                               # Q12


def test_tsv_key_without_tab(spark):
    df = spark.createDataFrame(["k", "a\tb\tc"], "string")
    assert rows(df.select(tsv_key(F.col("value")).alias("k")), "k") == [("a",), ("k",)]


def test_words(spark):
    df = spark.createDataFrame(["a  b  ", "", "   "], "string")
    got = [r[0] for r in df.select(space_words(F.col("value"))).collect()]
    assert got == [["a", "", "b"], [""], []]                                           # Q11


def test_md5_bucket_matches_python(spark):
    import hashlib
    from skein.functions.hashing import md5_bucket, md5_hex
    words = ["", "abc", "héllo wörld", "x" * 1000]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [tuple(r) for r in df.select(md5_hex(F.col("s")), md5_bucket(F.col("s"), 997)).collect()]
    want = [(hashlib.md5(w.encode()).hexdigest(), int(hashlib.md5(w.encode()).hexdigest(), 16) % 997) for w in words]
    assert got == want


def test_lbfgs_without_positive_returns_base(spark):
    from skein.operators import train as TR
    f = spark.createDataFrame([("u", "i", 0.0, 1, "i:i", 1.0)], "user string, item string, label double, mult long, feat string, value double")
    w = spark.createDataFrame([("i", "i", "", "i:i", 0.25)], "kind string, k1 string, k2 string, feat string, weight double")
    assert rows(TR.lbfgs(f, w).weights, "feat", "weight") == [("i:i", 0.25)]
