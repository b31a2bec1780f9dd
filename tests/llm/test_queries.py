"""Every opN query against brute force: on the driver's tables, on edge rows, on empty tables."""

import random
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import brute
from conftest_tables import SF001, edge_tables, empty_tables
from skein.llm import url_rules
from skein.llm.queries import QUERIES

BPE = P.path("byte_bpe_multi_50k.tiktoken")
PIECES = P.path("piece_bpe_32k.model")


def _tables(spark, d):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{d}/pages.parquet").collect()]
    return docs, items, pages


EXPECT = {
    "op2_token_dac": lambda docs, items, pages: brute.tokens(docs, P.path("byte_bpe_50k.json")),
    "op3_decontaminate": lambda docs, items, pages: brute.decontaminate(docs, items),
    "op6_recompress": lambda docs, items, pages: brute.repeats(docs),
    "op7_quality_rules": lambda docs, items, pages: brute.base_counts(docs),
    "op8_simhash_cover": lambda docs, items, pages: brute.simhash_groups(docs),
    "op9_byte_bpe": lambda docs, items, pages: brute.bpe(docs, BPE),
    "op11_piece_bpe": lambda docs, items, pages: brute.sentencepiece_ids(docs, PIECES),
    "op10_warc_bundles": lambda docs, items, pages: brute.warc([(k, h) for k, _, h in pages]),
}


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    return edge_tables(spark, str(tmp_path_factory.mktemp("edge")))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return empty_tables(spark, str(tmp_path_factory.mktemp("empty")))


@pytest.mark.parametrize("key", EXPECT)
@pytest.mark.parametrize("where", ["driver", "edge"])
def test_matches_brute_force(spark, edge, key, where):
    d = SF001 if where == "driver" else edge
    got = [tuple(r) for r in QUERIES[key](spark, d).collect()]
    if key == "op7_quality_rules":
        assert not any(r[7] and r[6] for r in got)      # what fails the base is not kept
        got = [r[:7] for r in got]
    assert Counter(got) == Counter(EXPECT[key](*_tables(spark, d)))


@pytest.mark.parametrize("key", QUERIES)
def test_empty_tables_give_no_rows(spark, empty, key):
    assert QUERIES[key](spark, empty).count() == 0


@pytest.mark.parametrize("where", ["driver", "edge"])
def test_shards_obey_the_key_law(spark, edge, where):
    d = SF001 if where == "driver" else edge
    rows = QUERIES["op1_hash_tree_shards"](spark, d).collect()
    docs, _, _ = _tables(spark, d)
    import zlib
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in docs)
    assert {r.law for r in rows} == {"key"}
    assert all(r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16 for r in rows)
    by_key = {}
    for r in rows:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
    for s in range(16):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("where", ["driver", "edge"])
def test_url_verdicts(spark, edge, where):
    d = SF001 if where == "driver" else edge
    rows = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in QUERIES["op4_url_rules"](spark, d).collect()}
    _, _, pages = _tables(spark, d)
    src = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url")
    host, path = url_rules.parts(F.col("url"))
    toks = {r.url: tuple(r.t) for r in src.select("url", url_rules.tokens(F.col("url"), host, path).alias("t")).collect()}
    told = {u: brute.url_rule(*brute.url_parts(u), url_rules.GIVEN) for _, u, _ in pages}
    every = brute.rules_from([(toks[u], told[u][1]) for _, u, _ in pages], url_rules.SUPPORT, url_rules.CONFIDENCE)
    mined = {r: x for r, x in every.items() if r[1]}      # urls without a verdict only count against a rule
    want = set()
    for k, u, _ in pages:
        rule, verdict = told[u]
        if verdict is None:
            fire = [(conf, len(c), sup, v) for (c, v), (conf, sup) in mined.items() if set(c) <= set(toks[u])]
            verdict = max(fire)[3] if fire else "allow"
        want.add((k, *brute.url_parts(u), rule, verdict))
    assert rows == want


def test_undecided_urls_count_against_mined_rules(spark):
    """Verdicts by plain counting over all pages; what the given rules only select stays allowed."""
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url")
    host, path = url_rules.parts(F.col("url"))
    toks = {r.page_id: (r.url, tuple(r.t)) for r in pages.select("page_id", "url", url_rules.tokens(F.col("url"), host, path).alias("t")).collect()}
    told = {k: brute.url_rule(*brute.url_parts(u), url_rules.GIVEN)[1] for k, (u, _) in toks.items()}
    mined = {r: x for r, x in brute.rules_from([(t, told[k]) for k, (_, t) in toks.items()], url_rules.SUPPORT, url_rules.CONFIDENCE).items() if r[1]}
    got = {r.page_id: r.verdict for r in QUERIES["op4_url_rules"](spark, SF001).collect()}
    for k, (_, t) in toks.items():
        fire = [(conf, len(c), sup, v) for (c, v), (conf, sup) in mined.items() if set(c) <= set(t)]
        assert got[k] == (told[k] or (max(fire)[3] if fire else "allow"))
    undecided = [k for k, v in told.items() if v is None]
    assert undecided and {got[k] for k in undecided} == {"allow"}


def test_a_rule_that_holds_among_all_urls_still_fires(spark):
    urls = [(f"http://a{i}.org/x/{i}.exe", "block") for i in range(19)] + [("http://b.org/x/1.exe", None)] + [(f"http://c{i}.org/x/{i}", None) for i in range(20)]
    told = spark.createDataFrame(urls, "url string, verdict string")
    pages = spark.createDataFrame([(1, "http://new.org/y/9.exe"), (2, "http://new.org/x/9")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_rules.judge(pages, told).collect()} == {1: "block", 2: "allow"}


def test_urls_are_matched_without_an_exchange(spark):
    out = url_rules.judge(spark.read.parquet(f"{SF001}/pages.parquet"))
    main = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_quality_scores_find_the_labels(spark):
    d = "/root/testdata/sf0.01"
    rows = QUERIES["op5_quality_knn"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_quality_scores_on_edge_rows(spark, edge):
    rows = QUERIES["op5_quality_knn"](spark, edge).collect()
    docs, _, _ = _tables(spark, edge)
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_neighbour_votes_equal_a_plain_loop():
    import numpy as np
    from skein.llm import quality_knn as K
    rng = np.random.default_rng(1)
    x = np.sqrt(rng.random((40, K.BINS), dtype=np.float32) * (rng.random((40, K.BINS)) < 0.02))
    model = K.fit(x, (rng.random(40) < 0.5).astype(float))
    y = np.sqrt(rng.random((9, K.BINS), dtype=np.float32) * (rng.random((9, K.BINS)) < 0.02))
    y[3] = 0
    got = model.score(y)
    for i, line in enumerate(model.project(y)):
        sims = sorted(((float(line @ v) / K.UNIT**2, -n) for n, v in enumerate(model.vectors)), reverse=True)[:K.NEIGHBOURS]
        sims = [(s, -n) for s, n in sims]
        w = [(max(s, 0) ** K.SHARPNESS, n) for s, n in sims]
        total = sum(a for a, _ in w)
        want = model.prior if i == 3 else sum(a * model.labels[n] for a, n in w) / total
        assert abs(got[i] - want) < 1e-9
    assert [model.score(y[i:i + 1])[0] for i in range(len(y))] == got.tolist()
    assert model.score(y[::-1]).tolist() == got[::-1].tolist()


def test_quality_model_does_not_depend_on_the_order_of_texts(spark):
    import numpy as np
    from skein.llm import quality_knn as K
    docs = [(i, f"word{i % 7} some text {i}") for i in range(60)] + [(i, f"other words here {i}") for i in range(0, 60, 3)] + [(5, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    models = [K.train(spark.createDataFrame(d, "doc_id long, text string").repartition(n), labels)
              for d, n in ((docs, 3), (docs[::-1], 1), (docs + docs, 5))]
    for m in models[1:]:
        assert np.array_equal(m.vectors, models[0].vectors) and np.array_equal(m.labels, models[0].labels)


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline as C
    docs, items, _ = _tables(spark, SF001)
    keep = {r.doc_id for r in QUERIES["op7_quality_rules"](spark, SF001).where("kept").collect()}
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in C.run(spark, SF001).collect()]
    assert Counter(got) == Counter(brute.pipeline(docs, items, BPE, keep))


def test_pipeline_on_edge_and_empty_tables(spark, edge, empty):
    import corpus_pipeline as C
    assert C.run(spark, empty).count() == 0
    # Ids repeat and are null on edge rows, so the stages are held to brute force by their texts.
    rows = spark.read.parquet(f"{edge}/documents.parquet").select("doc_id", "text").collect()
    kept = Counter((r.doc_id, r.text) for r in C.good_documents(spark, spark.read.parquet(f"{edge}/documents.parquet"), edge).collect())
    good = [(n, r.doc_id, r.text) for n, r in enumerate(rows) if (r.doc_id, r.text) in kept]
    assert sum(kept.values()) == len(good)
    groups = brute.components([(n, brute.simhash(t)) for n, _, t in good])
    last = C.run(spark, edge).collect()
    assert 0 < len(last) <= len(set(groups))
    assert len({r.ids_sha256 for r in last}) == len(last)
    names = spark.read.parquet(f"{edge}/documents.parquet").columns
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, docs, edge).columns == names, name


def test_random_repeats_with_small_windows(spark):
    """Few words, many runs and periods: all shapes of overlap, in several ranges of names."""
    import skein.llm.recompress as R
    rnd = random.Random(3)
    docs = []
    for k in range(150):
        parts = [rnd.choice(["a", "b", "a b", "a a", "c", "b c a"]) for _ in range(rnd.randint(0, 25))]
        docs.append((k, " ".join(parts) + rnd.choice(["", " d" * rnd.randint(0, 60), " x y" * rnd.randint(0, 30)])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    old = R.RANGE_BYTES
    R.RANGE_BYTES = 1024
    try:
        for n in (2, 5, 11, 35):
            got = R.remove_repeats(df, window=n).select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
            assert Counter(map(tuple, got)) == Counter(brute.repeats(docs, n)), n
    finally:
        R.RANGE_BYTES = old
