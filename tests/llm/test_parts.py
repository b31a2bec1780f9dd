"""The operators' own parts: codes, coverings, trees, bundles, encoders, rules."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from skein.llm import byte_bpe, sharding, simhash_cover, token_store, warc_bundle
from skein.llm.common import Scratch, text_bytes

TEXT = st.lists(st.text(alphabet=st.sampled_from(list("abcXYZ019 '.,!#\n\t\r\u00a0\u2003\x1c\x85éß日🎉s t l d m re ve")), max_size=40), max_size=8)


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def tik(vocabulary):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.rank, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_bpe_equals_the_library(vocabulary, tik, texts):
    ids, offsets = vocabulary.encode(*text_bytes(pa.array(texts, pa.string())))
    for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == tik.encode_ordinary(t)
        assert vocabulary.decode(ids[a:b]) == t.encode()


def test_bpe_of_long_pieces(vocabulary, tik):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abcde") for _ in range(n)) for n in (23, 24, 25, 40, 511, 512, 513, 3000)] + ["!" * 900, "9" * 600]
    ids, offsets = vocabulary.encode(*text_bytes(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [tik.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_cached_cuts_encode_like_whole_texts(texts):
    enc = token_store.encoder(P.path("byte_bpe_50k.json"))
    ids, offsets = enc.encode(*text_bytes(pa.array(texts, pa.string())))
    whole = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == whole


def test_added_tokens_in_texts_encode_like_the_library():
    from tokenizers import Tokenizer
    path, end = P.path("byte_bpe_50k.json"), "<|endoftext|>"
    tok = Tokenizer.from_file(path)  # as the library sets it
    assert tok.encode(f"a {end} b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    texts = [f"a {end} b", "plain text, it's", "", None, end, f"{end}{end}x  {end}\n\ny", "cut <|endof", "text|> over texts", f"é{end[:-1]} {end[1:]}", f"end{end}", "last one"]
    for some in (texts, texts[::-1], [end], ["", end, ""]):
        ids, offsets = token_store.Encoder(path).encode(*text_bytes(pa.array(some, pa.string())))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [tok.encode(t or "", add_special_tokens=False).ids for t in some]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|", "endoftext", "|>", " ", "a", "é", "\n", "it's"]), max_size=8).map("".join), max_size=6))
def test_texts_around_added_tokens_encode_like_the_library(texts):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    ids, offsets = token_store.encoder(path).encode(*text_bytes(pa.array(texts, pa.string())))
    whole = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == whole


def test_recent_keeps_a_bounded_number(vocabulary):
    from skein.llm.cuts import Recent
    r = Recent(10)
    for i in range(500):
        keys = [b"hot", str(i).encode()]
        new = r.missing(keys)
        assert r.values(keys, {k: k + k for k in new}) == [b"hothot", keys[1] * 2]
    assert len(r.young) + len(r.old) <= 24 and b"hot" in r.young | r.old


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=3000))
def test_any_token_of_a_segment_is_read_alone(values):
    ids = np.array(values, np.uint32)
    seg = token_store.Segment(token_store.pack_segment(ids))
    assert seg.at(np.arange(len(ids))).tolist() == values
    places = np.array(random.Random(1).sample(range(len(ids)), min(5, len(ids))), np.int64)
    assert seg.at(places).tolist() == ids[places].tolist()
    for a, b in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids) - len(ids) // 5, len(ids))):
        assert seg.span(a, b).tolist() == values[a:b]


def test_documents_may_span_segments(tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT", 64)
    rnd = np.random.default_rng(3)
    sizes, w = [1, 200, 3, 64, 1], token_store.Writer(str(tmp_path / "x.dac"))
    ids = [rnd.integers(0, 2**20, n).astype(np.uint32) for n in sizes]
    for k, x in enumerate(ids):
        w.add(np.array([k]), np.array([k == 0]), np.array([len(x)]), x)
    assert w.close()[:2] == (5, sum(sizes))
    r = token_store.Reader(str(tmp_path / "x.dac"))
    assert r.nulls.tolist() == [True, False, False, False, False]
    for k, x in enumerate(ids):
        assert r.tokens(int(r.begin[k]), int(r.begin[k + 1])).tolist() == x.tolist()
    assert r.tokens(150, 151).tolist() == [np.concatenate(ids)[150]]


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash_cover.masks(radius, list(range(64)))
    rnd = random.Random(radius)
    for _ in range(3000):
        diff = sum(1 << b for b in rnd.sample(range(64), radius))
        assert any(not m & diff for m in masks)
    part = [p for p in range(64) if not masks[0] >> p & 1]
    inner = simhash_cover.masks(radius, part)
    for _ in range(300):
        diff = sum(1 << b for b in rnd.sample(part, radius))
        assert any(not m & diff for m in inner)


@pytest.mark.parametrize("bucket", [1 << 14, 3])
def test_components_with_split_buckets(spark, bucket):
    """Chains, dense balls and equal fingerprints; small buckets force the second covering."""
    rnd = random.Random(7)
    prints = [0, (1 << 64) - 1]
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(12):
            prints.append(x)
            y = x if rnd.random() < 0.5 else prints[-1]
            x = y
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                x ^= 1 << b
    prints += prints[:20]
    rows = [(i if i % 17 else None, p) for i, p in enumerate(prints)]
    df = spark.createDataFrame([(i, simhash_cover.signed(p)) for i, p in rows], "id long, fp long")
    got = simhash_cover.components(df, "id", Scratch(spark, "t"), 3, bucket).select("id", "fp", "component_id").collect()
    want = sorted(((i, simhash_cover.signed(p), c) for (i, p), c in zip(rows, brute.components(rows), strict=True)), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_one_document_of_each_group_stays(spark):
    df = spark.createDataFrame([(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "other words here now"), (None, None), (None, "")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in simhash_cover.one_of_each(df).collect()), key=repr)
    assert len(got) == 3 and got[:2] == [(1, "a b c d e"), (2, "other words here now")]
    assert got[2][0] is None and not got[2][1]      # null and empty text are one group


def test_one_document_of_each_group_with_repeated_and_null_ids(spark):
    """Near-equal texts under one id, or under none, are one group; far texts are not."""
    base = " ".join(f"w{i}" for i in range(400))
    near, far = [base + " " + x for x in ("", "x", "y")], "nothing like the others at all"
    rows = [(1, near[0]), (1, near[1]), (1, near[1]), (2, near[2]), (1, far)]
    prints = {t: brute.simhash(t) for t in (*near, far)}
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a in near for b in near) and (prints[far] ^ prints[base + " "]).bit_count() > 3
    keep = lambda rows: [(r.doc_id, r.text) for r in simhash_cover.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    got = keep(rows)
    assert len(got) == 2 and (1, far) in got and all(k == 1 for k, _ in got)
    got = keep([(None, t) for _, t in rows])
    assert len(got) == 2 and (None, far) in got
    assert keep([(None, near[0]), (3, near[1])]) == [(3, near[1])]


def test_repeated_windows_are_told_by_both_halves_of_their_names():
    import skein.llm.recompress as R
    send = {0: [(7, 1), (7, 3), (9, 9)], 1: [(7, 1), (8, 5), (9, 9)], 2: [(7, 2), (8, 6)], 3: [(9, 9), (7, 2)]}
    sent = pa.concat_tables([pa.Table.from_batches([R._packed(k, 1, *np.array(rows, np.uint64).T)]) for k, rows in send.items()])
    got = R._shared(sent)
    told = {}
    for blob, batch in zip(got["names"].to_pylist(), got["batch"].to_pylist(), strict=True):
        told[batch] = list(map(tuple, np.frombuffer(blob, "<u8").reshape(-1, 2).tolist()))
    assert told == {0: [(7, 1), (9, 9)], 1: [(7, 1), (9, 9)], 2: [(7, 2)], 3: [(7, 2), (9, 9)]}
    pairs = [np.array(c, np.uint64) for c in zip((7, 1), (7, 2), (9, 9), strict=True)]
    asked = [(7, 2), (7, 3), (9, 9), (9, 1), (8, 1), (7, 1), (10, 1)]
    assert R._member_pairs(*np.array(asked, np.uint64).T, pairs).tolist() == [True, False, True, False, False, True, False]
    assert not R._member_pairs(*np.array(asked, np.uint64).T, [np.zeros(0, np.uint64)] * 2).any()


def _leaves(tree, keys, spark):
    from pyspark.sql import functions as F
    return [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long").coalesce(1).select(sharding.place(F.col("k"), tree)).collect()]


def test_tree_draws_follow_weights_and_confine_movement(spark):
    keys = list(range(20_000))
    leaf = lambda i, w=1.0: sharding.Node(f"s{i}", w, i)
    rack = lambda n, *c: sharding.Node(n, children=c)
    a = rack("a", rack("a0", leaf(0), leaf(1, 3.0)), rack("a1", leaf(2)))
    b, b2 = rack("b", rack("b0", leaf(3, 5.0))), rack("b", rack("b0", leaf(3, 7.0)))
    one, two = _leaves(sharding.Node("root", children=(a, b)), keys, spark), _leaves(sharding.Node("root", children=(a, b2)), keys, spark)
    share = [one.count(i) / len(keys) for i in range(4)]
    assert all(abs(x - y) < 0.02 for x, y in zip(share, [0.1, 0.3, 0.1, 0.5], strict=True))
    assert all(x == y or y == 3 for x, y in zip(one, two, strict=True))          # only into the heavier subtree
    tree = sharding.default_tree(16)
    for n in (16, 17, 18, 19):
        more = sharding.grown(tree, n)
        x, y = _leaves(tree, keys, spark), _leaves(more, keys, spark)
        assert all(i == j or j == n for i, j in zip(x, y, strict=True)) and 0.5 < y.count(n) * (n + 1) / len(keys) < 1.5
        assert more == sharding.default_tree(n + 1)
        tree = more


def test_records_are_read_from_one_frame(spark, tmp_path):
    pages = [(i, f"http://x/{i}", "<p>" + f"page {i} " * (40_000 if i == 3 else 200 + i)) for i in range(12)]
    pages += [(20, "http://y", pages[5][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    old = warc_bundle.FRAME
    records, index = warc_bundle.archive(df)
    seen = {r.id: r for r in records.collect()}
    assert seen[5].record_type == "revisit" and seen[5].refers_to == 20 and seen[5].payload_bytes == len(pages[5][2])
    text = {k: h for k, _, h in pages}
    for r in index.collect():
        head, payload = warc_bundle.BundleReader(r.path).record(r.frame, r.offset)
        assert head["WARC-Record-ID"] == f"<urn:page:{r.id}>"
        if head["WARC-Type"] == "response":
            assert payload.decode() == text[r.id] and head["WARC-Target-URI"].startswith("http://")
    assert warc_bundle.FRAME == old


def test_bundles_are_plain_zstandard(tmp_path, monkeypatch):
    import zstandard
    monkeypatch.setattr(warc_bundle, "FRAME", 300)
    path = str(tmp_path / "b.warc.zst")
    b, raw = warc_bundle.Bundle(path), []
    places = []
    for i in range(9):
        raw.append(warc_bundle.record(i, None if i == 4 else "u\nv", "response", None, 50 + i, "d", b"x\r\n\r\n" * (10 + i)))
        places.append(b.add(raw[-1]))
    b.close()
    with open(path, "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == b"".join(raw)
    r = warc_bundle.BundleReader(path)
    assert len(r.sizes) > 3
    for i, (frame, offset) in enumerate(places):
        assert r.record(frame, offset)[1] == b"x\r\n\r\n" * (10 + i)


def test_rules_compile_to_one_projection(spark):
    from skein.llm import quality_rules as Q
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    text = Q.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text
