"""Encoding by backtracking, the divergence of sources and phrase mining, each against brute force."""

import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from conftest_tables import SF001, edge_tables
from skein.llm import collocations, piece_bpe, source_divergence
from skein.llm.common import text_bytes
from skein.llm.queries import QUERIES

PIECES = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    return edge_tables(spark, str(tmp_path_factory.mktemp("edge-terms")))


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.model(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


SCRAPS = [" ", "   ", "a", "e", "th", "in", "x", "\u2581", "é", "ß", "22", "\n", "漢", "\U0001F389", "\u00a0", "tion", "==", "\x00", "The", "..."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(SCRAPS), max_size=60))
def test_any_text_encodes_as_the_library_does(pieces, scraps):
    ours, lib = pieces
    text = "".join(scraps)
    ids, offsets = ours.encode(pa.array([text, None, text]))
    want = lib.encode(text, add_bos=True, add_eos=True)
    assert ids.tolist() == want + [1, 2] + want
    assert ours.decode(ids, offsets) == [lib.decode(want), "", lib.decode(want)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 270), st.integers(0, 31999)), max_size=15))
def test_any_ids_decode_as_the_library_does(pieces, ids):
    ours, lib = pieces
    assert ours.decode(np.array(ids, np.uint32), np.array([0, len(ids)])) == [lib.decode(ids)]


def test_long_runs_and_failed_places(pieces):
    ours, lib = pieces
    rnd = random.Random(2)
    texts = ["x" * 50_000, " " * 5_001, "ab" * 20_000, "".join(rnd.choice("aeinrst") for _ in range(50_000))]
    ids, offsets = ours.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == lib.encode(text, add_bos=True, add_eos=True)


def test_decoding_as_an_operator(spark):
    docs = spark.createDataFrame([(1, "some text here"), (2, None), (3, "")], "doc_id long, text string")
    coded = piece_bpe.encode(docs, PIECES).select("row.doc_id", "ids")
    back = piece_bpe.decode(coded.unionByName(spark.createDataFrame([(4, None)], coded.schema)), PIECES)
    assert {r.doc_id: r.decoded for r in back.collect()} == {1: "some text here", 2: "", 3: "", 4: ""}


@pytest.mark.parametrize("where", ["driver", "edge"])
def test_divergence_equals_dense_tables(spark, edge, where):
    d = SF001 if where == "driver" else edge
    docs = [(r.lang, r.source, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op12_source_divergence"](spark, d).collect()]
    assert Counter(got) == Counter(brute.divergence(docs))


def test_divergence_of_terms_of_all_lengths(spark):
    rnd = random.Random(4)
    stock = ["".join(rnd.choice("abcÄé") for _ in range(n)) for n in [*range(1, 40), 63, 64, 65, 200, 5000] for _ in range(2)]
    docs = [(rnd.choice(["a", "b"]), f"s{min(rnd.randint(0, 9), 5)}", " ".join(rnd.choices(stock, k=rnd.randint(0, 80)))) for _ in range(120)]
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(5)
    assert Counter(map(tuple, source_divergence.divergence(df, ranks=7).collect())) == Counter(brute.divergence(docs, ranks=7))


def test_equal_terms_are_counted_once_whatever_their_length():
    texts = ["abc abc é " + "z" * 17 + " " + "z" * 17, "abc " + "q" * 9, "abc " + "z" * 17]
    data, offsets = text_bytes(pa.array(texts))
    got = {(data[a:a + n].tobytes().decode(), int(g)): (int(c), int(d)) for part in source_divergence.count_terms(data, offsets, np.array([0, 0, 1])) for a, n, g, c, d in zip(*part, strict=True)}
    assert got == {("abc", 0): (3, 2), ("abc", 1): (1, 1), ("é", 0): (1, 1), ("z" * 17, 0): (2, 1), ("z" * 17, 1): (1, 1), ("q" * 9, 0): (1, 1)}


@pytest.mark.parametrize("where", ["driver", "edge"])
def test_phrases_equal_plain_counting(spark, edge, where):
    d = SF001 if where == "driver" else edge
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op13_collocations"](spark, d).collect()]
    assert got and Counter(got) == Counter(brute.collocations(docs))


def test_phrases_over_many_parts(spark, monkeypatch):
    """Small parts, so that every phrase is counted in several of them, and a longer phrase."""
    rnd = random.Random(6)
    docs = [(rnd.choice(["x", "y", None]), " ".join(rnd.choice(["a", "b", "c d e f", "g.", "h,i", "É"]) for _ in range(rnd.randint(0, 40)))) for _ in range(300)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    for least, longest, share, top in ((30, 4, 80, 2000), (3, 5, 60, 11), (5, 2, 100, 4)):
        got = [tuple(r) for r in collocations.phrases(df, least, longest, share, top).collect()]
        assert Counter(got) == Counter(brute.collocations(docs, least, longest, share, top))


def test_a_part_ends_when_it_is_full(monkeypatch):
    from pyspark import TaskContext
    monkeypatch.setattr(collocations, "PART", 5)
    monkeypatch.setattr(TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 3})()))
    b = [pa.RecordBatch.from_pydict({"lang": ["a", "b"], "text": ["one two. one", "B b"]})] * 2
    rows = [r for x in collocations._words(iter(b)) for r in x.to_pylist()]
    assert [(r["part"] - 3 * collocations.PARTS, r["lang"]) for r in rows if r["seq"]] == [(0, "a"), (1, "b"), (2, "a"), (3, "b")]
    assert np.frombuffer(rows[0]["seq"], np.int32).tolist() == [0, 1, -1, 0, -1]
    assert [(r["word"], r["n"]) for r in rows if r["part"] == 3 * collocations.PARTS and r["word"]] == [("one", 2), ("two", 1)]


def test_counting_rows_travel_packed():
    """A word pair takes less than half of the 19 bytes that a counting row of numbers took in a shuffle."""
    rnd = np.random.default_rng(3)
    words, place = 3000, 40_000
    seq = (words * rnd.random(place) ** 3).astype(np.int32)
    seq[::50] = -1
    local = np.arange(words, dtype=np.int32)
    ids = rnd.integers(0, 60, words) * collocations.PLACES + rnd.permutation(words)
    left, right = pa.table({"part": [7], "seq": pa.array([seq.tobytes()], pa.binary())}), pa.table({"to": [7] * words, "local": local, "id": ids})
    packets = collocations._extend(True, False, 8)(left, right).to_pylist()
    want = Counter((ids[a], ids[b]) for a, b in zip(seq[:-1], seq[1:], strict=True) if a >= 0 and b >= 0)
    relation = collocations._sequence(packets[0]["seq"])
    got, of = Counter(), {}
    for p in packets[1:]:
        head, tail, n = collocations._unpack(p["rows"], p["size"], 3)
        for i, (h, t, c) in enumerate(zip(np.cumsum(head).tolist(), tail.tolist(), n.tolist(), strict=True)):
            got[h, t] += c
            of[p["first"] + i] = (h, t)
    assert got == want and sum(len(p["rows"]) for p in packets[1:]) < 9.5 * len(want)
    assert Counter(of[i] for i in relation.tolist() if i >= 0) == want


@pytest.mark.parametrize("total", [1, 3, 10**9 + 7, 9 * 10**15])
def test_scaled_division_is_exact(spark, total):
    from pyspark.sql import functions as F
    from skein.llm.common import scaled
    counts = sorted({0, 1, total // 3, total - 1, total})
    df = spark.createDataFrame([(c, total) for c in counts], "c long, t long")
    got = [r[0] for r in df.select(scaled(F.col("c"), F.col("t"), 3)).collect()]
    assert got == [10**9 * c // total for c in counts]
