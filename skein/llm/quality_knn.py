"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

Texts become counts of hashed terms: the words themselves and their shapes (runs of upper
case, lower case, digits or one symbol taken as one), with marks for a word that repeats
its neighbour. The square roots of the term shares, weighted by inverse document frequency
and projected on the leading right singular vectors of the labelled matrix, are a text's
latent vector. The labelled vectors (at most ``TRAIN`` rows, a fixed sample by hashed id) are
broadcast; every document takes exact cosine products with all of them, block by block, and
its ``NEIGHBOURS`` nearest vote with weights that grow with the similarity.

Weights, basis and labelled vectors are fitted on that bounded sample; all documents are
scored, each in the task that reads it, without a shuffle.

Weights, basis and vectors are whole numbers (steps of 1 / ``STEP``, ``UNIT``), held as float64,
and every product is a sum of whole numbers below 2^53: it is exact, so a score does not depend
on the other texts of its block or on the order of a sum.

Defined results: a text without words has no vector and gets the sample's share of label 1;
equal texts get equal scores; of equally near rows the one of smaller id votes; an id with
several labels has the least, one with several texts that of the least hash; without any
labelled row every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import batch_rows, pieces, ship, text_bytes, with_columns, word_bounds, word_names

TRAIN = 4000
BINS = 4096
SHAPES = 1024  # of the bins, those of shapes and marks
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 4
STEP = 1 << 12  # of a weighted term share: at most 1 times ln(TRAIN + 1) + 1, below 2^16 steps
UNIT = 1 << 18  # of the basis and of a vector's coordinates
MOST = 1 << 16  # labelled rows: a product of vectors and a row's number share 53 bits

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a"):ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")


def term_shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed terms, a row for each text."""
    docs = len(offsets) - 1
    starts, stops, first = word_bounds(data, offsets)
    if len(starts) == 0:
        return np.zeros((docs, BINS), np.float32)
    doc = np.repeat(np.arange(docs), np.diff(first))
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    words = word_names(lower, starts, stops, 11)
    shape = _SHAPE[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = shape[1:] != shape[:-1]
    new[starts] = True
    place = np.cumsum(new) - 1  # of every byte, once runs are taken as one
    shapes = word_names(shape[new[:-1]], place[starts], place[stops - 1] + 1, 12)
    again = np.zeros(len(starts), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    term = [
        (SHAPES + words % np.uint64(BINS - SHAPES)).astype(np.int64),
        (1 + shapes % np.uint64(SHAPES - 1)).astype(np.int64),
    ]
    cell = np.concatenate([doc * BINS + term[0], doc * BINS + term[1], doc[again] * BINS])
    count = np.bincount(cell, minlength=docs * BINS).reshape(docs, BINS).astype(np.float32)
    return np.sqrt(count / np.maximum(np.diff(first), 1)[:, None].astype(np.float32))


@dataclass
class Model:
    weights: np.ndarray  # of the bins
    basis: np.ndarray  # BINS x RANK, in units
    vectors: np.ndarray  # labelled rows x RANK, of length 1, in units, by id
    labels: np.ndarray
    prior: float

    def project(self, shares: np.ndarray) -> np.ndarray:
        x = np.rint(shares * (self.weights * STEP)).astype(np.float64) @ self.basis
        x /= np.maximum(np.abs(x).max(axis=1, keepdims=True), 1)
        size = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.rint(x * (UNIT / np.where(size > 0, size, 1)))

    def score(self, shares: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled rows, in blocks of documents."""
        out = np.full(len(shares), self.prior)
        n = len(self.vectors)
        if not n:
            return out
        k = min(NEIGHBOURS, n)
        later = np.arange(n, dtype=np.float64)
        for a in range(0, len(shares), 512):
            x = self.project(shares[a:a + 512])
            near = x @ self.vectors.T
            rank = near * MOST - later  # distinct whole numbers: ties go to the smaller id
            who = np.sort(np.argpartition(-rank, k - 1, axis=1)[:, :k], axis=1)
            w = np.maximum(np.take_along_axis(near, who, axis=1) / UNIT**2, 0) ** SHARPNESS
            total = w.sum(axis=1)
            vote = (w * self.labels[who]).sum(axis=1) / np.where(total > 0, total, 1)
            some = (total > 0) & (np.abs(x).sum(axis=1) > 0)
            out[a:a + 512][some] = np.clip(vote[some], 0, 1)
        return out


def fit(shares: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """A model from the labelled rows; the basis comes from a randomised SVD."""
    n = len(shares)
    if n > MOST:
        raise ValueError(f"at most {MOST} labelled rows")
    if n == 0:
        return Model(np.ones(BINS, np.float32), np.zeros((BINS, 1)), np.zeros((0, 1)), labels, 0.5)
    weights = np.log((n + 1) / ((shares > 0).sum(axis=0) + 1)).astype(np.float32) + 1
    a = shares * weights
    rank = min(RANK, n)
    q = np.linalg.qr(a @ np.random.default_rng(seed).standard_normal((BINS, rank + 16)).astype(np.float32))[0]
    for _ in range(4):
        q = np.linalg.qr(a @ (a.T @ q))[0]
    basis = np.linalg.svd(q.T @ a, full_matrices=False)[2][:rank].T
    basis = np.rint(basis.astype(np.float64) * UNIT)
    model = Model(weights, basis, np.zeros((0, rank)), labels.astype(np.float64), float(labels.mean()))
    model.vectors = model.project(shares)
    return model


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, rows: int) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled ids that are not held out."""
    key = F.col(f"`{id_col}`")
    known = labels.where(~held_out(key) & key.isNotNull() & F.col(label).isNotNull()).groupBy(key.alias("id")).agg(F.min(label).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(rows)  # the documented bound
    src = docs.select(key.alias("id"), F.col(f"`{text}`").alias("t"))
    return src.join(F.broadcast(sample), "id").groupBy("id").agg(F.min_by("t", F.xxhash64("t")).alias("t"), F.min("label").alias("label"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN) -> Model:
    """Only the nonzero term shares of the sample reach the driver."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "t", 4 << 20):
            x = term_shares(*text_bytes(batch_rows(b, "t")))
            at = [np.flatnonzero(line) for line in x]
            yield with_columns(b, ["id", "label"], {
                "bins": pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()),
                "shares": pa.array([line[i].astype("<f4").tobytes() for line, i in zip(x, at, strict=True)], pa.binary()),
            })

    sent = training_rows(docs, labels, id_col, text, label, rows).mapInArrow(run, "id long, label int, bins binary, shares binary").toArrow()
    sent = sent.sort_by("id")
    x = np.zeros((len(sent), BINS), np.float32)
    for i, (bins, shares) in enumerate(zip(sent.column("bins").to_pylist(), sent.column("shares").to_pylist(), strict=True)):
        x[i, np.frombuffer(bins, "<u2")] = np.frombuffer(shares, "<f4")
    return fit(x, np.asarray(sent.column("label").combine_chunks(), dtype=np.float64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out and score of every document."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # TRAIN x RANK and BINS x RANK at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "t", 2 << 20):
            for a in range(0, b.num_rows, 2048):
                part = b.slice(a, 2048)
                found = sent.value.score(term_shares(*text_bytes(batch_rows(part, "t"))))
                yield with_columns(part, ["id", "held_out"], {"score": pa.array(found)})

    key = F.col(f"`{id_col}`")
    src = docs.select(key.cast("long").alias("id"), held_out(key).alias("held_out"), F.col(f"`{text}`").alias("t"))
    out = src.mapInArrow(run, "id long, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score")
