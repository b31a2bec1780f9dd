"""Byte-level BPE encoding and decoding with numpy matrices.

A text is cut where the pattern of the vocabulary never matches across (before a space or
white space run), distinct cuts are split by the pattern, and distinct pieces are encoded
together: pieces of like length form a padded matrix of ids beside a matrix of the ids that
each adjacent pair would merge into. Every round, each row merges its leftmost pair of the
smallest rank, both matrices close the gap (compaction) and the one or two new pairs are
looked up in an open-addressing hash table; finished rows leave. Pieces of over ``LONG``
bytes, where rounds would cost the square of the length, take the same merges from a heap.

Cuts seen before come from a cache of bounded size in each Python worker, so a word of a
third of all texts is encoded once a worker. Nothing is shuffled: a row in, a row out.

Defined results: a null or empty text has no ids and decodes to nothing; equal rows get
equal results; ids outside the vocabulary fail the decoding.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from skein.llm.common import ROW, batch_rows, field, packed, pieces, ship, text_bytes, with_columns
from skein.llm.cuts import Recent, cuts, distinct, spell

NONE = np.int32(2**31 - 1)
LONG = 512
CELLS = 1 << 18
PIECE = 2 << 20  # bytes of text encoded at once
CACHE = 80_000


class Vocabulary:
    """Ranks of byte strings, the pair table and the decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        self.byte = np.full(256, NONE, np.int32)
        for i in range(256):
            self.byte[i] = self.rank[bytes([i])]
        size = max(self.rank.values()) + 1
        if size >= 1 << 16:
            raise ValueError("pair keys hold two 16-bit ids")
        self.text: list[bytes] = [b""] * size
        for token, r in self.rank.items():
            self.text[r] = token
        pairs = [(a << 16 | b, r) for t, r in self.rank.items() for i in range(1, len(t)) if (a := self.rank.get(t[:i])) is not None and (b := self.rank.get(t[i:])) is not None]
        self._build(np.array([k for k, _ in pairs], np.uint32), np.array([r for _, r in pairs], np.int32))
        self.cache = Recent(CACHE)

    def _build(self, keys: np.ndarray, merged: np.ndarray) -> None:
        self.shift = 32 - max(4, int(4 * len(keys)).bit_length())
        size = 1 << (32 - self.shift)
        self.keys, self.merged = np.zeros(size, np.uint32), np.full(size, NONE, np.int32)
        self.used = np.zeros(size, bool)
        left, at, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(left):
            self.probes += 1
            free = left[~self.used[at[left]]]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.merged[at[put]], self.used[at[put]] = keys[put], merged[put], True
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = at[left] + 1 & size - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(self.shift)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, or NONE (also where an id is negative)."""
        out = np.full(a.shape, NONE, np.int32)
        ok = np.flatnonzero((a >= 0) & (b >= 0))
        key = a.ravel()[ok].astype(np.uint32) << np.uint32(16) | b.ravel()[ok].astype(np.uint32)
        at, flat = self._slot(key), out.ravel()
        for _ in range(self.probes):
            same = self.used[at] & (self.keys[at] == key)
            flat[ok[same]] = self.merged[at[same]]
            go = self.used[at] & ~same
            if not go.any():
                break
            ok, key, at = ok[go], key[go], at[go] + 1 & len(self.keys) - 1
        return flat.reshape(a.shape)

    def _matrix(self, group: list[bytes], width: int) -> list[bytes]:
        """Ids (little-endian unsigned 32 bits) of pieces of at most ``width`` bytes."""
        out: list[bytes] = [b""] * len(group)
        size = np.fromiter(map(len, group), np.int64, len(group))
        x = np.full((len(group), width), -1, np.int32)
        x[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(group), np.uint8)]
        r = self.look_up(x[:, :-1], x[:, 1:])
        row = np.arange(len(group))
        while len(row):
            best = r.argmin(axis=1) if r.shape[1] else np.zeros(len(row), np.int64)
            into = r[np.arange(len(row)), best] if r.shape[1] else np.full(len(row), NONE)
            done = into == NONE
            if done.any():
                ends, w = x[done], x.shape[1]
                blob, n = ends.astype("<u4").tobytes(), (ends >= 0).sum(axis=1)
                for i, (k, m) in enumerate(zip(row[done].tolist(), n.tolist(), strict=True)):
                    out[k] = blob[4 * w * i:4 * (w * i + m)]
                go = ~done
                x, r, row, best, into = x[go], r[go], row[go], best[go], into[go]
                if not len(row):
                    break
            k, w = np.arange(len(row)), x.shape[1]
            x[k, best] = into
            cols = np.arange(w - 1)
            x = np.take_along_axis(x, cols + (cols > best[:, None]), axis=1)
            if w == 2:
                r = np.zeros((len(row), 0), np.int32)
                continue
            cols = np.arange(w - 2)
            r = np.take_along_axis(r, cols + (cols >= best[:, None]), axis=1)
            here = np.flatnonzero(best < w - 2)
            r[here, best[here]] = self.look_up(x[here, best[here]], x[here, best[here] + 1])
            here = np.flatnonzero(best > 0)
            r[here, best[here] - 1] = self.look_up(x[here, best[here] - 1], x[here, best[here]])
        return out

    def _heap(self, piece: bytes) -> bytes:
        ids, n = self.byte[np.frombuffer(piece, np.uint8)].tolist(), len(piece)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        def pair(key: int) -> int | None:
            m = int(self.look_up(np.array([key >> 16], np.int32), np.array([key & 0xFFFF], np.int32))[0])
            return None if m == NONE else m

        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := pair(ids[i] << 16 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j], after[i] = m, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (t := pair(ids[left] << 16 | ids[right])) is not None:
                    heapq.heappush(heap, (t, left, ids[left], ids[right]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_pieces(self, todo: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct pieces of the pattern."""
        out: dict[bytes, bytes] = {}
        buckets: dict[int, list[bytes]] = {}
        for p in todo:
            if (whole := self.rank.get(p)) is not None:
                out[p] = whole.to_bytes(4, "little")
            elif len(p) > LONG:
                out[p] = self._heap(p)
            else:
                buckets.setdefault(len(p) if len(p) <= 24 else -(-len(p) // 16) * 16, []).append(p)
        for width, group in buckets.items():
            step = max(1, CELLS // width)
            for a in range(0, len(group), step):
                part = group[a:a + step]
                out.update(zip(part, self._matrix(part, width), strict=True))
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets) of the UTF-8 texts that ``offsets`` cut out of ``data``."""
        starts, first = cuts(data, offsets)
        each, which = distinct(data, starts)
        new = self.cache.missing(each)
        split = [self.find(c.decode()) for c in new]
        ids = self.encode_pieces({p.encode() for line in split for p in line})
        coded = {c: ids[c] if len(line) == 1 else b"".join([ids[p.encode()] for p in line]) for c, line in zip(new, split, strict=True)}
        return spell(self.cache.values(each, coded), which, first)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.text[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def _split(docs: DataFrame, text: str) -> tuple[DataFrame, Column]:
    """(the other columns as struct ``k`` beside the text ``t``, that struct by their names)."""
    rest = [c for c in docs.columns if c != text]
    src = packed(docs).select(
        F.struct(F.lit(True).alias("here"), *[field(c).alias(f"c{i}") for i, c in enumerate(rest)]).alias("k"), field(text).alias("t"),
    )
    back = F.struct(*[F.col("k").getField(f"c{i}").alias(c) for i, c in enumerate(rest)] or [F.lit(True).alias("here")])
    return src, back.alias(ROW)


def _lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``row`` (the input's columns but the text) and ``ids`` (array of int); with
    ``decoded`` also the bytes that those ids decode to, made in the same task."""
    ship(docs.sparkSession)
    src, back = _split(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path, pattern)
        for b in pieces(batches, "t", PIECE):
            ids, offsets = voc.encode(*text_bytes(batch_rows(b, "t")))
            new = {"ids": _lists(ids, offsets)}
            if decoded:
                cut = offsets.tolist()
                new["decoded"] = pa.array([voc.decode(ids[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
            yield with_columns(b, ["k"], new)

    more = [StructField("decoded", BinaryType())] if decoded else []
    schema = StructType([src.schema["k"], StructField("ids", ArrayType(IntegerType())), *more])
    return src.mapInArrow(run, schema).select(back, "ids", *[f.name for f in more])


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The input (with a column ``ids``) and ``decoded``, the bytes that its ids stand for."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path, pattern)
        for b in batches:
            col = batch_rows(b, "ids")
            values = np.asarray(col.flatten())
            stop = np.cumsum(np.asarray(col.value_lengths()).astype(np.int64))
            start = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
            done = [voc.decode(values[i:j]) for i, j in zip(start.tolist(), stop.tolist(), strict=True)]
            yield with_columns(b, b.schema.names, {"decoded": pa.array(done, pa.binary())})

    return encoded.mapInArrow(run, StructType([*encoded.schema, StructField("decoded", BinaryType())]))
