"""Token ids in directly addressable codes (Brisaboa, Ladra, Navarro 2013).

A file holds the ids of a run of documents in ascending order of their ids. It is cut into
segments of ``SEGMENT`` tokens. In a segment every id is split into 8-bit chunks, lowest
first: level 0 has a chunk of every token, level k the chunk k of those that reach it. A
bitmap per level marks the tokens that continue, and a directory holds the number of marks
before every 512 bits, so that the place of a token's next chunk is one rank: any token is
read from a few bytes, without decoding what lies before it.

    file    = magic, segments, documents (id, null mark, tokens), segment table, footer
    segment = tokens u64, levels u8, then per level: chunks u64, chunks, bitmap, directory

Writing: a range shuffle on the document id gives each task a contiguous run, which it
sorts, encodes and writes as it goes; a file's name holds the task attempt, and only files
that the committed manifest names are read, so a repeated attempt does no harm. Reading:
one task a file, with the tokens before it from the manifest (a row per file).

Defined results: the string of an added token (``<|endoftext|>``) in a text is that token's
id, as the library has it by default; a null or empty text has the end id alone; null document ids come first;
rows that repeat an id keep the order of the input; an empty table writes no file.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import Scratch, batch_rows, make_folder, open_fs, pieces, ship, text_bytes
from skein.llm.cuts import Recent, cuts, distinct, spell

MAGIC = b"SKDAC001"
SEGMENT = 1 << 20
BLOCK = 512
CACHE = 250_000
PLAIN = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _byte_chars() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for each byte: printable bytes stand
    for themselves, the others for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


class Encoder:
    """Whole texts to ids with the tokenizers library; distinct cuts are encoded once. A text
    that holds the string of an added token goes through the library whole, since cuts may
    fall inside that string."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.cache = Recent(CACHE)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets)."""
        held = self._holds_added(data, offsets)
        if not held.any():
            return self._by_cuts(data, offsets)
        size = np.diff(offsets)
        ids, at = self._by_cuts(data[np.repeat(~held, size)], np.concatenate([[0], np.cumsum(np.where(held, 0, size))]))
        whole = [data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in np.flatnonzero(held).tolist()]
        whole = [e.ids for e in self.tok.encode_batch_fast(whole, add_special_tokens=False)]
        n = np.diff(at)
        n[held] = [len(x) for x in whole]
        mine = np.repeat(held, n)
        out = np.empty(len(mine), "<u4")
        out[~mine] = ids
        out[mine] = np.fromiter(chain.from_iterable(whole), "<u4")
        return out, np.concatenate([[0], np.cumsum(n)])

    def _holds_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts hold the string of an added token."""
        held, raw = np.zeros(len(offsets) - 1, bool), data.tobytes()
        for t in self.added:
            at = raw.find(t)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, "right")) - 1
                inside = at + len(t) <= offsets[i + 1]  # not over the end of a text
                held[i] |= inside
                at = raw.find(t, int(offsets[i + 1]) if inside else at + 1)
        return held

    def _by_cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of texts without added tokens, offsets)."""
        starts, first = cuts(data, offsets)
        each, which = distinct(data, starts)
        new = self.cache.missing(each)
        gc.disable()  # a million short-lived objects that hold no cycles
        try:
            coded = self._spelled(new)
        finally:
            gc.enable()
        return spell(self.cache.values(each, coded), which, first)

    def _spelled(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct cuts. A word of Latin letters is one piece of the pattern, so its
        bytes, in the characters that stand for them, go to the model directly; other cuts
        take the whole tokenizer."""
        word, model, as_bytes = PLAIN.fullmatch, self.tok.model.tokenize, _BYTE_CHARS
        plain, rest, ids, others = [], [], [], []
        for c in new:
            t = c.decode()
            if word(t):
                plain.append(c)
                ids.append([x.id for x in model(c.decode("latin-1").translate(as_bytes))])
            else:
                rest.append(c)
                others.append(t)
        for a in range(0, len(rest), 20_000):
            ids += [e.ids for e in self.tok.encode_batch_fast(others[a:a + 20_000], add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        stop = list(accumulate(4 * len(x) for x in ids))
        return {c: flat[i:j] for c, i, j in zip(chain(plain, rest), [0, *stop], stop)}  # noqa: B905


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack_segment(ids: np.ndarray) -> bytes:
    """The bytes of one segment."""
    levels, left = [], ids.astype(np.uint32)
    while True:
        more = left > 0xFF
        bits = np.packbits(more, bitorder="little")
        marks = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(marks)[:-1]]).astype("<u4") if len(more) else np.zeros(0, "<u4")
        levels.append(struct.pack("<Q", len(left)) + (left & np.uint32(0xFF)).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        left = left[more] >> np.uint32(8)
        if not len(left):
            break
    return struct.pack("<QB", len(ids), len(levels)) + b"".join(levels)


class Segment:
    """Random access to the ids of one packed segment."""

    def __init__(self, raw: bytes):
        self.n, count = struct.unpack_from("<QB", raw, 0)
        at, self.levels = 9, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", raw, at)
            at += 8
            chunks = np.frombuffer(raw, np.uint8, n, at)
            bits = np.frombuffer(raw, np.uint8, -(-n // 8), at + n)
            ranks = np.frombuffer(raw, "<u4", -(-n // BLOCK), at + n + len(bits))
            padded = np.zeros(-(-n // BLOCK) * (BLOCK // 8), np.uint8)
            padded[:len(bits)] = bits
            self.levels.append((chunks, padded, ranks))
            at += n + len(bits) + 4 * len(ranks)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at the given places, each found by ranks alone."""
        out = np.zeros(len(places), np.uint32)
        who, places = np.arange(len(places)), places.astype(np.int64)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[who] |= chunks[places].astype(np.uint32) << np.uint32(8 * k)
            go = (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
            who, places = who[go], places[go]
            if not len(who):
                break
            block = places // BLOCK
            used, row = np.unique(block, return_inverse=True)  # marks inside the blocks asked for
            inside = np.bitwise_count(bits.reshape(-1, BLOCK // 8)[used]).astype(np.int64)
            inside = np.cumsum(inside, axis=1) - inside
            byte = (places >> 3) - block * (BLOCK // 8)
            part = bits[places >> 3] & ((1 << (places & 7)) - 1).astype(np.uint8)
            places = ranks[block].astype(np.int64) + inside[row, byte] + np.bitwise_count(part)
        return out


    def span(self, a: int, b: int) -> np.ndarray:
        """The ids at the places a to b - 1: a run of places is a run on every level, whose
        begin is one rank."""
        out, who = np.zeros(b - a, np.uint32), np.arange(b - a)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[who] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * k)
            more = np.unpackbits(bits[a >> 3:(b + 7) >> 3], bitorder="little")[a & 7:(a & 7) + b - a].astype(bool)
            who = who[more]
            if not len(who):
                break
            block = a // BLOCK
            inside = np.unpackbits(bits[block * (BLOCK // 8):(a >> 3) + 1], bitorder="little")[:a - block * BLOCK]
            a = int(ranks[block]) + int(inside.sum())
            b = a + len(who)
        return out


class Writer:
    """Streams documents into one file."""

    def __init__(self, path: str):
        self.store, self.path = open_fs(path)
        self.out = self.store.open_output_stream(self.path, compression=None)
        self.out.write(MAGIC)
        self.at, self.table, self.held, self.n = len(MAGIC), [], [], 0
        self.ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def add(self, ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, tokens: np.ndarray) -> None:
        self.ids.append(ids)
        self.nulls.append(nulls)
        self.sizes.append(sizes)
        self.held.append(tokens)
        self.n += len(tokens)
        while self.n >= SEGMENT:
            every = np.concatenate(self.held)
            self._segment(every[:SEGMENT])
            self.held, self.n = [every[SEGMENT:]], len(every) - SEGMENT

    def _segment(self, ids: np.ndarray) -> None:
        raw = pack_segment(ids)
        self.out.write(raw)
        self.table.append((self.at, len(raw), len(ids)))
        self.at += len(raw)

    def close(self) -> tuple[int, int, int]:
        """(documents, tokens, bytes) of the finished file."""
        if self.n:
            self._segment(np.concatenate(self.held))
        docs = self.at
        sizes = np.concatenate(self.sizes).astype("<i8")
        tail = np.concatenate(self.ids).astype("<i8").tobytes() + np.concatenate(self.nulls).astype(np.uint8).tobytes() + sizes.tobytes()
        segments = np.array(self.table, "<i8").tobytes()
        footer = struct.pack("<QQQQ", docs, len(sizes), docs + len(tail), len(self.table)) + MAGIC
        self.out.write(tail + segments + footer)
        self.out.close()
        return len(sizes), int(sizes.sum()), self.at + len(tail) + len(segments) + len(footer)


class Reader:
    """Documents, or single tokens, of one file."""

    def __init__(self, path: str):
        store, inside = open_fs(path)
        self.file = store.open_input_file(inside)
        size = self.file.size()
        foot = self.file.read_at(40, size - 40)
        if foot[32:] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        docs, n, at, segments = struct.unpack("<QQQQ", foot[:32])
        raw = self.file.read_at(17 * n, docs)
        self.ids = np.frombuffer(raw, "<i8", n)
        self.nulls = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.sizes = np.frombuffer(raw, "<i8", n, 9 * n)
        self.table = np.frombuffer(self.file.read_at(24 * segments, at), "<i8").reshape(-1, 3)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.last: tuple[int, Segment | None] = (-1, None)

    def segment(self, i: int) -> Segment:
        if self.last[0] != i:
            at, size, _ = self.table[i].tolist()
            self.last = (i, Segment(self.file.read_at(size, at)))
        return self.last[1]

    def tokens(self, a: int, b: int) -> np.ndarray:
        """The ids at the places a to b - 1 of the file."""
        parts = []
        while a < b:
            i = a // SEGMENT
            stop = min(b, (i + 1) * SEGMENT)
            parts.append(self.segment(i).span(a - i * SEGMENT, stop - i * SEGMENT))
            a = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_tokens(docs: DataFrame, folder: str, load: Callable[[], Encoder], id_col: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Write the files; the result is their manifest (part, path, docs, tokens, bytes),
    which the caller has to commit as a table."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, path = TaskContext.get(), None, ""
        for b in pieces(batches, "t", 4 << 20):
            if out is None:
                path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.dac"
                out = Writer(path)
            ids, offsets = load().encode(*text_bytes(batch_rows(b, "t")))
            size = np.diff(offsets) + 1
            line = np.full(int(size.sum()), end_id, np.uint32)
            line[np.arange(len(ids)) + np.repeat(np.arange(len(size)), size - 1)] = ids
            key = batch_rows(b, "id")
            out.add(np.asarray(key.fill_null(0)), np.asarray(key.is_null()), size, line)
        if out is not None:
            docs_n, tokens, size = out.close()
            yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "path": [path], "docs": [docs_n], "tokens": [tokens], "bytes": [size]}, schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]))

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"), F.monotonically_increasing_id().alias("tie"))
    run_of = src.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "t")
    return run_of.mapInArrow(run, "part int, path string, docs long, tokens long, bytes long")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``id``, ``start`` (tokens of all documents before), ``n_tokens`` and ``ids`` (packed
    little-endian unsigned 32 bits) of every document, from the files."""
    ship(manifest.sparkSession)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long").alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = Reader(path)
                step = 0
                while step < len(f.sizes):
                    stop = max(step + 1, int(np.searchsorted(f.begin, f.begin[step] + SEGMENT, "right")) - 1)
                    first, last = int(f.begin[step]), int(f.begin[stop])
                    raw = f.tokens(first, last).astype("<u4").tobytes()
                    at = (f.begin[step:stop + 1] - first) * 4
                    yield pa.RecordBatch.from_arrays([
                        pa.array(f.ids[step:stop], mask=f.nulls[step:stop]), pa.array(f.begin[step:stop] + base), pa.array(f.sizes[step:stop]),
                        pa.array([raw[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary()),
                    ], names=["id", "start", "n_tokens", "ids"])
                    step = stop

    # A task for each file, whatever their sizes tell adaptive execution.
    return files.repartitionByRange(max(1, manifest.count()), "path").mapInArrow(run, "id long, start long, n_tokens long, ids binary")


def store(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Write the token files of ``docs`` in the shared folder and read them back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    make_folder(docs.sparkSession, scratch.path("files"))
    manifest = scratch.write(write_tokens(docs, scratch.path("files"), lambda: encoder(tokenizer), id_col, text, end_id), "manifest")
    return read_tokens(manifest)
