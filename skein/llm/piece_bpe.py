"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

A token sequence is the result of the merges exactly if every two adjacent tokens are: the
merges over their joined text give those two tokens back. So a text is encoded from the
left: at each place the longest vocabulary match is tried (an Aho-Corasick automaton has
found the longest match at every place in one pass), then ever shorter prefixes of it; a
token is taken if it is compatible with the one before, which a re-merge of both decides
(remembered for each pair). Where no token fits, the place is marked in a bitfield of failed
positions and the token before is taken back. A place is reached in one way only, since the
tokens up to it are the merges of the text up to it; so a mark holds for good and the work
is linear in the text but for the re-merges, whose length is bounded by two vocabulary
entries.

A batch is first cut where no vocabulary entry holds the two neighbouring bytes, so that no
merge can cross; each distinct cut is encoded once and kept in a bounded cache of its
Python worker. Nothing is shuffled: a row in, a row out; a cut of any length takes the
same way.

Vocabularies: BPE with byte fallback, identity normalisation, a space put in front, white
space kept; others are refused when read.

Defined results: a null or empty text has the begin and end ids alone and decodes to ''; equal
rows get equal results; an empty table gives an empty table; columns of any name pass inside
``row``. An id outside the vocabulary fails the decoding.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from skein.llm.common import ROW, batch_rows, field, packed, pieces, ship, text_bytes, with_columns
from skein.llm.cuts import Recent, distinct, spell

SPACE = "▁"   # stands for a space in the vocabulary
# Kinds of vocabulary entries in the model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECE = 2 << 20    # bytes of text encoded at once
CACHE = 80_000     # distinct cuts kept in a worker, twice
PAIRS = 1 << 20    # pair verdicts kept in a worker


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 2: None, 5: 4}[tag & 7]
        size = number() if size is None else size
        yield tag >> 3, data[at:at + size]
        at += size


class Model:
    """The vocabulary of one model file: encoder and decoder."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, "rb") as f:
            parts = list(_message(f.read()))
        trainer = dict(_message(next(v for k, v in parts if k == 2)))
        normal = dict(_message(next(v for k, v in parts if k == 3)))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or normal.get(2) or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError(f"{path}: needs BPE with byte fallback, identity normalisation, a space in front and white space kept")
        entry = [dict(_message(v)) for k, v in parts if k == 1]
        name = [e[1].decode() for e in entry]
        kind = [e.get(3, NORMAL) for e in entry]
        if set(kind) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: user-defined and unused entries are not supported")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.id = {p: i for i, p in enumerate(name) if kind[i] == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(name) if kind[i] == BYTE}
        score = {p: struct.unpack("<f", entry[i][2])[0] for p, i in self.id.items()}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in score.items()}
        self._fits: dict[tuple[str, str], bool] = {}
        self._shorter: dict[str, str | None] = {}
        self.matches = ahocorasick.Automaton()
        for p in self.id:
            if self.merged(p) == [p]:       # others never come out of the merges
                self.matches.add_word(p, p)
        self.matches.make_automaton()
        self.together = np.zeros((256, 256), bool)   # bytes that some entry has side by side
        for p in self.id:
            raw = np.frombuffer(p.replace(SPACE, " ").encode(), np.uint8)
            self.together[raw[:-1], raw[1:]] = True
        self.together[:, 0x80:0xC0] = True           # inside a character
        self._surfaces(name, kind, trainer.get(44, b" \xe2\x81\x87 "))
        self.cache = Recent(CACHE)

    def _surfaces(self, name: list[str], kind: list[int], unknown: bytes) -> None:
        text = [b"" if k == CONTROL else unknown if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() for p, k in zip(name, kind, strict=True)]
        self.size = np.fromiter(map(len, text), np.int64, len(text))
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(text), np.uint8)
        self.spaced = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(name, kind, strict=True)])
        self.silent = np.array([k == CONTROL for k in kind])
        self.lone = np.array([k == BYTE for k in kind])

    # --- encoding ----------------------------------------------------------------
    def merged(self, text: str) -> list[str]:
        """The merges over ``text``: the best pair first, of equal ones the leftmost."""
        out, rank = list(text), self.rank
        worst = len(rank)
        ranks = [rank.get(a + b, worst) for a, b in zip(out, out[1:], strict=False)]
        while ranks and (best := min(ranks)) < worst:
            i = ranks.index(best)
            out[i:i + 2] = [out[i] + out[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get(out[i] + out[i + 1], worst)
            if i:
                ranks[i - 1] = rank.get(out[i - 1] + out[i], worst)
        return out

    def fits(self, left: str, right: str) -> bool:
        """Whether the merges leave these two tokens side by side."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= PAIRS:
                self._fits.clear()
            known = self._fits[left, right] = self.merged(left + right) == [left, right]
        return known

    def shorter(self, token: str) -> str | None:
        """The next shorter vocabulary entry that ``token`` starts with, at last its first
        character (which need not be an entry), then None."""
        if token not in self._shorter:
            if len(self._shorter) >= PAIRS:
                self._shorter.clear()
            found = [token[:n] for n in range(len(token) - 1, 1, -1) if token[:n] in self.matches]
            self._shorter[token] = found[0] if found else token[0] if len(token) > 1 else None
        return self._shorter[token]

    def tokens(self, text: str) -> list[str]:
        """The merges over ``text``, found by backtracking."""
        n = len(text)
        longest = list(text)
        for last, token in self.matches.iter(text):     # longer matches of a place come later
            longest[last + 1 - len(token)] = token
        failed = bytearray((n >> 3) + 1)
        out: list[str] = []
        at, token = 0, longest[0] if n else None
        while at < n:
            before = out[-1] if out else None
            while token is not None:
                stop = at + len(token)
                if not failed[stop >> 3] >> (stop & 7) & 1 and (before is None or self.fits(before, token)):
                    break
                token = self.shorter(token)
            if token is None:
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= len(token)
            else:
                out.append(token)
                at = stop
                token = longest[at] if at < n else None
        return out

    def coded(self, cut: bytes) -> bytes:
        """Ids (little-endian unsigned 32 bits) of one cut."""
        ids: list[int] = []
        for token in self.tokens(cut.decode().replace(" ", SPACE)):
            known = self.id.get(token)
            ids.extend([known] if known is not None else [self.byte[b] for b in token.replace(SPACE, " ").encode()])
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with their begin and end ids, offsets)."""
        texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), SPACE, " ")
        front = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
        data, offsets = text_bytes(pc.binary_join_element_wise(front, texts, pa.scalar("", pa.large_string())))
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.together[data[:-1], data[1:]]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        each, which = distinct(data, starts)
        new = {c: self.coded(c) for c in self.cache.missing(each)}
        ids, stops = spell(self.cache.values(each, new), which, np.searchsorted(starts, offsets))
        count = len(texts)
        ends = stops + 2 * np.arange(count + 1)
        out = np.empty(len(ids) + 2 * count, np.uint32)
        out[np.arange(len(ids)) + np.repeat(2 * np.arange(count) + 1, np.diff(stops))] = ids
        out[ends[:-1]], out[ends[1:] - 1] = self.begin, self.end
        return out, ends

    # --- decoding ----------------------------------------------------------------
    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of all documents' ids."""
        ids = ids.astype(np.int64)
        size = self.size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        data = self.flat[np.repeat(self.at[ids] - total[:-1], size) + np.arange(int(total[-1]))].tobytes()
        # The space in front goes: it is the first character of the first entry that is not silent.
        loud = np.append(np.flatnonzero(~self.silent[ids]), len(ids))
        head = loud[np.searchsorted(loud, offsets[:-1])]
        strip = (head < offsets[1:]) & np.append(self.spaced[ids], False)[head]
        quiet = np.concatenate([[0], np.cumsum(self.silent[ids])])
        out = []
        for a, b, skip, i, j in zip(total[offsets[:-1]].tolist(), total[offsets[1:]].tolist(), strip.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if j - i > 2 and quiet[j - 1] > quiet[i + 1]:   # a silent entry inside parts the bytes around it
                out.append(self._repaired(ids[i:j], skip))
                continue
            raw = data[a + skip:b]
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(self._repaired(ids[i:j], skip))
        return out

    def _repaired(self, ids: np.ndarray, skip: bool) -> str:
        """The text where byte entries do not make up UTF-8: each such byte is U+FFFD."""
        out, run = [], b""

        def flush() -> None:
            nonlocal run
            while run:
                for n in range(1, 5):
                    try:
                        out.append(run[:n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                run = run[n:]

        for i in ids.tolist():
            text = self.flat[self.at[i]:self.at[i] + self.size[i]].tobytes()
            if self.lone[i]:
                run += text
                continue
            flush()
            if self.silent[i]:
                continue
            out.append(text[skip:].decode())
            skip = False
        flush()
        return "".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def _binaries(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    data = ids.astype("<u4").tobytes()
    cut = (4 * offsets).tolist()
    return pa.array([data[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``row`` (the input's columns but the text) and ``ids``: binary, little-endian unsigned
    32-bit integers with the begin and end ids; with ``decoded`` also the text that those ids
    decode to, made in the same task."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c != text]
    src = packed(docs).select(F.struct(F.lit(True).alias("here"), *[field(c).alias(f"c{i}") for i, c in enumerate(rest)]).alias("k"), field(text).alias("t"))
    back = F.struct(*[F.col("k").getField(f"c{i}").alias(c) for i, c in enumerate(rest)] or [F.lit(True).alias("here")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = model(path)
        for b in pieces(batches, "t", PIECE):
            ids, offsets = voc.encode(batch_rows(b, "t"))
            new = {"ids": _binaries(ids, offsets)}
            if decoded:
                new["decoded"] = pa.array(voc.decode(ids, offsets), pa.string())
            yield with_columns(b, ["k"], new)

    more = [StructField("decoded", StringType())] if decoded else []
    schema = StructType([src.schema["k"], StructField("ids", BinaryType()), *more])
    return src.mapInArrow(run, schema).select(back.alias(ROW), "ids", *[f.name for f in more])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The input (with a binary column ``ids``; null: none) and ``decoded``, the text of its ids."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = model(path)
        for b in pieces(batches, "ids", 2 * PIECE):
            data, offsets = text_bytes(batch_rows(b, "ids"))
            yield with_columns(b, b.schema.names, {"decoded": pa.array(voc.decode(data.view("<u4"), offsets // 4), pa.string())})

    return encoded.mapInArrow(run, StructType([*encoded.schema, StructField("decoded", StringType())]))
