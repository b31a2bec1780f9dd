"""Substring deduplication by recompression (Jez 2013) over word sequences.

Every word has a 64-bit name. A run round names each maximal run of two or more equal
words; then each pair round splits the alphabet in two by a bit of the names and names
every adjacent (left, right) pair. Names are hashes of what they stand for, so all
executors name alike without a shared dictionary, and equal substrings get equal symbols
but for at most one symbol a side and round. A repeated window of ``window`` words
therefore holds, in its middle, only symbols that occur at least twice in the corpus.

1. The input is written once, with a batch number per 8,192 rows.
2. Every batch is compressed; its top-level symbols travel as sorted packed arrays, one
   for each range of names, at most two of a kind per array (a symbol of a third of all
   rows is one entry a batch). Each range finds the symbols met twice.
   A run longer than the window counts twice: it alone repeats a window.
3. Only windows whose middle consists of such shared symbols are candidates. Their
   128-bit names (hashes of the whole word sequence, not its words) take the same way and
   verify the repeats: a window counts only if its name starts somewhere else too.
4. Every batch removes the words of its repeated windows, by all 128 bits.

Both exchanges are cut into ranges by the size of the corpus, so that a range has a bounded
share of it. Answers return as tables partitioned by batch in the shared folder.

Defined results: a null or empty text has no words, keeps nothing and removes nothing;
equal rows repeat each other; a text shorter than the window is left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from skein.llm.common import (
    ROW, Scratch, batch_rows, field, mix64, open_fs, packed, pieces, ship, text_bytes, window_names, with_columns, word_bounds, word_names,
)

PIECE = 4 << 20  # bytes of text made into arrays at once
FLUSH = 1 << 20  # names gathered before they are sent
RANGE_BYTES = 64 << 20  # corpus bytes for each range of names


def rounds_for(window: int) -> int:
    """Pair rounds after which a window still has certain symbols in its middle: each side
    loses at most 2**rounds words."""
    r = 0
    while 2 ** (r + 1) * 2 < window and r < 3:
        r += 1
    return r


def compress(names: np.ndarray, doc: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first word of each) after one run round and ``rounds`` pair rounds.

    ``doc``: the document of each word; symbols never cross a document.
    """
    n = len(names)
    if n == 0:
        return names, np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    sym, owner = names[at], doc[at]
    run = size > 1  # a run keeps one name whatever its length, and never pairs
    sym = np.where(run, mix64(sym ^ np.uint64(0xA5A5A5A5DEADBEEF)), sym)
    for k in range(rounds):
        left = (mix64(sym + np.uint64(0x51ED270B * (k + 1))) & np.uint64(1)).astype(bool)
        pair = left[:-1] & ~left[1:] & ~run[:-1] & ~run[1:] & (owner[:-1] == owner[1:])
        head = np.flatnonzero(pair)
        sym[head] = mix64(sym[head] * np.uint64(0x9E3779B97F4A7C15) + mix64(sym[head + 1] + np.uint64(k + 1)))
        keep = np.ones(len(sym), bool)
        keep[head + 1] = False
        sym, at, owner, run = sym[keep], at[keep], owner[keep], run[keep]
    return sym, at


def _at_most_two(values: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted, with at most two of each value (of each row of values)."""
    cols = [values, *more]
    order = np.lexsort(tuple(reversed(cols))) if more else np.argsort(values, kind="stable")
    cols = [c[order] for c in cols]
    if len(values) > 2:
        third = np.zeros(len(values), bool)
        third[2:] = np.logical_and.reduce([c[2:] == c[:-2] for c in cols])
        cols = [c[~third] for c in cols]
    return tuple(cols)


def _packed(batch: int, ranges: int, *cols: np.ndarray) -> pa.RecordBatch:
    """One row for each nonempty range: (part, batch, packed arrays)."""
    cols = _at_most_two(*cols)
    bits = ranges.bit_length() - 1  # ranges is a power of two: the top bits are the range
    part = cols[0] >> np.uint64(64 - bits) if bits else np.zeros(len(cols[0]), np.uint64)
    cut = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
    at = np.flatnonzero(np.diff(cut))
    data = {f"v{j}": pa.array([c[cut[i]:cut[i + 1]].astype("<u8").tobytes() for i in at.tolist()], pa.binary()) for j, c in enumerate(cols)}
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.full(len(at), batch, np.int64)), *data.values()], names=["part", "batch", *data])


def _shared(group: pa.Table) -> pa.Table:
    """Of one range: the names that occur twice or more, for every batch that has them; the
    parts of a name lie one after another."""
    cols = [c for c in group.column_names if c[0] == "v"]
    blobs = {c: group.column(c).to_pylist() for c in cols}
    size = np.array([len(x) // 8 for x in blobs["v0"]])
    joined = [np.frombuffer(b"".join(blobs[c]), "<u8") for c in cols]
    owner = np.repeat(np.asarray(group.column("batch")), size)
    order = np.lexsort((*reversed(joined),))
    same = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in joined])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    value, owner = [c[order][twice] for c in joined], owner[order][twice]
    by = np.lexsort((*reversed(value), owner))
    value, owner = np.stack([c[by] for c in value], axis=1), owner[by]
    if len(value):
        keep = np.ones(len(value), bool)
        keep[1:] = (value[1:] != value[:-1]).any(axis=1) | (owner[1:] != owner[:-1])
        value, owner = value[keep], owner[keep]
    batches, first = np.unique(owner, return_index=True)
    cut = [*first.tolist(), len(value)]
    return pa.table({"names": pa.array([value[a:b].astype("<u8").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()), "batch": pa.array(batches.astype(np.int64))})


class _Answers:
    """The shared names of one batch, read from its folder in the shared store: a sorted
    array for each of the ``parts`` of a name."""

    def __init__(self, root: str, parts: int = 1):
        self.root, self.parts, self.batch, self.names = root, parts, None, []

    def of(self, batch: int) -> list[np.ndarray]:
        if batch != self.batch:
            import pyarrow.parquet as pq
            from pyarrow import fs

            store, path = open_fs(f"{self.root}/batch={batch}")
            files = [f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
            blobs = []
            for f in files:
                with store.open_input_file(f) as source:
                    blobs += pq.ParquetFile(source).read(columns=["names"]).column(0).to_pylist()
            rows = np.frombuffer(b"".join(blobs), "<u8").astype(np.uint64).reshape(-1, self.parts)
            rows = rows[np.lexsort(tuple(reversed(rows.T)))]
            self.names = [np.ascontiguousarray(c) for c in rows.T]
            self.batch = batch
        return self.names


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if len(sorted_set) == 0:
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def _member_pairs(one: np.ndarray, other: np.ndarray, sorted_pairs: list[np.ndarray]) -> np.ndarray:
    """Whether both halves of a name are those of one pair of the set."""
    first, second = sorted_pairs
    hit = np.zeros(len(one), bool)
    who = np.flatnonzero(_member(one, first))
    at = np.searchsorted(first, one[who])
    while len(who):  # pairs of equal first halves, one after another: as a rule there is one
        hit[who] |= second[at] == other[who]
        at = at + 1
        more = at < len(first)
        more[more] = first[at[more]] == one[who[more]]
        who, at = who[more], at[more]
    return hit


def _by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Pieces of rows of one batch number."""
    for b in pieces(batches, "t", PIECE):
        number = np.asarray(batch_rows(b, "batch"))
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), b.num_rows]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(number[x]), b.slice(x, y - x)


def _words(piece: pa.RecordBatch):
    data, offsets = text_bytes(batch_rows(piece, "t"))
    starts, stops, first = word_bounds(data, offsets)
    return data, starts, stops, first


def _send(found: Iterator[tuple[int, tuple[np.ndarray, ...]]], ranges: int) -> Iterator[pa.RecordBatch]:
    """Gather names of one batch until there are enough for a packed record batch."""
    held: list[tuple[np.ndarray, ...]] = []
    now, n = None, 0
    for batch, cols in found:
        if held and (batch != now or n >= FLUSH):
            yield _packed(now, ranges, *[np.concatenate(c) for c in zip(*held, strict=True)])
            held, n = [], 0
        now = batch
        if len(cols[0]):
            held.append(cols)
            n += len(cols[0])
    if held:
        yield _packed(now, ranges, *[np.concatenate(c) for c in zip(*held, strict=True)])


def _meet(sent: DataFrame, scratch: Scratch, name: str) -> str:
    """Exchange packed names by range and store, by batch, those met twice."""
    shared = sent.groupBy("part").applyInArrow(_shared, "names binary, batch long")
    scratch.write(shared.repartition("batch"), name, partition_by="batch", codec="uncompressed")
    return scratch.path(name)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = 35, keep_layout: bool = False) -> DataFrame:
    """``row`` (the input's columns but the text), ``n_words``, ``n_removed`` and
    ``kept_text``: the kept words joined by one space. With ``keep_layout`` a text that
    loses no word stays as it is, white space and null included."""
    if window < 2:
        raise ValueError("a window has two words at least")
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "recompress")
    rest = [c for c in docs.columns if c != text]
    src = packed(docs).select(
        F.struct(F.lit(True).alias("here"), *[field(c).alias(f"c{i}") for i, c in enumerate(rest)]).alias("k"),
        field(text).alias("t"),
        F.shiftright(F.monotonically_increasing_id(), 13).alias("batch"),
    )
    kept = scratch.write(src, "input")
    corpus = kept.agg(F.coalesce(F.sum(F.octet_length("t").cast("long")), F.lit(0))).first()[0]
    ranges = 1
    while ranges * RANGE_BYTES < corpus:
        ranges *= 2
    rounds = rounds_for(window)
    loss = 2**rounds

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for number, piece in _by_batch(batches):
                data, starts, stops, first = _words(piece)
                doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
                sym, at = compress(word_names(data, starts, stops, 1), doc, rounds)
                long = np.diff(np.append(at, len(starts))) > window  # a run that repeats a window by itself
                yield number, (np.concatenate([sym, sym[long]]),)
        yield from _send(found(), ranges)

    at_symbols = _meet(kept.select("t", "batch").mapInArrow(symbols, "part int, batch long, v0 binary"), scratch, "symbols")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = _Answers(at_symbols)

        def found():
            for number, piece in _by_batch(batches):
                data, starts, stops, first = _words(piece)
                doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
                names = word_names(data, starts, stops, 1)
                sym, at = compress(names, doc, rounds)
                size = np.diff(np.append(at, len(names)))
                lone = np.repeat(~_member(sym, answers.of(number)[0]), size)  # words of symbols met once
                seen = np.concatenate([[0], np.cumsum(lone)])
                start, one = window_names(names, first, window, 1)
                ok = seen[start + window - loss] == seen[start + loss]
                if not ok.any():
                    continue
                other = window_names(word_names(data, starts, stops, 2), first, window, 2)[1]
                yield number, (one[ok], other[ok])
        yield from _send(found(), ranges)

    at_windows = _meet(kept.select("t", "batch").mapInArrow(windows, "part int, batch long, v0 binary, v1 binary"), scratch, "windows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = _Answers(at_windows, 2)
        for number, piece in _by_batch(batches):
            data, starts, stops, first = _words(piece)
            cover = np.zeros(len(starts) + 1, np.int64)
            repeated = answers.of(number)
            if len(repeated[0]) and len(starts):
                start, one = window_names(word_names(data, starts, stops, 1), first, window, 1)
                if _member(one, repeated[0]).any():
                    other = window_names(word_names(data, starts, stops, 2), first, window, 2)[1]
                    hit = start[_member_pairs(one, other, repeated)]
                    np.add.at(cover, hit, 1)
                    np.add.at(cover, hit + window, -1)
            gone = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
            removed = gone[first[1:]] - gone[first[:-1]]
            n = np.diff(first)
            texts = batch_rows(piece, "t").cast(pa.large_binary()).to_pylist()
            out = []
            for i, t in enumerate(texts):
                if keep_layout and removed[i] == 0:
                    out.append(t)
                elif removed[i] == n[i]:
                    out.append(b"")
                elif removed[i] == 0:
                    out.append(b" ".join(t.split()))
                else:
                    left = np.diff(gone[first[i]:first[i + 1] + 1]) == 0
                    out.append(b" ".join(w for w, keep in zip(t.split(), left.tolist(), strict=True) if keep))
            yield with_columns(piece, ["k"], {
                "n_words": pa.array(n.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)),
                "kept_text": pa.array(out, pa.binary()).cast(pa.string()),
            })

    schema = StructType([*kept.select("k").schema, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])
    done = kept.select("k", "t", "batch").mapInArrow(cut, schema)
    back = F.struct(*[F.col("k").getField(f"c{i}").alias(c) for i, c in enumerate(rest)] or [F.lit(True).alias("here")])
    return done.select(back.alias(ROW), "n_words", "n_removed", "kept_text")
