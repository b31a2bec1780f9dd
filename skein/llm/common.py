"""Helpers shared by the operators: scratch tables, files in the shared folder, hashing.

Every intermediate table lives below the folder that ``spark.checkpoint.dir`` names, so
it survives a lost executor. Python tasks address files there by URI (``pyarrow.fs``).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import nullcontext
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import checkpoint_root, shuffles_dropped

ROW = "row"  # struct with every column of the input, so that no name can clash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(df: DataFrame) -> DataFrame:
    """The whole input row as the single struct column ``row``."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(ROW))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def field(name: str) -> Column:
    """A column of the input inside ``row``."""
    return F.col(ROW).getField(name)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Scratch:
    """Tables and files of one run of an operator, below the shared folder."""

    def __init__(self, spark: SparkSession, name: str, drop_shuffles: bool = False):
        self.spark, self.drop_shuffles = spark, drop_shuffles
        self.root = f"{checkpoint_root(spark)}/skein-llm/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, partition_by: str | None = None, codec: str = "zstd") -> DataFrame:
        """Write ``df`` as Parquet and return the table read back: a cut in the lineage."""
        writer = df.write.option("compression", codec)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with shuffles_dropped(self.spark) if self.drop_shuffles else nullcontext():
            writer.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables of this run that nothing reads any more."""
        for name in names:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def uri(path: str) -> str:
    """A URI that ``pyarrow.fs`` takes; a bare path is a local one."""
    if re.match(r"file:/", path):
        return "file://" + re.sub(r"^file:/+", "/", path)
    return path if "://" in path else "file://" + os.path.abspath(path)


def open_fs(path: str):
    """(filesystem, path inside it) for a folder or file URI, usable in Python tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri(path))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, whatever folder the driver runs in."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="skein-py-"), "skein_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(os.path.join(top, "skein")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def batch_rows(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The kept columns of a batch beside new ones."""
    arrays = [batch_rows(batch, k) for k in keep] + list(new.values())
    return pa.RecordBatch.from_arrays(arrays, names=[*keep, *new])


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a piece have about ``limit`` bytes
    (a longer single text is a piece of its own), which bounds the arrays made from them."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        slot = np.cumsum(_lengths(batch_rows(batch, text))) // limit
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(col.cast(pa.large_binary())), 0))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, offsets); a null text has no bytes."""
    col = col.cast(pa.large_binary()).fill_null(b"")
    if col.offset:
        col = pa.concat_arrays([col])
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=8)
def _random_bytes(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(h: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (every input bit reaches every output bit)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each document) of the words ``[^\\x20\\x09-\\x0D]+``.

    ``offsets`` cut ``data`` into documents; a word never crosses a cut. ``between``: for
    each byte whether it lies between words.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~between[data]
    begins, ends = solid.copy(), np.empty(n + 1, bool)
    begins[1:] &= ~solid[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins[cuts] |= solid[cuts]
    ends[0] = False
    ends[1:n] = solid[:-1] & ~solid[1:]
    ends[n] = solid[-1]
    ends[cuts] |= solid[cuts - 1]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends)
    return starts, stops, np.searchsorted(starts, offsets)


def word_names(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit name of each word: a polynomial over randomised bytes, then mixed.

    Words of over 1,000 bytes are named by xxhash, since long polynomials modulo 2**64
    have known collisions.
    """
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    size = stops - starts
    long = np.flatnonzero(size > 1000)
    base = 0x9E3779B97F4A7C15 + 2 * seed
    at = np.minimum(size, 1000)
    first = np.cumsum(at) - at
    inside = np.arange(int(at.sum())) - np.repeat(first, at)
    value = _random_bytes(seed)[data[np.repeat(starts, at) + inside]] * powers(base, 1000)[inside]
    h = mix64(np.add.reduceat(value, first) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if len(long):
        import xxhash

        for i in long.tolist():
            h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:stops[i]].tobytes(), seed=seed)
    return h


def window_names(names: np.ndarray, first: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, 64-bit name) of every window of ``width`` words inside one document.

    ``first``: the first word of each document, and the number of words at the end.
    """
    n = len(names)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    base = 0xC2B2AE3D27D4EB4F + 4 * seed
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(names * powers(base, n), out=total[1:])
    size = np.diff(first)
    last = np.repeat(first[1:], size)  # end of the document of each word
    at = np.flatnonzero(np.arange(n) + width <= last)
    back = powers(pow(base, -1, 2**64), n)
    return at, mix64((total[at + width] - total[at]) * back[at])


#: Bytes with A-Z in lower case.
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32


def scaled(count: Column, total: Column, thousands: int) -> Column:
    """floor(1000**thousands * count / total) for 0 <= count <= total, exact in 64 bits.

    Long division by digits of 1000: no product passes 1000 * total, so it holds for totals up
    to 9e15, and beyond that ANSI arithmetic fails instead of giving a wrong number.
    """
    whole = lambda x: F.call_function("div", x, total)
    out, rest = whole(count), count % total
    for _ in range(thousands):
        out, rest = out * 1000 + whole(rest * 1000), (rest * 1000) % total
    return out


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
