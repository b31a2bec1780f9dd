"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding whole WARC records, and at
its end the seek table of the Zstandard seekable format (a skippable frame with the
compressed and decompressed size of every frame). An index table maps record identifiers to
(bundle, frame, offset in the decompressed frame, length), so one record is read from one
frame. Frames close at ``FRAME`` bytes.

Equal payloads of at least ``least`` bytes become one response, that of the largest id, and
revisits that carry no payload but refer to it. The largest id of each digest is a
map-side combined aggregate; pages meet it in a join on the digest that adaptive execution
can split, and are written by the task that holds them. File names hold the task attempt
and only files of the committed index are read.

Defined results: a null html is an empty payload; a null url has no target header; rows
that repeat an id and a payload are records of their own: the first written is the
response; null ids lose to any other; an empty table writes nothing.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import Scratch, batch_rows, make_folder, open_fs, ship

FRAME = 1 << 20
LEVEL = 3
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2020-01-01T00:00:00Z"  # a fixed capture time: equal input gives equal bundles


def record(page_id, url: str | None, kind: str, refers_to, size: int, digest: str, payload: bytes) -> bytes:
    """One WARC/1.1 record."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    else:
        head.append("Content-Type: text/html")
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, place after the record) of the record at ``at``."""
    stop = raw.index(b"\r\n\r\n", at)
    first, *lines = raw[at:stop].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines)
    body = stop + 4
    end = body + int(head["Content-Length"])
    if raw[end:end + 4] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    return head, raw[body:end], end + 4


class Bundle:
    """Writes frames of records and the seek table."""

    def __init__(self, path: str):
        store, inside = open_fs(path)
        self.out, self.press = store.open_output_stream(inside, compression=None), zstandard.ZstdCompressor(level=LEVEL)
        self.table: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = 0

    def add(self, raw: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the added record."""
        if self.size and self.size + len(raw) > FRAME:
            self._frame()
        place = (len(self.table), self.size)
        self.held.append(raw)
        self.size += len(raw)
        return place

    def _frame(self) -> None:
        packed = self.press.compress(b"".join(self.held))
        self.out.write(packed)
        self.table.append((len(packed), self.size))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._frame()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Frames and single records of one bundle."""

    def __init__(self, path: str):
        store, inside = open_fs(path)
        self.file = store.open_input_file(inside)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table: {path}")
        table = np.frombuffer(self.file.read_at(8 * n, size - 9 - 8 * n), "<u4").reshape(-1, 2).astype(np.int64)
        self.sizes, self.at = table, np.concatenate([[0], np.cumsum(table[:, 0])])
        self.unpack = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        packed, plain = self.sizes[i].tolist()
        return self.unpack.decompress(self.file.read_at(packed, int(self.at[i])), max_output_size=plain)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        head, payload, _ = parse(self.frame(frame), offset)
        return head, payload

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for i in range(len(self.sizes)):
            raw, at = self.frame(i), 0
            while at < len(raw):
                head, payload, at = parse(raw, at)
                yield head, payload


def plan(pages: DataFrame, id_col: str, html: str, url: str, least: int) -> DataFrame:
    """Every page with its payload, digest, record type and what it refers to."""
    src = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("body"))
    src = src.withColumn("size", F.octet_length("body").cast("long"))
    src = src.withColumn("digest", F.sha1("body")).withColumn("tie", F.monotonically_increasing_id())
    groups = src.where(F.col("size") >= least).groupBy("digest").agg(F.max(F.struct("id", (-F.col("tie")).alias("col2"))).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    told = src.join(groups.select("digest", "best"), "digest", "left")
    other = F.col("best").isNotNull() & ~(F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.col2") == -F.col("tie")))
    return told.select("id", "url", F.when(other, F.lit(b"")).otherwise(F.col("body")).alias("body"), "size", "digest", F.when(other, F.lit("revisit")).otherwise(F.lit("response")).alias("kind"), F.when(other, F.col("best.id")).alias("refers_to"))


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Write the records; the result is the index, which the caller has to commit."""
    ship(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, path = TaskContext.get(), None, ""
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.zst"
                out = Bundle(path)
            names = ("id", "url", "kind", "refers_to", "size", "digest", "body")
            rows = zip(*[batch_rows(b, c).to_pylist() for c in names], strict=True)
            frames, offsets, sizes = [], [], []
            for row in rows:
                raw = record(*row)
                frame, offset = out.add(raw)
                frames.append(frame)
                offsets.append(offset)
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch_rows(b, "id"), pa.array([path] * len(sizes)), pa.array(frames, pa.int32()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())], names=["id", "path", "frame", "offset", "length"])
        if out is not None:
            out.close()

    return records.mapInArrow(run, "id long, path string, frame int, offset long, length long")


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the bundles that the index names; digests of payloads are made anew."""
    ship(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        number = lambda x: int(x[10:-1]) if x and len(x) > 11 else None  # noqa: E731  <urn:page:7>
        for b in batches:
            for path in b.column(0).to_pylist():
                held, size = [], 0
                for head, payload in BundleReader(path).records():
                    kind, n, digest = head["WARC-Type"], int(head["X-Payload-Length"]), head["WARC-Payload-Digest"][5:]
                    if kind == "response":
                        n, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    held.append((number(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), payload if kind == "response" else None, n, digest, kind, number(head.get("WARC-Refers-To"))))
                    size += len(payload)
                    if size > 8 << 20 or len(held) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    files = index.select("path").distinct()
    # A task for each bundle, whatever their sizes tell adaptive execution.
    return files.repartitionByRange(max(1, files.count()), "path").mapInArrow(run, "id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, id_col: str = "page_id", html: str = "html", url: str = "url", least: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(records read back from the bundles, index of the bundles)."""
    scratch = Scratch(pages.sparkSession, "warc")
    make_folder(pages.sparkSession, scratch.path("files"))
    src = pages.withColumn(id_col, F.col(f"`{id_col}`").cast("long"))
    index = scratch.write(write_bundles(plan(src, id_col, html, url, least), scratch.path("files")), "index")
    return read_bundles(index), index
