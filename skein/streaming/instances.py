"""Instance stream: two topics -> union -> parse -> instances per micro-batch (STR-01, SNK-05)."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.constants import BATCH_DIR_PATTERN
from skein.operators.instances import parse_instances, routed_lines

_PY_PATTERN = BATCH_DIR_PATTERN.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d") \
    .replace("HH", "%H").replace("mm", "%M").replace("ss", "%S")


def instance_stream(impressions: DataFrame, clicks: DataFrame, lang: str, col: str = "line") -> DataFrame:
    """Streaming instances from the impression and click line streams (duplicates kept)."""
    return parse_instances(impressions.select(col).unionByName(clicks.select(col)), lang, col)


def batch_dir(base: str, when: dt.datetime, tag: str | None = None) -> str:
    """FN-16 on the driver: ``base/yyyy-MM-dd/HH_mm_ss[/tag]`` for a batch time."""
    path = f"{base}/{when.strftime(_PY_PATTERN)}"
    return f"{path}/{tag}" if tag else path


def batch_time(spark: SparkSession, root: str, batch_id: int, now_ms: Callable[[], int]) -> int:
    """The time of a micro-batch: taken once, stored under ``root``, and read again when the
    batch is retried, so that a retry writes where the first attempt wrote."""
    path = f"{root}/_times/batch_id={batch_id}"
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        spark.range(1).select(F.lit(now_ms()).cast("bigint").alias("ms")).write.mode("overwrite").parquet(path)
    return spark.read.schema("ms bigint").parquet(path).first()["ms"]


def dump_instances(output_dir: str | None, now_ms: Callable[[], int] = lambda: int(time.time() * 1000)):
    """SNK-05: a ``foreachBatch`` handler writing each batch's instances below its batch path.

    The path holds the stored time of the batch and its id: a retried batch overwrites its
    own output.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if output_dir is None:
            return
        ms = batch_time(batch.sparkSession, output_dir, batch_id, now_ms)
        when = dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc)
        batch.write.mode("overwrite").parquet(f"{batch_dir(output_dir, when)}/data/instance/batch={batch_id}")

    return handle


def route_batches(root: str, lang: str, col: str = "line"):
    """STR-01 with a home for every line: a ``foreachBatch`` handler that parses a batch once and
    writes instances, rejected and skipped lines below ``root/batch_id=<id>``.

    One job writes all outputs, so they appear together; a retried batch overwrites its own.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed_lines(batch.select(col), lang, col).write.mode("overwrite").partitionBy("out").parquet(f"{root}/batch_id={batch_id}")

    return handle


ROUTED = "line string, reason string, user string, items array<string>, label double, batch_id long, out string"


def routed(spark: SparkSession, root: str, out: str) -> DataFrame:
    """The lines that ``route_batches`` sent to ``out``, with their batch; only its folders are read."""
    return spark.read.schema(ROUTED).parquet(root).where(F.col("out") == out).drop("out")


def routed_instances(spark: SparkSession, root: str) -> DataFrame:
    """The instances of all batches, as ``instance_stream`` gives them."""
    return routed(spark, root, "instances").select("user", F.explode("items").alias("item"), "label")


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """The malformed lines of all batches, with the kind whose schema they fail."""
    return routed(spark, root, "rejected").select("batch_id", "line", "reason")
