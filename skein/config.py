"""Session settings and the shared folder used for lineage cuts and state versions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job relies on. They are only applied when the session has not set them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
#: Tables bucketed by one column meet on that and further columns without a shuffle.
BUCKETED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def configure(spark: SparkSession, values: dict[str, str] = DEFAULTS) -> SparkSession:
    """Set the values above where the session does not state its own."""
    stated = spark.conf.getAll
    for key, value in values.items():
        if key not in stated:
            spark.conf.set(key, value)
    return spark


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def shuffles_dropped(spark: SparkSession):
    """Jobs inside delete their shuffle files when they end (what they write is stored), instead of
    at some later collection of garbage."""
    return _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def buckets_scanned(spark: SparkSession):
    """Tables in buckets are read one bucket a task inside, also where no join asks for it: what is
    written from one has a file a bucket, however many tasks its bytes would make."""
    return _set(spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"})


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; a local test session without one gets a fresh folder, which
    is then registered as the checkpoint directory so ``DataFrame.checkpoint`` works.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        # A machine-local folder would not survive a lost executor: the cluster must name one.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    root = tempfile.mkdtemp(prefix="skein-ckpt-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder for one written table."""
    return f"{checkpoint_root(spark)}/skein/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder: the table read back and its path.

    Cuts the lineage, prunes columns on later reads, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def store_bucketed(df: DataFrame, name: str, buckets: int, key: str | list[str], deal: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` bucketed by ``key`` in the shared folder: the table read back and its name.

    Tables of the same number of buckets join and aggregate by ``key`` without a shuffle.
    ``deal``: shuffle ``df`` by ``key`` first, where it is not in that order already.
    """
    spark = df.sparkSession
    table = f"skein_{name}_{uuid.uuid4().hex}"
    keys = [key] if isinstance(key, str) else key
    writer = (df.repartition(buckets, *keys) if deal else df).write.bucketBy(buckets, *keys).format("parquet")
    writer.option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table), table


def append_bucketed(df: DataFrame, table: str, buckets: int, key: str) -> DataFrame:
    """Add rows, in bucket order, to a table that ``store_bucketed`` wrote: the table read back."""
    df.write.mode("append").bucketBy(buckets, key).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Forget a bucketed table that nothing reads any more, and delete its files."""
    path = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {table}")
    drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
