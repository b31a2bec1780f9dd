"""Streaming sources: event topics as string streams (SRC-17).

With a Kafka connector on the classpath the topics are read with
``format("kafka")``; otherwise (and in tests) any file source stands in, with an
explicit schema as file streams require.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """``(key, value)`` strings of one topic (needs the Kafka connector jar)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**options).load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def file_stream(spark: SparkSession, directory: str, glob: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file source over ``directory`` restricted to ``glob``; schema taken from the files once."""
    schema = spark.read.format(fmt).load(f"{directory}/{glob}").schema
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def run_available(query_builder, checkpoint: str, batch_fn=None, sink_path: str | None = None, fmt: str = "parquet"):
    """Start a query that processes everything available, then stops (``availableNow``)."""
    w = query_builder.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if batch_fn is not None:
        q = w.foreachBatch(batch_fn).start()
    else:
        q = w.format(fmt).option("path", sink_path).outputMode("append").start()
    q.awaitTermination()
    return q
