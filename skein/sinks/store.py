"""File formats of the model store: registry lines, dense and sparse weights, text lines.

Readers and writers are Spark jobs over the files; nothing is collected to the
driver. Output sizing follows the original constants through ``maxRecordsPerFile``;
carried-over state is sized by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.constants import SPARSE_WEIGHT_ROWS_PER_FILE, STATE_BYTES_PER_FILE
from skein.functions.text import as_float, tsv_key


# --- registry: "(key,idx)" lines -----------------------------------------------------

def registry_lines(registry: DataFrame) -> DataFrame:
    """SNK-01: ``(feat,idx)`` text, sorted by index."""
    return registry.orderBy("idx").select(F.concat(F.lit("("), "feat", F.lit(","), F.col("idx").cast("string"),
                                                   F.lit(")")).alias("value"))


def save_registry(registry: DataFrame, path: str) -> None:
    # Sorted output; range partitioning keeps the order across part files.
    registry_lines(registry).write.mode("overwrite").text(path)


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """SRC-22: parse ``(key,idx)`` lines, splitting at the last comma (Q12)."""
    lines = spark.read.text(path)
    m = F.regexp_extract("value", r"^\((.*),(-?[0-9]+)\)$", 1)
    i = F.regexp_extract("value", r"^\((.*),(-?[0-9]+)\)$", 2)
    return lines.where(F.col("value") != "").select(m.alias("feat"), i.cast("bigint").alias("idx"))


# --- dense and sparse weights ---------------------------------------------------------

WEIGHT_SCHEMA = T.StructType([T.StructField("idx", T.LongType()), T.StructField("weight", T.DoubleType())])


def weight_rows(weights: DataFrame) -> DataFrame:
    """SNK-02: (idx, weight) with the weight rounded to float like the original writer."""
    return weights.select(F.col("idx").cast("bigint").alias("idx"), as_float(F.col("weight")).alias("weight"))


def save_weights(weights: DataFrame, path: str) -> None:
    """Dense weights as ``idx<TAB>weight``; the index is stored, not implied by line order (Q13)."""
    weight_rows(weights).write.mode("overwrite").option("sep", "\t").csv(path)


def load_weights(spark: SparkSession, path: str) -> DataFrame:
    """SRC-23."""
    return spark.read.schema(WEIGHT_SCHEMA).option("sep", "\t").csv(path)


def sparse_rows(weights: DataFrame) -> DataFrame:
    """SNK-03 / PRJ-09: non-zero weights only, float-rounded."""
    return weight_rows(weights).where(F.col("weight") != 0)


def save_sparse_weights(weights: DataFrame, path: str) -> None:
    (sparse_rows(weights).write.mode("overwrite").option("sep", "\t")
     .option("maxRecordsPerFile", SPARSE_WEIGHT_ROWS_PER_FILE).csv(path))


def load_sparse_weights(spark: SparkSession, path: str, length: int | None = None) -> DataFrame:
    """SRC-24: ``idx<TAB>weight`` lines; with ``length`` densified over ``range(length)``."""
    sparse = spark.read.schema(WEIGHT_SCHEMA).option("sep", "\t").csv(path)
    if length is None:
        return sparse
    return spark.range(length).select(F.col("id").alias("idx")).join(sparse, "idx", "left").select(
        "idx", F.coalesce(F.col("weight"), F.lit(0.0)).alias("weight"))


# --- text lines -------------------------------------------------------------------------

def save_lines(df: DataFrame, path: str, col: str = "value") -> None:
    """SNK-04: one value per line."""
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-18: lines of text files (a path, directory or glob)."""
    return spark.read.text(path)


def state_lines(rows: DataFrame, cols: list[str]) -> DataFrame:
    """State rows as ``key<TAB>rest`` text lines, weights in full precision."""
    return rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in cols]).alias("value"))


def total_bytes(lines: DataFrame, col: str = "value") -> DataFrame:
    """AGG-06: Σ(length + 1) of the lines (line plus newline)."""
    return lines.agg(F.coalesce(F.sum(F.length(col) + 1), F.lit(0)).cast("bigint").alias("total_bytes"))


def sized_output(lines: DataFrame, col: str = "value", bytes_per_file: int = STATE_BYTES_PER_FILE) -> DataFrame:
    """SNK-12: number of output files ``1 + total_bytes / bytes_per_file``."""
    return total_bytes(lines, col).select(
        "total_bytes", (F.lit(1) + F.floor(F.col("total_bytes") / bytes_per_file)).cast("bigint").alias("n_files"))


def filter_save(lines: DataFrame, touched_keys: DataFrame, path: str, key_col: str = "key") -> None:
    """Carry over state lines whose TSV key was not touched (the original filterSave); adaptive
    execution sizes the files by the bytes of the join's result."""
    keyed = lines.withColumn("__k", tsv_key(F.col("value")))
    kept = keyed.join(touched_keys.select(F.col(key_col).alias("__k")).distinct(), "__k", "left_anti").select("value")
    kept.hint("rebalance").write.mode("overwrite").text(path)
