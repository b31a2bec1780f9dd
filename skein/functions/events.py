"""JSON parsing of read / refresh / user-action lines (FN-07, FN-09)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

READ_SCHEMA = T.StructType([
    T.StructField("user_seq_id", T.IntegerType()),
    T.StructField("article_seq_id", T.IntegerType()),
    T.StructField("article_type", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("ts", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("custom_categories", T.ArrayType(T.StringType())),
    T.StructField(CORRUPT, T.StringType()),
])

REFRESH_SCHEMA = T.StructType([
    T.StructField("user_seq_id", T.IntegerType()),
    T.StructField("article_seq_id", T.ArrayType(T.IntegerType())),
    T.StructField("article_type", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("ts", T.IntegerType()),
    T.StructField("subtype", T.StringType()),
    T.StructField("req_mode", T.StringType()),
    T.StructField("custom_categories", T.ArrayType(T.StringType())),
    T.StructField(CORRUPT, T.StringType()),
])

ACTION_SCHEMA = T.StructType([
    T.StructField("user_seq_id", T.LongType()),
    T.StructField("version", T.StringType()),
    T.StructField("custom_categories", T.ArrayType(T.StringType())),
    T.StructField(CORRUPT, T.StringType()),
])

_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse_read(line: Column) -> Column:
    return F.from_json(line, READ_SCHEMA, _OPTS)


def parse_refresh(line: Column) -> Column:
    return F.from_json(line, REFRESH_SCHEMA, _OPTS)


def parse_action(line: Column) -> Column:
    return F.from_json(line, ACTION_SCHEMA, _OPTS)


def is_read(line: Column) -> Column:
    """The kind rule: a line mentioning ``source`` anywhere is a read (Q3)."""
    return line.contains("source")


def event_ts(line: Column) -> Column:
    """``ts`` of either kind; a missing ``ts`` reads as 0 like an unset Int field, a line that
    does not parse gives NULL (it belongs to the rejects)."""
    def of(parsed):
        return F.when(parsed[CORRUPT].isNull(), F.coalesce(parsed["ts"], F.lit(0)))

    return F.when(is_read(line), of(parse_read(line))).otherwise(of(parse_refresh(line)))
