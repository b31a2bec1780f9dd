"""String helpers: line framing, keys, paths, words, numeric formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.constants import BATCH_DIR_PATTERN

def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since the epoch of a naive (UTC) timestamp."""
    return F.timestamp_diff("MILLISECOND", _epoch(), ts.cast("timestamp_ntz"))


def epoch_s(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", _epoch(), ts.cast("timestamp_ntz"))


def ms_to_ts(ms: Column) -> Column:
    """Epoch milliseconds -> naive UTC timestamp."""
    return F.timestamp_add("MILLISECOND", ms, _epoch())


def strip_pair_line(line: Column) -> Column:
    """``(null,<json>)`` -> ``<json>`` (FN-08): drop six leading and one trailing char."""
    return F.substring(line, F.lit(7), F.length(line) - F.lit(7))


def tsv_key(line: Column) -> Column:
    """Key of a ``key<TAB>rest`` line (FN-15); a line without TAB is all key."""
    return F.split(line, "\t", 2).getItem(0)


def key_template(template: str, value: Column) -> Column:
    """printf-style key such as ``rec:%s`` applied to a value (FN-14)."""
    return F.format_string(template, value)


def batch_path(base: str, ts: Column, tag: str | None = None) -> Column:
    """``base/yyyy-MM-dd/HH_mm_ss[/tag]`` for a batch time (FN-16)."""
    parts = [F.lit(base), F.date_format(ts, BATCH_DIR_PATTERN)]
    if tag is not None:
        parts.append(F.lit(tag))
    return F.concat_ws("/", *parts)


def space_words(line: Column) -> Column:
    """Words of a line split on single spaces, trailing empty words dropped.

    An empty line gives one empty word, a line of spaces gives none, inner empty
    words are kept (the split semantics of the original word count, Q11).
    """
    stripped = F.regexp_replace(line, r" +\z", "")
    return (
        F.when(line == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, " "))
    )


def r6(x: Column) -> Column:
    """Round to 6 places; ``+ 0.0`` folds a negative zero into zero."""
    return F.round(x.cast("double"), 6) + F.lit(0.0)


def fmt6(x: Column) -> Column:
    """Fixed six-decimal text of a number (stable across engines, unlike float text)."""
    return F.format_string("%.6f", r6(x))


def as_float(x: Column) -> Column:
    """Value as stored by a float-writing sink, read back as double."""
    return x.cast("float").cast("double")
