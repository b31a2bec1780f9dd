"""Profile scans: one parameterised scan, with the original query functions as presets.

A scan projects the requested fields (column pruning reaches the file scan),
applies the time predicate and the optional ``usable`` flag (pushed into the scan
as ``PushedFilters``), coerces each field and drops rows that fail coercion (Q1).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.functions import encode as E

VECTOR_FIELDS = ("text_vector", "title_vector")
ENTITY_FIELDS = {"title_entities": "title_name_entities", "content_entities": "content_name_entities"}
TFIDF_FIELDS = {"title_tfidf": "title_name_entities_tfidf", "content_tfidf": "content_name_entities_tfidf"}


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (int, float)):
        from skein.functions.text import ms_to_ts
        return ms_to_ts(F.lit(int(value)))
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.lit(value).cast("timestamp_ntz")


def time_filter(df: DataFrame, since, inclusive: bool = False, col: str = "crawled_at") -> DataFrame:
    """``col > since`` (strict) or ``col >= since`` (inclusive), PRJ-03."""
    if since is None:
        return df
    c = F.col(col).cast("timestamp_ntz")
    return df.where(c >= _ts(since) if inclusive else c > _ts(since))


def _checks(fields: Iterable[str], schema: T.StructType) -> tuple[list[Column], list[tuple[str, Column]]]:
    """Projections and (reason, failed-predicate) pairs for the requested fields."""
    cols: list[Column] = []
    bad: list[tuple[str, Column]] = []
    for f in fields:
        if f in ("category", "category_city"):
            src = F.col("category")
            enc = E.encode_category(src) if f == "category" else E.encode_category_city(src)
            cols.append(enc.alias("category_idx"))
            bad.append(("category", src.isNull() | E.has_null_element(src)))
        elif f in ENTITY_FIELDS:
            src = F.col(ENTITY_FIELDS[f])
            cols.append(E.normalise_entities(src).alias(f))
            bad.append((f, src.isNull() | E.has_null_element(src)))
        elif f in TFIDF_FIELDS:
            src = F.col(TFIDF_FIELDS[f])
            kind = schema[TFIDF_FIELDS[f]].dataType
            vals = F.transform_values(src, lambda k, v: E.as_number(v, kind.valueType))
            cols.append(vals.alias(f))
            bad.append((f, src.isNull() | F.exists(F.map_values(vals), lambda v: v.isNull())))
        elif f in VECTOR_FIELDS:
            parsed = E.parse_vector(F.col(f), schema[f].dataType.elementType)
            cols.append(parsed.alias(f))
            bad.append((f, F.col(f).isNull() | E.has_null_element(parsed)))
        elif f == "crawled_at":
            cols.append(F.col("crawled_at"))
        else:
            raise ValueError(f"unknown profile field {f!r}")
    return cols, bad


def _filtered(profiles: DataFrame, since, inclusive: bool, usable_only: bool,
              ids: DataFrame | None) -> DataFrame:
    df = time_filter(profiles, since, inclusive)
    if usable_only:
        df = df.where(F.col("usable"))
    if ids is not None:
        # Id set given as a DataFrame: a semi join; AQE broadcasts it when it is small.
        df = df.join(ids.select(F.col(ids.columns[0]).cast("string").alias("article_seq_id")),
                     "article_seq_id", "left_semi")
    return df


def scan_profiles(profiles: DataFrame, fields: Iterable[str], since=None, inclusive: bool = False,
                  usable_only: bool = False, ids: DataFrame | None = None,
                  id_col: str = "article_seq_id", keep: Iterable[str] = ()) -> DataFrame:
    """Valid profile rows: ``id_col`` plus the coerced ``fields`` (and raw ``keep`` columns)."""
    fields = list(fields)
    cols, bad = _checks(fields, profiles.schema)
    from skein.operators.instances import keep_where

    # Time, usable and id set are plain predicates: they reach the file scan (PushedFilters).
    df = _filtered(profiles, since, inclusive, usable_only, ids).where(
        F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != ""))
    # Field coercion checks may read derived columns; they are kept above the projection.
    ok = F.lit(True)
    for _, b in bad:
        ok = ok & ~F.coalesce(b, F.lit(False))
    return keep_where(df, ok).select(F.col(id_col).cast("string").alias(id_col), *cols, *keep)


def rejected_profiles(profiles: DataFrame, fields: Iterable[str], since=None, inclusive: bool = False,
                      usable_only: bool = False, id_col: str = "article_seq_id") -> DataFrame:
    """Rows a scan drops, with the first failing field as the reason (PRJ-02)."""
    _, bad = _checks(list(fields), profiles.schema)
    df = _filtered(profiles, since, inclusive, usable_only, None)
    reason = F.when(F.col(id_col).isNull() | (F.col(id_col).cast("string") == ""), F.lit("id"))
    for name, b in bad:
        reason = reason.when(F.coalesce(b, F.lit(False)), F.lit(name))
    return df.select(F.col(id_col).cast("string").alias(id_col), reason.alias("reason")).where(
        F.col("reason").isNotNull()
    )


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key: greatest ``order_col``, then the greatest other values (Q5, AGG-09).

    A plain aggregate, so it combines map-side and a hot key does not pile up in one
    task. Columns without an order (maps) break ties by their text.
    """
    others = [c for c in df.columns if c not in (key, order_col)]
    tie = [F.col(c) if _sortable(df.schema[c].dataType) else F.to_json(F.struct(c)) for c in others]
    rank = F.struct(F.col(order_col), *[t.alias(f"t{i}") for i, t in enumerate(tie)])
    best = F.max_by(F.struct(F.col(order_col), *[F.col(c) for c in others]), rank)
    return df.groupBy(key).agg(best.alias("__m")).select(key, *[F.col(f"__m.{c}").alias(c) for c in (order_col, *others)])


# --- presets (the original query functions) ----------------------------------------

def profile_category(profiles, since, usable_only=False):
    return scan_profiles(profiles, ["category"], since, usable_only=usable_only)


def profile_by_ids(profiles, ids: DataFrame):
    return scan_profiles(profiles, ["category"], ids=ids)


def user_categories_since(users: DataFrame, since):
    """User scan: custom categories encoded with the 13-slot article vocabulary (Q4)."""
    df = time_filter(users, since, col="updated_at")
    src = F.col("custom_categories")
    ok = F.col("user_seq_id").isNotNull() & (F.col("user_seq_id") != "") & src.isNotNull() & ~E.has_null_element(src)
    return df.where(ok).select("user_seq_id", "updated_at", E.encode_category(src).alias("category_idx"))


def user_categories_full(users: DataFrame):
    return latest_per_key(user_categories_since(users, None), "user_seq_id", "updated_at")


def profile_entities(profiles, since, kind="content", usable_only=False):
    return scan_profiles(profiles, ["category", f"{kind}_entities"], since, usable_only=usable_only)


def profile_tfidf(profiles, since, kind="content", usable_only=False, city=False):
    cat = "category_city" if city else "category"
    return scan_profiles(profiles, [cat, f"{kind}_tfidf"], since, usable_only=usable_only)


def profile_category_text(profiles, since, usable_only=False):
    return scan_profiles(profiles, ["category", "text_vector"], since, usable_only=usable_only)


def profile3(profiles, since):
    return scan_profiles(profiles, ["text_vector", "title_vector", "category"], since, inclusive=True)


def profile_text_category(profiles, since):
    return scan_profiles(profiles, ["text_vector", "category"], since, inclusive=True)


def profile2(profiles, since):
    return scan_profiles(profiles, ["text_vector", "title_vector"], since, inclusive=True)


def profile_text(profiles, since):
    return scan_profiles(profiles, ["text_vector"], since, inclusive=True)


def read_collection(spark, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Whole collection through any data source (SRC-16); the format is just an option."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
