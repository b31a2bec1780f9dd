"""Category encoders and profile-field coercion, all as Column expressions.

A category vector is an ``ARRAY<INT>`` of sorted, distinct active indices; the
vector length is metadata (``CATEGORY_LENGTH`` and friends).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.constants import (
    CATEGORY_NAMES,
    CITY_CATEGORY_INDEX,
    CUSTOM_CATEGORY_INDEX,
    CUSTOM_CATEGORY_OTHERS,
)


def _vocab_map(mapping: dict[str, int]) -> Column:
    pairs = []
    for name, idx in mapping.items():
        pairs += [F.lit(name), F.lit(idx)]
    return F.create_map(*pairs)


CATEGORY_VOCAB = {name: i for i, name in enumerate(CATEGORY_NAMES)}


def encode_names(names: Column, vocab: dict[str, int] = CATEGORY_VOCAB, default: int | None = None) -> Column:
    """Names -> sorted distinct indices; unknown names are dropped, or mapped to ``default``."""
    m = _vocab_map(vocab)
    looked = F.transform(names, lambda x: F.try_element_at(m, x))
    if default is None:
        looked = F.filter(looked, lambda x: x.isNotNull())
    else:
        looked = F.transform(looked, lambda x: F.coalesce(x, F.lit(default)))
    return F.array_sort(F.array_distinct(looked))


def encode_category(names: Column) -> Column:
    """13-slot article category vector (FN-01)."""
    return encode_names(names, CATEGORY_VOCAB)


def encode_category_city(names: Column) -> Column:
    """3-slot category-with-city vector (FN-02)."""
    return encode_names(names, CITY_CATEGORY_INDEX)


def encode_custom_category(names: Column) -> Column:
    """15-slot custom-category vector; unknown names set slot 0 (FN-03)."""
    return encode_names(names, CUSTOM_CATEGORY_INDEX, default=CUSTOM_CATEGORY_OTHERS)


def category_names(idx: Column) -> Column:
    """Slot index -> category name (FN-04); NULL outside the vocabulary."""
    return F.try_element_at(F.array(*[F.lit(n) for n in CATEGORY_NAMES]), idx.cast("int") + 1)


def normalise_entities(entities: Column) -> Column:
    """Entity list -> lower-cased distinct set (FN-05)."""
    return F.array_distinct(F.transform(entities, lambda x: F.lower(x.cast("string"))))


def as_number(x: Column, kind: T.DataType | None = None) -> Column:
    """A double through its text form; a bad value becomes NULL, a number stays one."""
    return x.cast("double") if isinstance(kind, T.NumericType) else x.cast("string").try_cast("double")


def parse_vector(values: Column, kind: T.DataType | None = None) -> Column:
    """List -> doubles (FN-06); a bad element becomes NULL. ``kind``: the element type if known."""
    return F.transform(values, lambda x: as_number(x, kind))


def has_null_element(arr: Column) -> Column:
    return F.exists(arr, lambda x: x.isNull())


def idx_string(arr: Column) -> Column:
    """Flat text form of an index vector, e.g. ``"1,2"`` (empty vector -> ``""``)."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")
