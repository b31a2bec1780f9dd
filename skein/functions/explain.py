"""Feature explanations: ``feat: w`` / ``feat: (w)`` / ``feat: w *v`` joined by ``, `` (FN-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import fmt6


def feature_term(feat: Column, value: Column, weight: Column) -> Column:
    w = fmt6(F.coalesce(weight, F.lit(0.0)))
    return (
        F.when(value == 1, F.concat(feat, F.lit(": "), w))
        .when(value == 0, F.concat(feat, F.lit(": ("), w, F.lit(")")))
        .otherwise(F.concat(feat, F.lit(": "), w, F.lit(" *"), fmt6(value)))
    )


def explain_agg(feat: Column, value: Column, weight: Column) -> Column:
    """Aggregate expression: the terms of one vector ordered by feature key."""
    terms = F.array_sort(F.collect_list(F.struct(feat.alias("k"), feature_term(feat, value, weight).alias("t"))))
    return F.array_join(F.transform(terms, lambda s: s["t"]), ", ")
