"""Candidate prescoring, per-user scoring and top-k (ML-08..11, TOP-01/02, JN-02/03/05/07).

Plan shape (SURVEY §4): the candidate set is cut to ``n_candidates`` by a global
top-k (TakeOrderedAndProject) before anything meets the users, so every
candidate side below is bounded by ``n_candidates`` (times the entities of one
article); adaptive execution broadcasts it where its measured size allows. A user's score is a sum of sparse contributions:

    score(u, i) = b_i + Σ_{c∈cat(i)} (g_c + u_{u,c}) + Σ_e w_{u,e} · scalar · tfidf(i, e)

Each term is an equi-join against a bounded candidate table; the terms are
unioned in long form and summed per (user, item) with map-side partial
aggregation, so a user with a huge state still yields at most ``n_candidates``
rows per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.explain import explain_agg
from skein.functions.text import r6


def prescore(profiles: DataFrame, item_w: DataFrame) -> DataFrame:
    """ML-08: items with a category, scored without user, tags or category: ``b_i``.

    ``profiles``: ``(article_seq_id, category_idx)``; ``item_w``: ``(item, weight)``.
    """
    items = profiles.where(F.size("category_idx") > 0).select(F.col("article_seq_id").alias("item"), "category_idx")
    return items.join(item_w.select("item", "weight"), "item", "left").select(
        "item", "category_idx", F.coalesce(F.col("weight"), F.lit(0.0)).alias("score"))


def _candidate_features(cands: DataFrame, global_w: DataFrame) -> DataFrame:
    """(item, feat, value, weight) of the candidates with their real categories (Q7)."""
    cat = cands.select("item", F.explode("category_idx").alias("c"))
    g = cat.join(global_w.select("c", "weight"), "c", "left").select(
        "item", F.concat(F.lit("g:"), F.col("c").cast("string")).alias("feat"), F.lit(1.0).alias("value"), "weight")
    i = cands.select("item", F.concat(F.lit("i:"), F.col("item")).alias("feat"), F.lit(1.0).alias("value"),
                     F.col("score").alias("weight"))
    return g.unionByName(i)


def top_candidates(scored: DataFrame, n: int, global_w: DataFrame | None = None, rounded: bool = False) -> DataFrame:
    """TOP-01: global top ``n`` by (score desc, item desc), plus an explanation per candidate.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps its own top
    ``n`` and only those reach the final merge. ``rounded`` ranks by six decimals, so that
    another engine's sums rank alike.
    """
    if rounded:
        scored = scored.withColumn("score", r6(F.col("score")))
    top = scored.orderBy(F.desc("score"), F.desc("item")).limit(n)
    if global_w is None:
        return top
    ex = _candidate_features(top, global_w).groupBy("item").agg(
        explain_agg(F.col("feat"), F.col("value"), F.col("weight")).alias("explanation"))
    return top.join(ex, "item", "left")


def candidate_tags(cands: DataFrame, tfidf: DataFrame) -> DataFrame:
    """JN-05 + AGG-03: tf-idf rows of the candidates, and their distinct entities."""
    return tfidf.join(cands.select(F.col("item").alias("article_seq_id")), "article_seq_id", "left_semi")


def user_candidate_pairs(users: DataFrame, cands: DataFrame) -> DataFrame:
    """JN-02: every active user with every candidate.

    The candidate ids are read once as a scalar subquery holding one array, which passes
    the driver: ``n_candidates`` ids, a parameter meant for thousands (100,000 ids are
    about 1 MB). Each user row expands it locally. No join and no shuffle.
    """
    items = cands.select(F.sort_array(F.collect_list("item"))).scalar()
    return users.select("user", F.explode(items).alias("item"))


def pair_contributions(users: DataFrame, cands: DataFrame, global_w: DataFrame, user_w: DataFrame,
                       user_entity_w: DataFrame, cand_tfidf: DataFrame, entity_scalar: float) -> DataFrame:
    """Long rows ``(user, item, feat, value, weight, base)`` of every scored pair.

    ``base`` marks the one row per pair that guarantees the pair exists even when the
    user has no state. ``cands`` carries ``(item, category_idx, score=b_i)``.
    """
    cand_cat = cands.select("item", F.explode("category_idx").alias("c"))
    cand_feats = _candidate_features(cands, global_w)
    cand_t = cand_tfidf.withColumnRenamed("article_seq_id", "item")
    pairs = user_candidate_pairs(users, cands)
    item_part = pairs.join(cand_feats, "item").select("user", "item", "feat", "value", "weight",
                                                      (F.col("feat").startswith("i:")).alias("base"))
    uw = user_w.join(users, "user", "left_semi")
    ucat = uw.join(cand_cat, "c").select(
        "user", "item", F.concat_ws(":", F.lit("u"), F.col("user"), F.col("c").cast("string")).alias("feat"),
        F.lit(1.0).alias("value"), "weight", F.lit(False).alias("base"))
    # JN-07: only tags present among the candidates take part. The whitelist is a semi join
    # on entity first, which the optimizer can push into however the user-tag table is
    # derived (through its distinct), so non-candidate tags are never joined.
    tags = cand_tfidf.select("entity").distinct()
    ue = user_entity_w.join(tags, "entity", "left_semi").join(users, "user", "left_semi")
    uent = ue.join(cand_t, "entity").select(
        "user", "item", F.concat_ws(":", F.lit("t"), F.col("user"), F.col("entity")).alias("feat"),
        (F.lit(entity_scalar) * F.col("tfidf")).alias("value"), "weight", F.lit(False).alias("base"))
    return item_part.unionByName(ucat).unionByName(uent)


def score_pairs(contrib: DataFrame, explain: bool = False, rounded: bool = False) -> DataFrame:
    """ML-09: ``score(u, i) = Σ value · weight`` per pair (FN-17), optional explanation."""
    aggs = [F.sum(F.col("value") * F.coalesce(F.col("weight"), F.lit(0.0))).alias("score")]
    if explain:
        aggs.append(explain_agg(F.col("feat"), F.col("value"), F.col("weight")).alias("explanation"))
    out = contrib.groupBy("user", "item").agg(*aggs)
    return out.withColumn("score", r6(F.col("score"))) if rounded else out


def exclude_shown(scored: DataFrame, rec_log: DataFrame, cands: DataFrame | None = None) -> DataFrame:
    """JN-03: drop (user, item) already shown. The log is first cut to candidate items."""
    log = rec_log.select("user", "item")
    if cands is not None:
        log = log.join(cands.select("item"), "item", "left_semi")
    return scored.join(log, ["user", "item"], "left_anti")


def top_per_user(scored: DataFrame, n: int) -> DataFrame:
    """TOP-02: per user the ``n`` best by (score desc, item desc); plans as WindowGroupLimit."""
    w = Window.partitionBy("user").orderBy(F.desc("score"), F.desc("item"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
