"""Features, state, training and ranking (ML-*, AGG-01/03/07/08/10, JN-02/03/05/06/07, TOP-01/02, FN-13/17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import encode as E
from skein.functions.explain import explain_agg
from skein.functions.text import r6
from skein.operators import features as FT
from skein.operators import rank as RK
from skein.operators import train as TR
from skein.plans.oracle_ctes import idx_str, r6 as R6, sql, term
from skein.plans.registry import query
from skein.plans.scenario import Scenario
from skein.sources import fixtures as fx

ITER, STEP, FRACTION = 2, 1.0, 1.0


@query("train_features", sql(f'SELECT "user", item, label, mult, feat, {R6("value")} AS value FROM feats', "feats"))
def train_features(spark, d):
    """ML-01: instances -> long sparse features (category, user-category, item, user-tag)."""
    f = Scenario(spark, d).features()
    return f.select("user", "item", "label", "mult", "feat", r6(F.col("value")).alias("value"))


@query("user_entity_set", sql('SELECT "user", entity FROM ue_set', "ue_set"))
def user_entity_set(spark, d):
    """AGG-01: union of entity keys over each user's instances with a profile."""
    return Scenario(spark, d).user_entities


@query("entity_set_union", sql(f"""
SELECT DISTINCT article_seq_id, entity FROM (
  SELECT article_seq_id, unnest(list_transform(title_name_entities, lambda x: lower(x))) AS entity FROM art
  WHERE crawled_at > TIMESTAMP '2024-01-28 00:00:00'
  UNION ALL
  SELECT article_seq_id, unnest(list_transform(content_name_entities, lambda x: lower(x))) FROM art
  WHERE crawled_at > TIMESTAMP '2024-01-28 00:00:00')""", "art"))
def entity_set_union(spark, d):
    """SET-02: set union of an article's title and content entities."""
    from skein.sources import profiles as P
    p = P.scan_profiles(fx.art(spark, d), ["title_entities", "content_entities"], since=fx.WINDOW_START_TS)
    return p.select("article_seq_id", F.explode(F.array_union("title_entities", "content_entities")).alias("entity"))


@query("feature_registry", sql("SELECT feat, row_number() OVER (ORDER BY feat) - 1 AS idx FROM (SELECT DISTINCT feat FROM feats)",
                               "feats"))
def feature_registry(spark, d):
    """ML-02: feature <-> dense index in key order."""
    return FT.feature_registry(Scenario(spark, d).features())


@query("weights_for_batch", sql(f"SELECT feat, {R6('weight')} AS weight FROM w0", "w0"))
def weights_for_batch(spark, d):
    """ML-03: weight per batch feature from the four state tables, 0 if new."""
    return Scenario(spark, d).initial_weights().select("feat", r6(F.col("weight")).alias("weight"))


@query("nonzero", sql(f"SELECT feat, {R6('weight')} AS weight FROM w0 WHERE weight <> 0", "w0"))
def nonzero(spark, d):
    """PRJ-09: drop zero weights."""
    w = Scenario(spark, d).initial_weights()
    return w.where(F.col("weight") != 0).select("feat", r6(F.col("weight")).alias("weight"))


@query("active_features", sql(
    'SELECT "user", item, label, mult, CAST(count(*) AS BIGINT) AS n_features FROM feats GROUP BY ALL', "feats"))
def active_features(spark, d):
    """PRJ-08: examples with at least one stored feature, and how many."""
    return TR.active_examples(Scenario(spark, d).features())


@query("exists", sql("SELECT count(*) > 0 AS any_row, coalesce(max(label) > 0, false) AS any_positive FROM ex", "ex"))
def exists_(spark, d):
    """AGG-08: is there any training row / any positive row."""
    from skein.plans.common import instances
    return instances(spark, d).agg((F.count(F.lit(1)) > 0).alias("any_row"),
                  F.coalesce(F.max(F.col("label")) > 0, F.lit(False)).alias("any_positive"))


@query("gradient_sum", sql(f"SELECT feat, {R6('grad')} AS grad FROM g1", "g1"))
def gradient_sum(spark, d):
    """AGG-10: Σ mult·(σ(w·x) − y)·x per feature at the starting weights."""
    s = Scenario(spark, d)
    return s.batch.gradient(*s.batch.gather(s.state)).select("feat", r6(F.col("grad")).alias("grad"))


@query("sparse_dot", sql(f"""
SELECT f."user", f.item, f.label, {R6('round(sum(f.value * coalesce(w.weight, 0.0)), 9)')} AS dot
FROM feats f LEFT JOIN w0 w USING (feat) GROUP BY ALL""", "feats", "w0"))
def sparse_dot(spark, d):
    """FN-17: x·w per example, by a join on the feature. Nine decimals first: sums of decimal
    weights end in exact halves of the sixth, which summation order would round either way."""
    s = Scenario(spark, d)
    dots = s.batch.dots(*s.batch.gather(s.state))
    return dots.select("user", "item", "label", r6(F.round("dot", 9)).alias("dot"))


@query("sgd_train", sql(f"SELECT feat, {R6('weight')} AS weight FROM w2", "w2"))
def sgd_train(spark, d):
    """ML-05: two warm-start SGD iterations, step 1, full batch (early stop off)."""
    w = Scenario(spark, d).trained(ITER, STEP, FRACTION)
    return w.select("feat", r6(F.col("weight")).alias("weight"))


#: The registered L-BFGS run ends when the gradient's norm has fallen to this share of its first.
STATIONARY = 0.05


@query("lbfgs_train", sql(f"""
SELECT feat, {R6('loss')} AS start_loss, true AS converged, true AS improved, true AS stationary
FROM (SELECT DISTINCT feat FROM feats) CROSS JOIN (
  SELECT sum(mult * (ln(1 + exp(-abs(m))) + greatest(m, 0) - label * m)) / sum(mult) AS loss
  FROM (SELECT f."user", f.item, f.label, f.mult, sum(f.value * w.weight) AS m FROM feats f JOIN w0 w USING (feat) GROUP BY ALL))""", "feats", "w0"))
def lbfgs_train(spark, d):
    """ML-06: warm-start L-BFGS. Its weights are no closed form, so what SQL holds them to is
    their optimality: the loss it starts from, that it converged below it, and that at its
    weights the gradient (AGG-10, not the trainer's own) of every feature has vanished beside the
    norm of the first."""
    s = Scenario(spark, d)
    start = s.initial_weights()
    fit = TR.lbfgs(s.features(), start, tolerance=0.0, gradient_tolerance=STATIONARY)
    first = TR.gradient(s.features(), start).agg(F.sqrt(F.sum(F.col("grad") ** 2)).alias("norm"))
    done = TR.gradient(s.features(), fit.weights)
    return done.select(
        "feat", r6(F.lit(fit.start_loss)).alias("start_loss"), F.lit(fit.converged).alias("converged"), F.lit(fit.loss < fit.start_loss).alias("improved"),
        (F.abs("grad") <= STATIONARY * first.scalar()).alias("stationary"))


@query("train_routing", sql(f"""
SELECT n_examples, has_positive, CASE WHEN n_examples = 0 THEN 'base' ELSE 'sgd' END AS route,
  (SELECT count(*) FROM w2) AS n_weights, (SELECT {R6('sum(weight)')} FROM w2) AS weight_sum
FROM (SELECT CAST(coalesce(sum(mult), 0) AS BIGINT) AS n_examples, coalesce(max(label) > 0, false) AS has_positive FROM ex)""", "ex", "w2"))
def train_routing(spark, d):
    """ML-07: the trainer that the batch's examples route to (base / sgd / lbfgs), run."""
    s = Scenario(spark, d)
    with s.dealt() as dealt:
        w = TR.train_step(s.features(), s.initial_weights(), ITER, STEP, FRACTION, dealt=dealt).weights
    done = w.agg(F.count(F.lit(1)).alias("n_weights"), r6(F.sum("weight")).alias("weight_sum"))
    return TR.routing(s.features(), ITER, STEP, FRACTION).select(
        "*", *[done.select(c).scalar().alias(c) for c in done.columns])


@query("weights_write_back", sql(f"SELECT kind, k1, k2, {R6('weight')} AS weight FROM w2 WHERE kind <> 't' OR weight > 0", "w2"))
def weights_write_back(spark, d):
    """ML-04: trained weights split into the four groups; only positive tag weights kept."""
    w = Scenario(spark, d).trained(ITER, STEP, FRACTION)
    return FT.write_back(w).withColumn("weight", r6(F.col("weight")))


@query("feature_explain", sql(f"""
SELECT "user", item, label, string_agg({term('f.feat', 'f.value', 'w.weight')}, ', ' ORDER BY f.feat) AS explanation
FROM feats f LEFT JOIN w0 w USING (feat) GROUP BY ALL""", "feats", "w0"))
def feature_explain(spark, d):
    """FN-13: ``feat: w`` / ``feat: (w)`` / ``feat: w *v`` per training vector, in key order."""
    s = Scenario(spark, d)
    j = s.features().join(s.initial_weights().select("feat", "weight"), "feat", "left")
    return j.groupBy("user", "item", "label").agg(explain_agg(F.col("feat"), F.col("value"), F.col("weight")).alias("explanation"))


# --- ranking ------------------------------------------------------------------------

@query("candidate_prescore", sql(f"""
SELECT p.article_seq_id AS item, {R6('coalesce(s.weight, 0.0)')} AS score
FROM prof p LEFT JOIN st_item s ON s.item = p.article_seq_id WHERE len(p.cat) > 0""", "prof", "st_item"))
def candidate_prescore(spark, d):
    """ML-08: items with a category scored by the item weight alone (global popularity)."""
    return Scenario(spark, d).prescored().select("item", r6(F.col("score")).alias("score"))


@query("candidate_topn", sql(f"""
SELECT c.item, c.score, string_agg({term('f.feat', 'f.value', 'f.weight')}, ', ' ORDER BY f.feat) AS explanation
FROM cand c JOIN cand_feat f ON f.item = c.item GROUP BY c.item, c.score""", "cand", "cand_feat"))
def candidate_topn(spark, d):
    """TOP-01: global top-N candidates by (score desc, item desc), with explanation (Q7)."""
    return Scenario(spark, d).candidates(explain=True).select("item", "score", "explanation")


@query("candidate_semi", sql(
    f"SELECT p.article_seq_id, {idx_str('p.cat')} AS category_idx FROM prof p WHERE p.article_seq_id IN (SELECT item FROM cand)",
    "prof", "cand"))
def candidate_semi(spark, d):
    """JN-05: window profiles whose id is among the candidates."""
    s = Scenario(spark, d)
    p = s.profiles.join(s.candidates().select(F.col("item").alias("article_seq_id")), "article_seq_id", "left_semi")
    return p.select("article_seq_id", E.idx_string("category_idx").alias("category_idx"))


@query("distinct_tags", sql("SELECT DISTINCT entity FROM cand_tfidf", "cand_tfidf"))
def distinct_tags(spark, d):
    """AGG-03: distinct entity keys over the candidates."""
    s = Scenario(spark, d)
    return s.candidate_tfidf.select("entity").distinct()


@query("tag_whitelist", sql(f"""
SELECT "user", entity, {R6('weight')} AS weight FROM st_ue
WHERE entity IN (SELECT entity FROM cand_tfidf) AND "user" IN (SELECT "user" FROM active)""", "st_ue", "cand_tfidf", "active"))
def tag_whitelist(spark, d):
    """JN-07: user-tag weights of active users, only for tags present among candidates."""
    s = Scenario(spark, d)
    tags = s.candidate_tfidf.select("entity").distinct()
    ue = s.user_entity_w.join(s.users(), "user", "left_semi").join(tags, "entity", "left_semi")
    return ue.select("user", "entity", r6(F.col("weight")).alias("weight"))


@query("weights_gather", sql(f"SELECT DISTINCT feat, {R6('coalesce(weight, 0.0)')} AS weight FROM contrib", "contrib"))
def weights_gather(spark, d):
    """JN-06: the weights the ranking of this batch reads (users × candidates × tags)."""
    c = Scenario(spark, d).contributions()
    return c.select("feat", r6(F.coalesce(F.col("weight"), F.lit(0.0))).alias("weight")).distinct()


@query("user_candidate_cross", sql("SELECT a.\"user\", c.item FROM active a CROSS JOIN cand c", "active", "cand"))
def user_candidate_cross(spark, d):
    """JN-02: every active user with every candidate (candidates bounded by N)."""
    s = Scenario(spark, d)
    return RK.user_candidate_pairs(s.users(), s.candidates())


@query("rank_users", sql('SELECT "user", item, score FROM scored', "scored"))
def rank_users(spark, d):
    """ML-09: full score of each active user × candidate."""
    return Scenario(spark, d).scored().select("user", "item", "score")


@query("rank_explained", sql('SELECT "user", item, score, explanation FROM scored', "scored"))
def rank_explained(spark, d):
    """ML-10: prescore -> top N -> tags -> weights -> score, with feature explanations."""
    return Scenario(spark, d).scored(explain=True)


@query("group_items_per_user", sql("""
SELECT "user", CAST(count(*) AS BIGINT) AS n_items, string_agg(item, ',' ORDER BY score DESC, item DESC) AS items
FROM scored GROUP BY "user" """, "scored"))
def group_items_per_user(spark, d):
    """AGG-07: each user's scored items, best first."""
    s = Scenario(spark, d).scored()
    g = s.groupBy("user").agg(F.count(F.lit(1)).alias("n_items"),
                              F.sort_array(F.collect_list(F.struct(-F.col("score"), F.col("item")))).alias("xs"))
    # collect_list is bounded: one user holds at most N candidates.
    return g.select("user", "n_items", F.array_join(F.transform(
        F.reverse(F.sort_array(F.transform("xs", lambda x: F.struct(x["col1"] * -1, x["item"])))), lambda x: x["item"]), ",").alias("items"))


@query("exclude_recommended", sql('SELECT "user", item, score FROM unshown', "unshown"))
def exclude_recommended(spark, d):
    """JN-03: scored pairs minus items already shown to the user."""
    return Scenario(spark, d).unshown().select("user", "item", "score")


@query("user_topn", sql('SELECT "user", rank, item, score FROM rec', "rec"))
def user_topn(spark, d):
    """TOP-02: per user, after exclusion, the N best by score (ties: item descending)."""
    r = Scenario(spark, d).recommended()
    return r.select("user", F.col("rank").cast("bigint").alias("rank"), "item", "score")


@query("recommend", sql('SELECT "user", rank, item, score FROM rec', "rec"))
def recommend(spark, d):
    """ML-11 (flagship): rank -> exclude shown -> per-user top N."""
    r = Scenario(spark, d).recommended()
    return r.select("user", F.col("rank").cast("bigint").alias("rank"), "item", "score")
