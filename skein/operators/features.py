"""Sparse features in long form and the model state they index (ML-01..04, AGG-01, JN-06).

Feature keys (the contract for the absent feature classes, SURVEY §2.12):

=========  ==============  =====================================  =========================
kind       state table     key (k1, k2)                            value for (user, item)
=========  ==============  =====================================  =========================
``g``      global          (c, "")                                 1 per active category c
``u``      user_inferred   (user, c)                               1 per active category c
``i``      item_inferred   (item, "")                              1
``t``      user_entity     (user, entity)                          scalar * tfidf(item, entity)
=========  ==============  =====================================  =========================

``feat`` is the printable key ``kind:k1[:k2]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.config import store

EX = ["user", "item", "label"]


def examples(instances: DataFrame) -> DataFrame:
    """Distinct (user, item, label) with their multiplicity ``mult`` — the training rows.

    Duplicated instances stay separate examples in the gradient through ``mult``;
    keying by value keeps every recomputation identical.
    """
    return instances.groupBy(*EX).agg(F.count(F.lit(1)).alias("mult"))


def user_entity_set(instances: DataFrame, profiles: DataFrame, tfidf: DataFrame, older: DataFrame | None = None) -> DataFrame:
    """AGG-01: (user, entity) over each user's instances that have a profile, any label, and
    those of ``older``; one shuffle makes all of them distinct."""
    items = instances.select("user", "item").distinct()
    t = tfidf.join(profiles.select("article_seq_id"), "article_seq_id", "left_semi")
    held = items.join(t.withColumnRenamed("article_seq_id", "item"), "item").select("user", "entity")
    return (held if older is None else held.unionByName(older)).distinct()


ROWS_PER_SALT = 20_000


def salted(left: DataFrame, right: DataFrame, key: str, spread_by: list[str], rows_per_salt: int = ROWS_PER_SALT) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``key`` with a column ``salt`` to join on beside it.

    A key with many rows on the left gets one salt per ``rows_per_salt`` of them: its left
    rows are dealt over the salts and its right rows repeated for each. Other keys keep one.
    """
    hot = left.groupBy(key).agg((F.floor(F.count(F.lit(1)) / rows_per_salt) + 1).cast("int").alias("salts")).where("salts > 1")
    salts = F.coalesce("salts", F.lit(1))
    dealt = left.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int")).drop("salts")
    repeated = right.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return dealt, repeated


def train_features(ex: DataFrame, profiles: DataFrame, tfidf: DataFrame, entity_scalar: float, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """ML-01: long features ``(user, item, label, mult, kind, k1, k2, feat, value)`` per example.

    One join brings the categories (left: an item without profile keeps only its item
    feature, i.e. neutral category and tags), one the tags. ``tfidf`` must already be
    limited to the profiles (long form). Hot items are salted in both joins.
    """
    def row(kind, k1, k2):
        return F.struct(F.lit(kind).alias("kind"), k1.cast("string").alias("k1"), k2.cast("string").alias("k2"))

    dealt, prof = salted(ex, profiles.select(F.col("article_seq_id").alias("item"), "category_idx"), "item", ["user", "label"], rows_per_salt)
    cats = F.coalesce("category_idx", F.array().cast("array<int>"))
    rows = F.concat(
        F.array(row("i", F.col("item"), F.lit(""))),
        F.transform(cats, lambda c: row("g", c, F.lit(""))),
        F.transform(cats, lambda c: row("u", F.col("user"), c)),
    )
    base = dealt.join(prof, ["item", "salt"], "left").select(*EX, "mult", F.explode(rows).alias("f")).select(
        *EX, "mult", "f.kind", "f.k1", "f.k2", F.lit(1.0).alias("value"))
    dealt, tags = salted(ex, tfidf.withColumnRenamed("article_seq_id", "item"), "item", ["user", "label"], rows_per_salt)
    t = dealt.join(tags, ["item", "salt"]).select(
        *EX, "mult", F.lit("t").alias("kind"), F.col("user").alias("k1"), F.col("entity").alias("k2"),
        (F.lit(entity_scalar) * F.col("tfidf")).alias("value"))
    return with_feat(base.unionByName(t))


def _feat_of(kind: Column, k1: Column, k2: Column) -> Column:
    return F.when(k2 == "", F.concat_ws(":", kind, k1)).otherwise(F.concat_ws(":", kind, k1, k2))


def with_feat(rows: DataFrame) -> DataFrame:
    """``rows`` (kind, k1, k2, ...) with their printable key."""
    return rows.withColumn("feat", _feat_of(F.col("kind"), F.col("k1"), F.col("k2")))


def state_long(global_w: DataFrame, user_w: DataFrame, item_w: DataFrame, user_entity_w: DataFrame) -> DataFrame:
    """The four state tables viewed as one keyed table ``(kind, k1, k2, weight)``."""
    return (
        global_w.select(F.lit("g").alias("kind"), F.col("c").cast("string").alias("k1"), F.lit("").alias("k2"), "weight")
        .unionByName(user_w.select(F.lit("u").alias("kind"), F.col("user").alias("k1"),
                                   F.col("c").cast("string").alias("k2"), "weight"))
        .unionByName(item_w.select(F.lit("i").alias("kind"), F.col("item").alias("k1"), F.lit("").alias("k2"), "weight"))
        .unionByName(user_entity_w.select(F.lit("t").alias("kind"), F.col("user").alias("k1"),
                                          F.col("entity").alias("k2"), "weight"))
    )


#: Key of the state, and the name of its hash.
KEY, KEY_HASH = ["kind", "k1", "k2"], "__key"


def with_key_hash(rows: DataFrame) -> DataFrame:
    """``rows`` with a hash of their key, to join on before the key itself: a sort compares whole
    numbers, and strings only where the hashes are equal."""
    return rows if KEY_HASH in rows.columns else rows.withColumn(KEY_HASH, F.xxhash64(*KEY))


def batch_symbols(features: DataFrame, key_hash: bool = False) -> DataFrame:
    """Distinct features of a batch: ``(kind, k1, k2, feat)``. ``key_hash``: with the hash by which
    they were shuffled, so that ``gather_weights`` does not shuffle them again."""
    named = [*KEY, _feat_of(F.col("kind"), F.col("k1"), F.col("k2")).alias("feat")]
    if not key_hash:
        return features.select(*KEY).distinct().select(*named)
    return with_key_hash(features.select(*KEY)).select(KEY_HASH, *KEY).distinct().select(KEY_HASH, *named)


def gather_weights(symbols: DataFrame, state: DataFrame) -> DataFrame:
    """JN-06 / ML-03: weight per batch feature from the state, 0 when new."""
    return with_key_hash(symbols).join(with_key_hash(state.select(*KEY, "weight")), [KEY_HASH, *KEY], "left").select(
        *KEY, "feat", F.coalesce(F.col("weight"), F.lit(0.0)).alias("weight"))


def dense_index(df: DataFrame, order_col: str, idx_col: str = "idx") -> DataFrame:
    """Dense 0-based index in ``order_col`` order without a single-partition window.

    Range-partition and sort, tag rows with ``monotonically_increasing_id`` (partition id
    in the upper bits), count rows per partition (one small row per partition), turn
    the counts into offsets, and add them back through a broadcast of that small table.
    The sorted, tagged rows are stored so both uses see the same rows.
    """
    from pyspark.sql import Window

    tagged = df.orderBy(order_col).withColumn("__mid", F.monotonically_increasing_id())
    tagged = store(tagged.withColumn("__pid", F.shiftright("__mid", 33)), "indexed")[0]
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the window runs over at most spark.sql.shuffle.partitions rows.
    offsets = counts.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    return (
        tagged.join(F.broadcast(offsets), "__pid")
        .withColumn(idx_col, F.col("__off") + F.col("__mid") - F.shiftleft(F.col("__pid"), 33))
        .drop("__mid", "__pid", "__off")
    )


def feature_registry(features: DataFrame) -> DataFrame:
    """ML-02: feature <-> index for this batch's symbols, index in key order."""
    return dense_index(features.select("feat").distinct(), "feat")


def indexed_weights(features: DataFrame, weights: DataFrame, parts: int) -> DataFrame:
    """The registry with its weights (feat, weight, idx). ``weights``: those of the features, as
    ``gather_weights`` gives them, so that one exchange by range numbers them where they lie."""
    each = weights.repartitionByRange(parts, "feat").groupBy("feat").agg(F.max("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    out = dense_index(each, "feat")
    if out.where("n > 1").isEmpty():
        return out.drop("n")
    # A feature of several weights (the state's key repeats) keeps them all under its one index.
    return feature_registry(features).join(weights.select("feat", "weight"), "feat")


def write_back(weights: DataFrame, only_positive_tags: bool = True) -> DataFrame:
    """ML-04: trained weights split by group; tag weights kept only when positive if asked."""
    keep = F.lit(True)
    if only_positive_tags:
        keep = (F.col("kind") != "t") | (F.col("weight") > 0)
    return weights.where(keep).select("kind", "k1", "k2", "weight")


def split_state(rows: DataFrame) -> dict[str, DataFrame]:
    """``(kind, k1, k2, weight)`` rows -> the four state tables."""
    return {
        "global": rows.where(F.col("kind") == "g").select(F.col("k1").cast("int").alias("c"), "weight"),
        "user_inferred": rows.where(F.col("kind") == "u").select(F.col("k1").alias("user"),
                                                                  F.col("k2").cast("int").alias("c"), "weight"),
        "item_inferred": rows.where(F.col("kind") == "i").select(F.col("k1").alias("item"), "weight"),
        "user_entity": rows.where(F.col("kind") == "t").select(F.col("k1").alias("user"), F.col("k2").alias("entity"),
                                                                "weight"),
    }


def sparse_dot(features: DataFrame, weights: DataFrame, keys=("user", "item", "label")) -> DataFrame:
    """FN-17: x·w per example via a join on the feature and a sum."""
    j = features.join(weights.select("feat", "weight"), "feat", "left")
    return j.groupBy(*keys).agg(F.sum(F.col("value") * F.coalesce(F.col("weight"), F.lit(0.0))).alias("dot"))
