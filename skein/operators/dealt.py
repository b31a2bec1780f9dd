"""Training data dealt once: features, weights and gradients side by side in buckets.

The original persists its training set and ships the whole model to every task. Here
neither moves during training. The features of an example lie in one bucket, chosen by its user (a
user of very many examples is spread by item too), and a weight lies in every bucket that
uses it. Most weights belong to one user and so to one bucket; those of items and
categories are *shared* and have a copy in each bucket that uses them.

* Margins: features meet weights within the bucket, products are summed by example.
* Gradients: errors meet features within the bucket, products are summed by feature; only
  the shared features' partial sums are shuffled, added up and sent back to the copies.

Tables in bucket order that one iteration needs twice are held by Spark (on disk where memory
is short, computed again where an executor is lost); each generation of weights is written.
All tables are bucketed by ``b``, so a pass over the features has no exchange of them,
whatever the size of the model; what travels is one row for each shared feature and bucket.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import BUCKETED, append_bucketed, configure, drop, drop_bucketed, store, store_bucketed
from skein.operators.features import with_feat

BUCKET_BYTES = 64 << 20   # stored features of a bucket, about
MOST_BUCKETS = 1 << 17
SLOTS = 64                # values of ``b`` for a bucket: evens out their hashing (of 4, the fullest of many buckets has thrice its share)
LEAST_HOT = 10_000        # examples of a user that may be spread
COPIES = 4                # features of the examples for one of the model, about
SEEDS = 3


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def drawn(fraction: float, seed: int) -> Column:
    """How many of an example's ``mult`` copies a sample draws: each on its own, by a hash of
    (example, copy, seed), so that a run repeats exactly."""
    def u(copy):
        return F.shiftrightunsigned(F.xxhash64(F.col("h"), copy, F.lit(seed)), 11).cast("double") / float(1 << 53)

    return F.size(F.filter(F.sequence(F.lit(1), F.col("mult").cast("int")), lambda c: u(c) < fraction)).cast("long")


def _bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@dataclass
class Dealt:
    """What ``deal`` leaves: tables by bucket ``b``, and the names of the features.

    ``features`` (b, ex, h, label, mult, fid, value); ``weights`` (b, fid, shared, lead, w),
    where one copy of a feature is the ``lead``; ``examples`` (ex, h, label, mult);
    ``symbols`` (fid, kind, k1, k2, feat).
    """

    spark: SparkSession
    buckets: int
    features: DataFrame
    weights: DataFrame
    examples: DataFrame
    symbols: DataFrame
    _tables: list[str] = field(default_factory=list)
    _paths: list[str] = field(default_factory=list)
    placed: bool = False   # dealt from a batch in buckets (``operators/placed.py``): weights carry their names

    def keep(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        """Store a table that is in bucket order already."""
        return store_bucketed(df, name, self.buckets, "b")

    def total(self, weights: DataFrame, parts: DataFrame, *more: str) -> DataFrame:
        """Gradients of all copies (b, fid, grad) from the buckets' sums (b, fid, part): those of
        shared features are added up and go back to every bucket that holds a copy. ``more``:
        columns of ``weights`` that stay beside them."""
        kept = list(dict.fromkeys(["shared", *more]))
        here = weights.select("b", "fid", *kept).join(parts.hint("shuffle_hash"), ["b", "fid"], "left").select("b", "fid", *kept, F.coalesce("part", F.lit(0.0)).alias("part"))
        sums = here.where("shared").groupBy("fid").agg(F.sum("part").alias("total"), F.collect_list("b").alias("bs"))
        back = sums.select(F.explode("bs").alias("b"), "fid", "total").repartition(self.buckets, "b")
        return here.join(back.hint("shuffle_hash"), ["b", "fid"], "left").select("b", "fid", *more, F.coalesce("total", "part").alias("grad"))

    def moved(self, weights: DataFrame, errors: DataFrame, moved: Column) -> tuple[DataFrame, str]:
        """The next weights of a placed batch, ``moved`` by each feature's ``grad`` of the examples'
        ``errors`` (b, ex, err): own features' in their buckets, in one pass; the shared
        features' sums are added up and meet the copies."""
        errors, error_table = self.keep(errors, "errors")
        total = F.sum(F.col("err") * F.col("value")).alias("grad")
        cols = ["b", "fid", "shared", "lead", moved.alias("w"), F.col("w").alias("old"), "kind", "k1", "k2"]

        def met(rows: str) -> DataFrame:
            return self.features.where(rows).select("b", "ex", "fid", "value").join(errors.hint("shuffle_hash"), ["b", "ex"])

        w = weights.drop("old")
        here = w.where("not shared").join(met("own").groupBy("b", "fid").agg(total).hint("shuffle_hash"), ["b", "fid"], "left")
        away = w.where("shared").join(met("not own").groupBy("fid").agg(total), "fid", "left")
        table = self.keep(here.select(*cols), "weights")[1]
        new = append_bucketed(away.select(*cols).repartition(self.buckets, "b"), table, self.buckets, "b")
        drop_bucketed(self.spark, error_table)
        return new, table

    def stored(self, weights: DataFrame) -> DataFrame:
        """(kind, k1, k2, feat, weight) from (b, fid, lead, w), stored. Of a placed batch the weights
        have their names and stay as they are, with ``b`` and ``own``."""
        if not self.placed:
            return store(self.named(weights), "weights")[0]
        return with_feat(weights.where("lead").select("b", (~F.col("shared")).alias("own"), "kind", "k1", "k2", F.col("w").alias("weight")))

    def named(self, weights: DataFrame) -> DataFrame:
        """(kind, k1, k2, feat, weight) from (b, fid, lead, w)."""
        return weights.where("lead").select("fid", F.col("w").alias("weight")).join(self.symbols, "fid").select("kind", "k1", "k2", "feat", "weight")

    def close(self) -> None:
        for t in self._tables:
            drop_bucketed(self.spark, t)
        for p in self._paths:
            drop(self.spark, p)


def hashed(cols: list[str], seed: int) -> Column:
    return F.xxhash64(*cols, F.lit(seed))


def _seed(rows: DataFrame, cols: list[str]) -> int | None:
    """A seed under which no two rows (distinct in ``cols``) share their 64-bit hash; None where
    there are too many rows for one."""
    for seed in range(SEEDS):
        if rows.select(hashed(cols, seed).alias("key")).groupBy("key").count().where("count > 1").isEmpty():
            return seed
    return None


def _numbered(rows: DataFrame, cols: list[str], key: str, name: str) -> tuple[DataFrame, str | None, int | None]:
    """The stored table ``rows`` with a 64-bit ``key`` for ``cols``: their hash under a seed without
    collisions (so that other tables need no join to get it, and it need not be stored), else a
    running number, in a stored table."""
    seed = _seed(rows, cols)
    if seed is not None:
        return rows.withColumn(key, hashed(cols, seed)), None, seed
    return *store(rows.withColumn(key, F.monotonically_increasing_id()), name), seed


def deal(features: DataFrame, weights: DataFrame, buckets: int | None = None) -> Dealt:
    """Deal ``(user, item, label, mult, feat, value)`` and ``(kind, k1, k2, feat, weight)``: one
    shuffle of the features, as 64-bit keys and numbers.

    A feature without a starting weight takes no part in training.
    """
    spark = configure(features.sparkSession, BUCKETED)
    key = ["user", "item", "y"]
    named, named_path = store(weights.select("kind", "k1", "k2", "feat", F.col("weight").alias("w")), "weights")
    symbols, symbol_path, feat_seed = _numbered(named, ["feat"], "fid", "symbols")
    seen, seen_path = store(features.select("user", "item", "label", F.col("label").cast("int").alias("y"), "mult").distinct(), "examples")
    rows, row_path, ex_seed = _numbered(seen, key, "ex", "examples")
    count = rows.count()
    n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-_bytes(symbols) * COPIES // BUCKET_BYTES), MOST_BUCKETS))
    # At most n * SLOTS users have more than that share of the examples.
    hot = rows.groupBy("user").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > max(LEAST_HOT, count // (n * SLOTS)))
    hot = F.broadcast(hot.select("user", F.lit(True).alias("hot")))
    spread = F.when(F.col("hot"), F.xxhash64("user", "item")).otherwise(F.xxhash64("user"))
    long = features.withColumn("y", F.col("label").cast("int"))
    if ex_seed is None:
        long = long.join(rows.select(*key, "ex"), key)
    if feat_seed is None:
        long = long.join(symbols.select("feat", "fid"), "feat")
    long = long.join(hot, "user", "left").select(
        F.pmod(spread, F.lit(n * SLOTS)).cast("int").alias("b"), (F.col("ex") if ex_seed is None else hashed(key, ex_seed)).alias("ex"),
        F.xxhash64(*key).alias("h"), "label", "mult", (F.col("fid") if feat_seed is None else hashed(["feat"], feat_seed)).alias("fid"), "value")
    dealt, dealt_table = store_bucketed(long, "dealt", n, "b", deal=True)

    used = dealt.select("b", "fid").distinct()
    where = used.groupBy("fid").agg(F.min("b").alias("first"), F.count(F.lit(1)).alias("c"))
    # A starting weight that no example uses has a place of its own beside the others.
    homes = symbols.select("fid", "w").join(where, "fid", "left")
    copies = homes.join(used.select("fid", F.col("b").alias("at")), "fid", "left").select(
        F.coalesce("at", F.pmod("fid", F.lit(n * SLOTS)).cast("int")).alias("b"), "fid", F.coalesce(F.col("c") > 1, F.lit(False)).alias("shared"),
        F.coalesce(F.col("at") == F.col("first"), F.lit(True)).alias("lead"), "w")
    w, w_table = store_bucketed(copies, "weights", n, "b", deal=True)
    examples = rows.select("ex", F.xxhash64(*key).alias("h"), "label", "mult")
    return Dealt(spark, n, dealt, w, examples, symbols.drop("w"), [dealt_table, w_table], [p for p in (named_path, seen_path, symbol_path, row_path) if p])


def gradient_parts(d: Dealt, weights: DataFrame, mult: Column | None = None) -> DataFrame:
    """The buckets' gradient sums (b, fid, part) at ``weights``. ``mult`` counts an example's
    copies anew (a sample)."""
    return back_parts(d, example_errors(d, weights, mult))


def example_errors(d: Dealt, weights: DataFrame, mult: Column | None = None) -> DataFrame:
    """The examples' errors (b, ex, err) at ``weights``."""
    m = margins(d, weights, m=F.col("w"))
    if mult is not None:
        m = m.withColumn("mult", mult).where("mult > 0")
    return m.select("b", "ex", (F.col("mult") * (sigmoid(F.col("m")) - F.col("label"))).alias("err"))


def margins(d: Dealt, vectors: DataFrame, **values: Column) -> DataFrame:
    """(b, ex, h, label, mult, ...): the products of every example with each of the vectors
    ``values``, in one pass over the features. A bucket's vectors are bounded by its size, so
    they are hashed and the features need no sort."""
    met = d.features.join(vectors.select("b", "fid", *[v.alias(f"v_{k}") for k, v in values.items()]).hint("shuffle_hash"), ["b", "fid"])
    sums = [F.sum(F.col("value") * F.col(f"v_{k}")).alias(k) for k in values]
    return met.groupBy("b", "ex").agg(*[F.max(c).alias(c) for c in ("h", "label", "mult")], *sums)


def scaled(d: Dealt) -> tuple[DataFrame, str]:
    """The starting weights (b, fid, shared, lead, w) with each feature's ``scale``, stored: one over the
    sum of its squares over the examples (0 where there are none, since it never moves). Squares need no join with the examples."""
    squares = d.features.groupBy("b", "fid").agg(F.sum(F.col("mult") * F.col("value") * F.col("value")).alias("part"))
    scale = F.when(F.col("grad") > 0, F.lit(1.0) / F.col("grad")).otherwise(F.lit(0.0)).alias("scale")
    cols = ["b", "fid", "shared", "lead", "w"]
    return store_bucketed(d.total(d.weights, squares, "shared", "lead", "w").select(*cols, scale), "scaled", d.buckets, "b")


def back_parts(d: Dealt, errors: DataFrame) -> DataFrame:
    """The buckets' gradient sums (b, fid, part) of the examples' errors (b, ex, err), in one
    pass over the features."""
    met = d.features.select("b", "ex", "fid", "value").join(errors.hint("shuffle_hash"), ["b", "ex"])
    return met.groupBy("b", "fid").agg(F.sum(F.col("err") * F.col("value")).alias("part"))
