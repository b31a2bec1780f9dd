"""A batch in buckets by user: features, state and weights meet where they lie.

Nearly all features of a batch, and nearly all weights of a state, belong to one user (kinds ``u``
and ``t``). So an example's features are stored as one nested row in the bucket ``b`` of its user, and
a state's row in the bucket of its ``k1``: the *own* features find their weights, are made distinct and
are trained without an exchange. What travels is one row an example (its features nested) when the
batch is placed, and the other features: those of categories and items, which many users share, and
those of a user of very many examples or features, who is spread over the buckets by item.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import BUCKETED, append_bucketed, buckets_scanned, configure, store, store_bucketed
from skein.operators import features as FT
from skein.operators.dealt import LEAST_HOT, SLOTS, Dealt, sigmoid

ROWS_A_BUCKET = 250_000     # features, about: a task hashes a bucket's state and its weights at once, 200 bytes a row and more
MOST_NESTED = ROWS_A_BUCKET   # features of a user that is not spread
AT = ["b", *FT.KEY]
OWNED, UNOWNED = "kind in ('u', 't')", "kind not in ('u', 't')"


@dataclass
class Placed:
    """``examples`` (b, spread, user, item, label, mult, rows, tags): a bucketed table; ``tags`` are the
    example's features (kind, k, value) of kind ``t``, ``rows`` the others. ``hot``: the users that are spread, None if there are none."""

    spark: SparkSession
    buckets: int
    examples: DataFrame
    hot: DataFrame | None

    def home(self, key: Column) -> Column:
        """The bucket number of a user, or of a state row's ``k1``."""
        return F.pmod(F.xxhash64(key), F.lit(self.buckets * SLOTS)).cast("int")

    def features(self, tags: bool = True) -> DataFrame:
        """The long features as ``features.train_features`` gives them, with their bucket ``b`` and
        whether they are ``own``: of one user and so of one bucket. ``tags``: also those of kind ``t``."""
        f = self.examples.select("b", "spread", *FT.EX, "mult", F.explode(F.concat("rows", "tags") if tags else "rows").alias("f"))
        kind, k = F.col("f.kind"), F.col("f.k")
        f = f.select("b", (kind.isin("u", "t") & ~F.col("spread")).alias("own"), *FT.EX, "mult", kind.alias("kind"),
                     F.when(kind == "g", k).when(kind == "i", F.col("item")).otherwise(F.col("user")).alias("k1"),
                     F.when(kind.isin("u", "t"), k).otherwise(F.lit("")).alias("k2"), F.col("f.value").alias("value"))
        return FT.with_feat(f)

    def own_symbols(self) -> DataFrame:
        """The distinct own features (b, kind, k1, k2), in their buckets."""
        cats = F.transform(F.filter("rows", lambda f: f["kind"] == "u"), lambda f: f["k"])
        each = self._users(cats=cats, tags=F.col("tags.k"))
        each = each.select("b", "user", F.size("cats").alias("n"), F.posexplode(F.concat("cats", "tags")).alias("at", "k2"))
        return each.select("b", F.when(F.col("at") < F.col("n"), "u").otherwise("t").alias("kind"), F.col("user").alias("k1"), "k2")

    def _users(self, **lists: Column) -> DataFrame:
        """A row a user in their place (b, user, ...): what ``lists`` of strings of the examples hold,
        each once. Made distinct by user, since hardly any of a user's features repeat: a table of all
        features would be hashed twice. A list has ``MOST_NESTED`` features at most; users of more are spread."""
        whole = self.examples.where("not spread").groupBy("b", "user")
        return whole.agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(name) for name, c in lists.items()])

    def other_symbols(self) -> DataFrame:
        """The distinct other features (kind, k1, k2)."""
        return self.other_features().select(*FT.KEY).distinct()

    def other_features(self) -> DataFrame:
        """The features that are not ``own``; only a spread user's tags are among them."""
        return self.features(tags=self.hot is not None).where("not own")

    def symbols(self) -> DataFrame:
        """As ``features.batch_symbols``: (kind, k1, k2, feat)."""
        return FT.with_feat(self.own_symbols().select(*FT.KEY).unionByName(self.other_symbols()))

    def user_entities(self) -> DataFrame:
        """AGG-01 over the placed batch: (b, user, entity) of the users in their place."""
        return self._users(tags=F.col("tags.k")).select("b", "user", F.explode("tags").alias("entity"))

    def more_entities(self, held: DataFrame, older: DataFrame) -> DataFrame:
        """(user, entity) of the spread users and of ``older`` that are not among the stored ``held``
        of ``user_entities``."""
        tags = self.other_features().where("kind = 't'")
        more = older.distinct() if self.hot is None else tags.select("user", F.col("k2").alias("entity")).unionByName(older).distinct()
        more = more.select(self.home(F.col("user")).alias("b"), "user", "entity").repartition(self.buckets, "b")
        same = [held[c].eqNullSafe(F.col(f"o_{c}")) for c in ("user", "entity")]
        met = held.join(more.select(F.col("b").alias("o_b"), F.col("user").alias("o_user"), F.col("entity").alias("o_entity")).hint("shuffle_hash"),
                        [held["b"] == F.col("o_b"), *same], "left_semi")
        met = met.select(F.col("b").alias("m_b"), F.col("user").alias("m_user"), F.col("entity").alias("m_entity"))
        new = more.join(met.hint("shuffle_hash"), [more["b"] == F.col("m_b"), *[more[c].eqNullSafe(F.col(f"m_{c}")) for c in ("user", "entity")]], "left_anti")
        return new.select("user", "entity")

    def keep(self, own: DataFrame, others: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
        """A stored table of ``own`` rows (b, ...), in their buckets already, and of ``others`` (of the
        stored ones), which are brought to the bucket of their ``k1``."""
        stored, table = store_bucketed(own, name, self.buckets, "b")
        others = others(stored).withColumn("b", self.home(F.col("k1"))).select(*own.columns)
        return append_bucketed(others.repartition(self.buckets, "b"), table, self.buckets, "b")

    def gather(self, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        """JN-06 / ML-03 in the buckets: the weight of every feature from a state that ``keep`` has
        stored, 0 when new. Own ones (b, kind, k1, k2, weight), and the others without ``b``."""
        weight = F.coalesce(F.col("weight"), F.lit(0.0)).alias("weight")
        stored = state.select(*AT, "weight")
        own = self.own_symbols().join(stored.where(OWNED).hint("shuffle_hash"), AT, "left").select(*AT, weight)
        shared = stored.where(UNOWNED)
        if self.hot is not None:
            shared = shared.unionByName(stored.where(OWNED).join(F.broadcast(self.hot.select(F.col("user").alias("k1"))), "k1", "left_semi").select(*AT, "weight"))
        others = self.other_symbols().join(shared.drop("b"), FT.KEY, "left").select(*FT.KEY, weight)
        return own, others

    # --- one pass over the features --------------------------------------------------
    def dots(self, own: DataFrame, others: DataFrame) -> DataFrame:
        """FN-17 in the buckets: x·w per example (b, user, item, label, mult, dot)."""
        key = ["b", *FT.EX, "mult"]
        product = F.sum(F.col("value") * F.coalesce(F.col("weight"), F.lit(0.0))).alias("dot")
        here = self.features().where("own").select(*key, *FT.KEY, "value").join(own.hint("shuffle_hash"), AT, "left").groupBy(*key).agg(product)
        away = self.other_features().select(*key, *FT.KEY, "value").join(others, FT.KEY, "left").groupBy(*key).agg(product)
        return here.unionByName(away).groupBy(*key).agg(F.sum("dot").alias("dot"))

    def gradient(self, own: DataFrame, others: DataFrame) -> DataFrame:
        """AGG-10 in the buckets: (feat, grad) of every feature at the given weights."""
        ex = ["b", "user", "item", "y"]
        err = (F.col("mult") * (sigmoid(F.col("dot")) - F.col("label"))).alias("err")
        errors = store_bucketed(self.dots(own, others).select("b", "user", "item", F.col("label").cast("int").alias("y"), err), "errors", self.buckets, "b", deal=True)[0]
        def met(features):
            return features.select("b", "user", "item", F.col("label").cast("int").alias("y"), *FT.KEY, "value").join(errors.hint("shuffle_hash"), ex)

        total = F.sum(F.col("err") * F.col("value")).alias("grad")
        here = met(self.features().where("own")).groupBy(*AT).agg(total).select(*FT.KEY, "grad")
        sums = here.unionByName(met(self.other_features()).groupBy(*FT.KEY).agg(total))
        return FT.with_feat(sums).select("feat", "grad")


def place(ex: DataFrame, profiles: DataFrame, tfidf: DataFrame, entity_scalar: float, buckets: int | None = None,
          rows_per_salt: int = FT.ROWS_PER_SALT) -> Placed:
    """ML-01 in buckets by user: the features of ``features.train_features``, nested by example.

    ``profiles``: one row an item; ``tfidf``: limited to them. An item's tags are one row, so one
    join brings its categories and tags; hot items are salted in it.
    """
    spark = configure(ex.sparkSession, BUCKETED)
    ex = store(ex.select(*FT.EX, "mult"), "examples")[0]

    def row(kind, k, value):
        return F.struct(F.lit(kind).alias("kind"), k.cast("string").alias("k"), value.alias("value"))

    tags = tfidf.groupBy(F.col("article_seq_id").alias("item")).agg(
        F.collect_list(row("t", F.col("entity"), F.lit(entity_scalar) * F.col("tfidf"))).alias("tags"))
    items = store(profiles.select(F.col("article_seq_id").alias("item"), "category_idx").join(tags, "item", "full"), "items")[0]
    one = F.lit(1.0)
    cats = F.coalesce("category_idx", F.array().cast("array<int>"))
    size = items.select("item", (1 + 2 * F.size(cats) + F.coalesce(F.size("tags"), F.lit(0))).alias("size"))
    users = store(ex.select("user", "item").join(size, "item", "left").groupBy("user").agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.coalesce("size", F.lit(1))).alias("rows")), "users")[0]
    count, rows = users.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_BUCKET))
    # At most n * SLOTS users have more than that share of the examples.
    hot = users.where((F.col("c") > max(LEAST_HOT, count // (n * SLOTS))) | (F.col("rows") > MOST_NESTED)).select("user")
    hot = None if hot.isEmpty() else hot
    dealt, parts = FT.salted(ex, items, "item", ["user", "label"], rows_per_salt)
    spread = F.lit(False)
    if hot is not None:
        dealt, spread = dealt.join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), "user", "left"), F.coalesce("is_hot", F.lit(False))
    by = F.when(spread, F.xxhash64("user", "item")).otherwise(F.xxhash64("user"))
    found = F.concat(F.array(row("i", F.lit(""), one)), F.transform(cats, lambda c: row("g", c, one)), F.transform(cats, lambda c: row("u", c, one)))
    found_tags = F.coalesce("tags", F.array().cast("array<struct<kind:string,k:string,value:double>>"))
    nested = dealt.join(parts, ["item", "salt"], "left").select(
        F.pmod(by, F.lit(n * SLOTS)).cast("int").alias("b"), spread.alias("spread"), *FT.EX, "mult", found.alias("rows"), found_tags.alias("tags"))
    return Placed(spark, n, store_bucketed(nested, "features", n, "b", deal=True)[0], hot)


def fid() -> Column:
    return F.xxhash64(*FT.KEY)


def deal_placed(p: Placed, own: DataFrame, others: DataFrame) -> Dealt | None:
    """``dealt.deal`` of a placed batch: nothing of its own features travels. None where two
    features, or two examples, of a bucket or of the others would share their hash, or where a
    feature has several weights: those need numbers."""
    key = ["user", "item", "y"]
    others = store(others.withColumn("fid", fid()), "others")[0]
    examples = p.examples.select("b", F.xxhash64(*FT.EX[:2], F.col("label").cast("int")).alias("ex"), "label", "mult")
    if not (others.groupBy("fid").count().where("count > 1").isEmpty() and examples.groupBy("b", "ex").count().where("count > 1").isEmpty()):
        return None
    f = p.features().withColumn("y", F.col("label").cast("int")).select("b", F.xxhash64(*key).alias("ex"), "label", "mult", fid().alias("fid"), "value", "own")
    with buckets_scanned(p.spark):
        features, f_table = store_bucketed(f, "dealt", p.buckets, "b")
    features = features.withColumn("h", F.col("ex"))
    cols = ["b", "fid", "shared", "lead", F.col("weight").alias("w"), *FT.KEY]
    held = own.withColumn("fid", fid()).withColumn("shared", F.lit(False)).withColumn("lead", F.lit(True))
    w_table = store_bucketed(held.select(*cols), "weights", p.buckets, "b")[1]
    used = features.where("not own").select("b", "fid").distinct()
    first = used.groupBy("fid").agg(F.min("b").alias("first"))
    copies = used.join(first, "fid").join(others, "fid").withColumn("shared", F.lit(True)).withColumn("lead", F.col("b") == F.col("first"))
    w = append_bucketed(copies.select(*cols).repartition(p.buckets, "b"), w_table, p.buckets, "b")
    if not w.groupBy("b", "fid").count().where("count > 1").isEmpty():
        return None
    symbols = FT.with_feat(w.where("lead").select("fid", *FT.KEY))
    return Dealt(p.spark, p.buckets, features, w, examples.select("ex", F.col("ex").alias("h"), "label", "mult"), symbols, [f_table, w_table], [], placed=True)
