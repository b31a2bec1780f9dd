"""The training and ranking scenario shared by the model queries.

Base inputs of a batch (instances, window profiles, their tf-idf, the user-entity
sets, features, state) are written once, on first use, as Parquet in the shared
folder: every later branch of the plan reads the columns it needs instead of
re-parsing events and re-tokenising texts, and the lineage is cut (the original
persists its profile set per refresh for the same reason).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import store
from skein.operators import features as FT
from skein.operators import placed as PL
from skein.operators import rank as RK
from skein.operators.dealt import Dealt
from skein.plans import common as C
from skein.sources import fixtures as fx


class Scenario:
    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self.global_w = fx.state_global(spark)
        self.user_w = fx.state_user_inferred(spark, d)
        self.item_w = fx.state_item_inferred(spark, d)

    @cached_property
    def instances(self) -> DataFrame:
        return store(C.instances(self.spark, self.d), "instances")[0]

    @cached_property
    def profiles(self) -> DataFrame:
        return store(C.window_profiles(self.spark, self.d), "profiles")[0]

    @cached_property
    def tfidf(self) -> DataFrame:
        return store(C.window_tfidf(self.spark, self.d), "tfidf")[0]

    @cached_property
    def entities(self) -> DataFrame:
        # Articles with their entities, uncounted: all that the users' tags need. Where training
        # has counted the window's texts already, they are not tokenised again.
        if "tfidf" in vars(self):
            return self.tfidf.select("article_seq_id", "entity")
        return store(C.window_entities(self.spark, self.d), "entities")[0]

    @cached_property
    def candidate_tfidf(self) -> DataFrame:
        """Tf-idf of the candidates alone: they are chosen before any text is counted."""
        ids = self.candidates().select("item")
        return store(C.window_tfidf(self.spark, self.d, ids=ids), "candtfidf")[0]

    @cached_property
    def examples(self) -> DataFrame:
        return FT.examples(self.instances)

    @cached_property
    def user_entities(self) -> DataFrame:
        # Left lazy: ranking reads only active users' rows for candidate tags, and the
        # optimizer pushes those semi joins into this derivation instead of building it all.
        return FT.user_entity_set(self.instances, self.profiles, self.entities)

    @cached_property
    def user_entity_w(self) -> DataFrame:
        # The batch's tags and those from earlier batches, of all users.
        return fx.state_user_entity(FT.user_entity_set(self.instances, self.profiles, self.entities, fx.old_user_tags(self.spark, self.d)))

    @cached_property
    def state(self) -> DataFrame:
        """The model state as one stored table, in the batch's buckets: it is read for the gather and
        for the snapshot. Its tags are those of ``user_entity_w``, from the placed batch."""
        own = fx.state_user_entity(self.batch.user_entities(), "b").select("b", F.lit("t").alias("kind"), F.col("user").alias("k1"), F.col("entity").alias("k2"), "weight")

        def others(stored: DataFrame) -> DataFrame:
            held = stored.select("b", F.col("k1").alias("user"), F.col("k2").alias("entity"))
            more = self.batch.more_entities(held, fx.old_user_tags(self.spark, self.d))
            return FT.state_long(self.global_w, self.user_w, self.item_w, fx.state_user_entity(more))

        return self.batch.keep(own, others, "state")

    # --- training ---------------------------------------------------------------
    @cached_property
    def batch(self) -> PL.Placed:
        """The batch's features, stored once for every reader, in buckets by user."""
        return PL.place(self.examples, self.profiles, self.tfidf, fx.ENTITY_SCALAR)

    def features(self) -> DataFrame:
        return self.batch.features()

    def initial_weights(self) -> DataFrame:
        own, others = self.batch.gather(self.state)
        return FT.with_feat(own.drop("b").unionByName(others)).select(*FT.KEY, "feat", "weight")

    @contextmanager
    def dealt(self) -> Iterator[Dealt | None]:
        """The batch dealt for training; None where its keys need numbers (``placed.deal_placed``)."""
        d = PL.deal_placed(self.batch, *self.batch.gather(self.state))
        try:
            yield d
        finally:
            if d is not None:
                d.close()

    def trained(self, iterations: int = 2, step: float = 1.0, fraction: float = 1.0, tol: float = 0.0) -> DataFrame:
        """Warm-start SGD over the stored features."""
        from skein.operators import train as TR
        with self.dealt() as d:
            return TR.sgd(self.features(), self.initial_weights(), iterations, step, fraction, convergence_tol=tol, dealt=d)

    # --- ranking ----------------------------------------------------------------
    def prescored(self) -> DataFrame:
        return RK.prescore(self.profiles, self.item_w)

    @cached_property
    def _candidates(self) -> DataFrame:
        # At most N rows, read by several branches and the pair expansion: stored once.
        return store(RK.top_candidates(self.prescored(), fx.N_CANDIDATES, rounded=True), "candidates")[0]

    def candidates(self, explain: bool = False) -> DataFrame:
        if explain:
            return RK.top_candidates(self.prescored(), fx.N_CANDIDATES, self.global_w, rounded=True)
        return self._candidates

    @cached_property
    def _users(self) -> DataFrame:
        # One narrow row a user; four branches of a ranking read it, so actions are parsed once.
        return store(C.active_users(self.spark, self.d), "users")[0]

    def users(self) -> DataFrame:
        return self._users

    def contributions(self) -> DataFrame:
        cands = self.candidates()
        return RK.pair_contributions(self.users(), cands, self.global_w, self.user_w, self.user_entity_w,
                                     self.candidate_tfidf, fx.ENTITY_SCALAR)

    def scored(self, explain: bool = False) -> DataFrame:
        return RK.score_pairs(self.contributions(), explain, rounded=True)

    def unshown(self, explain: bool = False) -> DataFrame:
        return RK.exclude_shown(self.scored(explain), fx.rec_log(self.spark, self.d), self.candidates())

    def recommended(self, explain: bool = False) -> DataFrame:
        return RK.top_per_user(self.unshown(explain), fx.N_TOP)
