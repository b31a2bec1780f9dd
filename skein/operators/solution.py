"""The solution protocol: a model that learns from instances and ranks items.

State is four keyed tables, written by version below a model folder and read by path;
every step is a DataFrame job over them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import store
from skein.operators import features as FT
from skein.operators import incremental as INC
from skein.operators import rank as RK

STATE_SCHEMA = "kind string, k1 string, k2 string, weight double"


class Solution(Protocol):
    def init(self, model_dir: str) -> None: ...
    def save(self, model_dir: str) -> None: ...
    def set_info_dir(self, path: str | None) -> None: ...
    def prepare(self, batch_ms: int) -> None: ...
    def features(self, instances: DataFrame) -> DataFrame: ...
    def gen_weights(self) -> DataFrame: ...
    def update_by_weights(self, weights: DataFrame) -> None: ...
    def rank(self, users: DataFrame, n_candidates: int) -> DataFrame: ...
    def latest_weights(self) -> DataFrame: ...


def read_state(spark: SparkSession, model_dir: str) -> DataFrame:
    """The long state of a stored model."""
    return spark.read.schema(STATE_SCHEMA).parquet(f"{model_dir}/state")


@dataclass
class CategoryEntitySolution:
    """Categories, item and user-category weights, and user tags from article entities.

    ``load_profiles(start_ms)`` returns (profiles, tf-idf in long form) of the window.
    """

    spark: SparkSession
    load_profiles: Callable[[int], tuple[DataFrame, DataFrame]]
    entity_scalar: float
    only_positive_tags: bool = True
    state: DataFrame | None = None
    info_dir: str | None = None
    profiles: DataFrame | None = None
    tfidf: DataFrame | None = None
    batch: DataFrame | None = None
    used: DataFrame | None = field(default=None, repr=False)

    def init(self, model_dir: str) -> None:
        """Read the state of a stored model."""
        self.state = read_state(self.spark, model_dir)

    def save(self, model_dir: str) -> None:
        """Write the state as the version ``model_dir`` and go on from it."""
        self.state.write.parquet(f"{model_dir}/state")
        self.init(model_dir)

    def set_info_dir(self, path: str | None) -> None:
        self.info_dir = path

    def prepare(self, batch_ms: int) -> None:
        """Load the profiles of the window that ends at the batch's time."""
        start = INC.profile_start(batch_ms, -1)
        profiles, tfidf = self.load_profiles(start)
        self.profiles, self.tfidf = store(profiles, "profiles")[0], store(tfidf, "tfidf")[0]
        if self.info_dir is not None:
            n = self.profiles.agg(F.concat(F.count(F.lit(1)).cast("string"), F.lit(f" since {start}")).alias("value"))
            n.write.mode("overwrite").text(f"{self.info_dir}/profile_info")
            self.profiles.write.mode("overwrite").parquet(f"{self.info_dir}/profile_dump")

    def features(self, instances: DataFrame) -> DataFrame:
        """Long features of the instances, stored; they are the batch that training updates."""
        self.batch = store(FT.train_features(FT.examples(instances), self.profiles, self.tfidf, self.entity_scalar), "features")[0]
        return self.batch

    def gen_weights(self) -> DataFrame:
        """The state's weight of every feature of the batch, 0 if new."""
        return FT.gather_weights(FT.batch_symbols(self.batch), self.state)

    def update_by_weights(self, weights: DataFrame) -> None:
        """Replace the trained keys in the state; the rest carries over."""
        self.state = store(INC.snapshot(self.state, weights, self.only_positive_tags), "state")[0]

    def rank(self, users: DataFrame, n_candidates: int) -> DataFrame:
        """(user, item, score, explanation) over the best candidates."""
        s = FT.split_state(self.state)
        cands = store(RK.top_candidates(RK.prescore(self.profiles, s["item_inferred"]), n_candidates), "candidates")[0]
        contrib = RK.pair_contributions(users, cands, s["global"], s["user_inferred"], s["user_entity"],
                                        RK.candidate_tags(cands, self.tfidf), self.entity_scalar)
        self.used = contrib.select("feat", F.coalesce("weight", F.lit(0.0)).alias("weight")).distinct()
        return RK.score_pairs(contrib, explain=True)

    def latest_weights(self) -> DataFrame:
        """The weights that the last ranking read."""
        return self.used
