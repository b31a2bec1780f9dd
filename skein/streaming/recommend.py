"""Micro-batch recommendation: per batch, refresh profiles when due, rank, publish (STR-02..05).

Each ``foreachBatch`` call runs one DataFrame plan for the batch's distinct users
(per-batch ``distinct``, not stateful de-duplication, Q8). Publications go to an
append-only log partitioned by batch id: a batch writes only its own users' rows
(and tombstones) into ``batch_id=<id>``, overwriting that directory if the batch is
retried, so delivery is idempotent; the batch's time is stored with it, so a retry has the
same one. ``current_lists`` gives the lists in force.

What a restart must know is in a versioned pointer beside the log: the root that a compaction
moved the log to, the last batch folded into its base (a retry of such a batch changes
nothing), and the time of the last refresh (a restarted recommender loads that window again).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import instances as I
from skein.operators import rank as RK
from skein.operators.incremental import profile_start
from skein.sinks.publish import current_lists, latest_model_path, load_pointer, publication_rows, rec_feature_blocks, save_pointer
from skein.sinks.store import save_lines
from skein.streaming.instances import batch_dir, batch_time


def refresh_due(batch_ms, last_ms, interval_ms: int):
    """STR-04: first batch (``last < 0``) or ``batch − last >= interval``; on columns or numbers."""
    return (last_ms < 0) | (batch_ms - last_ms >= interval_ms)


def active_users(actions: DataFrame, version: str, col: str = "line") -> DataFrame:
    """STR-02's body: parse actions, keep the served version (or none), distinct users."""
    return I.active_users(actions, version, col)


@dataclass
class Model:
    """What a batch ranks with: window profiles, their tf-idf, candidates, and the state tables."""
    profiles: DataFrame
    tfidf: DataFrame
    global_w: DataFrame
    user_w: DataFrame
    item_w: DataFrame
    user_entity_w: DataFrame
    candidates: DataFrame | None = None


@dataclass
class Recommender:
    """``load_model(batch_ms)`` gives the window's profiles and the state; with ``pointers``
    (the model pointer table) the state is read again, by the newest path, in every batch:
    ``load_state(path)`` returns the four tables global, user_inferred, item_inferred and
    user_entity. ``dump_root`` turns on the per-batch dumps."""

    spark: SparkSession
    load_model: Callable[[int], Model]
    rec_log: Callable[[], DataFrame]
    published_root: str
    version: str
    n_top: int
    n_candidates: int
    entity_scalar: float
    interval_ms: int
    expire_hours: int
    result_template: str
    last_refresh_ms: int = -1
    model: Model | None = None
    now_ms: Callable[[], int] = field(default=lambda: int(time.time() * 1000))
    pointers: Callable[[], DataFrame] | None = None
    model_key: str | None = None
    load_state: Callable[[str], dict[str, DataFrame]] | None = None
    dump_root: str | None = None
    tag: str | None = None
    rounded: bool = False

    def __post_init__(self):
        self.times_root = f"{self.published_root}_info"
        self.pointer_root = f"{self.published_root}_pointer"
        self.folded = -1
        last = load_pointer(self.spark, self.pointer_root)
        if last is not None:
            self.published_root, self.folded, self.last_refresh_ms = last["log_root"], last["folded"], last["refresh_ms"]

    def _note(self) -> None:
        save_pointer(self.spark, self.pointer_root, self.published_root, self.folded, self.last_refresh_ms)

    def refresh(self, batch_ms: int) -> None:
        """Reload and persist the profiles of the window ending at ``batch_ms`` (spill to disk allowed)."""
        self._load(batch_ms)
        self.last_refresh_ms = batch_ms
        self._note()

    def _load(self, batch_ms: int) -> None:
        if self.model is not None:
            for df in (self.model.profiles, self.model.tfidf, self.model.candidates):
                if df is not None:
                    df.unpersist()
        m = self.load_model(batch_ms)
        m.profiles = m.profiles.persist()
        m.tfidf = m.tfidf.persist()
        self.model = m
        self._choose()

    def _choose(self) -> None:
        m = self.model
        if m.candidates is not None:
            m.candidates.unpersist()
        m.candidates = RK.top_candidates(RK.prescore(m.profiles, m.item_w), self.n_candidates, rounded=self.rounded).persist()

    def use_newest_model(self) -> str | None:
        """Point the state at the newest published model; its path (null without pointers)."""
        if self.pointers is None:
            return None
        found = latest_model_path(self.pointers().where(F.col("model_key") == self.model_key)).first()
        if found is None:
            return None
        state = self.load_state(found["path"])
        m = self.model
        m.global_w, m.user_w, m.item_w, m.user_entity_w = (state[k] for k in ("global", "user_inferred", "item_inferred", "user_entity"))
        self._choose()
        return found["path"]

    def rank(self, users: DataFrame, explain: bool = False) -> DataFrame:
        m = self.model
        cands = m.candidates
        contrib = RK.pair_contributions(users, cands, m.global_w, m.user_w, m.user_entity_w,
                                        RK.candidate_tags(cands, m.tfidf), self.entity_scalar)
        scored = RK.score_pairs(contrib, explain, rounded=self.rounded)
        return RK.top_per_user(RK.exclude_shown(scored, self.rec_log(), cands), self.n_top)

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.folded:
            return      # published before, and part of the base since: a retry has nothing to add
        batch_ms = batch_time(self.spark, self.times_root, batch_id, self.now_ms)
        due = refresh_due(batch_ms, self.last_refresh_ms, self.interval_ms)
        if due:
            self.refresh(batch_ms)
        elif self.model is None:
            self._load(self.last_refresh_ms)
        path = self.use_newest_model()
        users = active_users(batch, self.version).persist()
        recs = self.rank(users, explain=self.dump_root is not None).persist()
        rows = publication_rows(users, recs, batch_ms, self.expire_hours, self.result_template)
        rows.write.mode("overwrite").parquet(f"{self.published_root}/batch_id={batch_id}")
        if self.dump_root is not None:
            self._dump(batch_ms, users, recs, path, due)
        recs.unpersist()
        users.unpersist()

    def _dump(self, batch_ms: int, users: DataFrame, recs: DataFrame, path: str | None, refreshed: bool) -> None:
        """Below the batch's path: info, users, explained lists and candidates, and after a
        refresh the profiles with their count."""
        base = batch_dir(self.dump_root, dt.datetime.fromtimestamp(batch_ms / 1000, dt.timezone.utc), self.tag)
        m = self.model
        note = users.agg(F.concat(F.lit("#user = "), F.count(F.lit(1)).cast("string")).alias("value"))
        first = self.spark.range(1).select(F.lit(f"model_path = {path}").alias("value"))
        save_lines(first.unionByName(note), f"{base}/info")
        save_lines(users, f"{base}/users", "user")
        save_lines(rec_feature_blocks(recs), f"{base}/rec_feature", "block")
        save_lines(m.candidates.select(F.concat_ws("\t", "item", F.col("score").cast("string")).alias("value")), f"{base}/candidate")
        if refreshed:
            start = profile_start(batch_ms, -1)
            n = m.profiles.agg(F.concat(F.count(F.lit(1)).cast("string"), F.lit(f" since {start}")).alias("value"))
            save_lines(n, f"{base}/profile_info")
            m.profiles.join(m.tfidf.groupBy("article_seq_id").agg(F.map_from_entries(F.collect_list(F.struct("entity", "tfidf"))).alias("tfidf")),
                            "article_seq_id", "left").write.mode("overwrite").parquet(f"{base}/profile_dump")

    def current(self, now_ms: int | None = None) -> DataFrame:
        """The lists in force after the batches so far (at ``now_ms``, if given)."""
        return current_lists(self.spark.read.parquet(self.published_root), now_ms)

    def compact(self, new_root: str, upto_batch: int, now_ms: int | None = None) -> None:
        """Fold the log into a base under ``new_root`` and publish from there on.

        Batches after ``upto_batch`` already written are copied over as they are. Every step
        overwrites what a failed try has left, and the move counts once the pointer is written.
        """
        from skein.sinks.publish import compact
        log = self.spark.read.parquet(self.published_root)
        compact(log, upto_batch, new_root, now_ms)
        later = log.where(F.col("batch_id") > upto_batch)
        later.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(new_root)
        self.published_root, self.folded = new_root, upto_batch
        self._note()


def start_recommender(actions: DataFrame, recommender: Recommender, checkpoint: str, batch_seconds: int | None = None):
    """Run ``recommender`` over a stream of action lines (column ``line``), STR-03/05.

    ``batch_seconds`` sets a fixed processing-time trigger (the original's micro-batch
    interval); without it every available input is processed once (``availableNow``).
    The checkpoint must sit in the shared folder so a restarted driver resumes.
    """
    w = actions.writeStream.foreachBatch(recommender.handle).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=f"{batch_seconds} seconds") if batch_seconds else w.trigger(availableNow=True)
    return w.start()
