"""Shared pieces of the registered plans: session setup and the scenario inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import configure
from skein.sources import fixtures as fx
from skein.sources import profiles as P


def prep(spark: SparkSession) -> SparkSession:
    return configure(spark)


def instances(spark: SparkSession, d: str) -> DataFrame:
    from skein.operators.instances import parse_instances
    return parse_instances(fx.lines(spark, d), fx.LANG)


def window_start(batch_ms: int | None = None):
    """Start of the profile window of a batch: INC-00 from its time."""
    from skein.operators.incremental import profile_start
    return fx.WINDOW_START_TS if batch_ms is None else profile_start(batch_ms, -1)


def _window(spark: SparkSession, d: str, batch_ms: int | None, keep=(), ids: DataFrame | None = None) -> DataFrame:
    return P.latest_per_key(
        P.scan_profiles(fx.art_crawls(spark, d, ids), ["category", "crawled_at"], since=window_start(batch_ms), usable_only=True, keep=keep),
        "article_seq_id", "crawled_at")


def window_profiles(spark: SparkSession, d: str, batch_ms: int | None = None) -> DataFrame:
    """Usable profiles of the 3-day window with a valid category, the latest crawl of each
    article: (article_seq_id, category_idx)."""
    return _window(spark, d, batch_ms).select("article_seq_id", "category_idx")


def window_tfidf(spark: SparkSession, d: str, batch_ms: int | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Content tf-idf (long form) of the window profiles, or of those among ``ids``.

    The window predicate, the ids and the validity rule run before the entity lists are
    exploded, so only those articles are tokenised and counted.
    """
    return fx.entity_tfidf(_window(spark, d, batch_ms, keep=["content_name_entities"], ids=ids), "content")


def window_entities(spark: SparkSession, d: str, batch_ms: int | None = None) -> DataFrame:
    """(article_seq_id, entity): the distinct content entities of the window profiles, uncounted.

    A list is reduced where it is scanned: nothing is grouped by article and entity.
    """
    lists = _window(spark, d, batch_ms, keep=["content_name_entities"])
    return lists.select("article_seq_id", F.explode_outer(F.array_distinct("content_name_entities")).alias("entity")).where(
        F.col("entity").isNotNull())


def active_users(spark: SparkSession, d: str) -> DataFrame:
    from skein.operators.instances import active_users as au
    return au(fx.actions(spark, d), fx.USER_FILTER)


def ms_col(c) -> F.Column:
    from skein.functions.text import epoch_ms
    return epoch_ms(F.col(c) if isinstance(c, str) else c)
