"""Incremental maintenance: window starts, dictionary upserts, state snapshots (INC-*, SET-03, JN-04).

Built-in Parquet has no MERGE, so state lives in versioned directories: a new
version is ``updates UNION (old LEFT ANTI updated keys)`` written to a fresh
path, and a pointer table names the current one. Writing a version is also
the lineage cut between batches. Where the state is large beside a batch, the
``*_delta`` forms keep it in a keyed table (``sinks/keyed.py``) and write only what
the batch touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.constants import PROFILE_WINDOW_MS
from skein.sinks.keyed import KeyedTable
from skein.sources.profiles import latest_per_key

MARGIN_MS = 0


def start_ms(target_ms: Column, last_ms: Column, window_ms: int = PROFILE_WINDOW_MS, margin_ms: int = MARGIN_MS) -> Column:
    """INC-00: ``t <= window → 0``; ``last < 0 or t − last > window → t − window``; else ``last`` (minus margin)."""
    return (
        F.when(target_ms <= F.lit(window_ms + margin_ms), F.lit(0).cast("bigint"))
        .when((last_ms < 0) | (target_ms - last_ms > F.lit(window_ms)), target_ms - F.lit(window_ms + margin_ms))
        .otherwise(last_ms - F.lit(margin_ms))
    )


def user_dict_start(batch_ms: int, last_ms: int, dict_empty: bool) -> int:
    """INC-01's rule: an empty dictionary or ``last < 0`` rescans from 0, else from ``last``."""
    return 0 if dict_empty or last_ms < 0 else last_ms - MARGIN_MS


def article_dict_start(batch_ms: int, last_ms: int, dict_empty: bool, window_ms: int = PROFILE_WINDOW_MS) -> int:
    """INC-02/04/05's rule: empty, ``last < 0`` or a gap over the window → ``batch − window``."""
    if dict_empty or last_ms < 0 or batch_ms - last_ms > window_ms:
        return batch_ms - window_ms - MARGIN_MS
    return last_ms - MARGIN_MS


def profile_start(batch_ms: int, last_ms: int, window_ms: int = PROFILE_WINDOW_MS) -> int:
    """INC-03's rule (INC-00 on plain numbers)."""
    if batch_ms <= window_ms + MARGIN_MS:
        return 0
    if last_ms < 0 or batch_ms - last_ms > window_ms:
        return batch_ms - window_ms - MARGIN_MS
    return last_ms - MARGIN_MS


def upsert(old: DataFrame, updates: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """SET-03: new entries override old ones; duplicate keys within ``updates`` resolve by ``order_col``.

    ``old LEFT ANTI updates`` keeps untouched keys (JN-04); no eviction (Q5).
    """
    if order_col is not None:
        updates = latest_per_key(updates, key, order_col)
    cols = updates.columns
    kept = old.select(*cols).join(updates.select(key), key, "left_anti")
    return updates.unionByName(kept)


def keep_untouched(old: DataFrame, touched_keys: DataFrame, key: str) -> DataFrame:
    """JN-04: rows of ``old`` whose key is not in ``touched_keys``."""
    return old.join(touched_keys.select(key).distinct(), key, "left_anti")


def update_info(dictionary: DataFrame, start: int) -> DataFrame:
    """What a dictionary update reports: its number of entries and the start of its scan."""
    return dictionary.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(start).cast("bigint").alias("start_ms"))


def snapshot(old: DataFrame, trained: DataFrame, only_positive_tags: bool = True) -> DataFrame:
    """INC-06 over the long state ``(kind, k1, k2, weight)``.

    ``trained``: every weight the batch trained, tags of any sign included. Exactly those
    keys are replaced; a tag trained to zero or below is gone (``only_positive_tags``), and
    what the batch did not train, also of its own users, carries over.
    """
    from skein.operators.features import KEY, KEY_HASH, with_key_hash, write_back

    cols = [c for c in old.columns if c != "b"]
    if "b" in old.columns and "own" in trained.columns:   # in the buckets of a placed batch
        owned, others = F.col("kind").isin("u", "t"), trained.where("not own").select(*KEY)
        kept = old.where(owned).join(trained.where("own").select("b", *KEY).hint("shuffle_hash"), ["b", *KEY], "left_anti").select(*cols)
        if not others.where(owned).isEmpty():   # of users that are spread over the buckets
            kept = kept.join(others.where(owned), KEY, "left_anti")
        kept = kept.unionByName(old.where(~owned).join(others, KEY, "left_anti").select(*cols))
    else:
        kept = with_key_hash(old).join(with_key_hash(trained.select(*KEY)), [KEY_HASH, *KEY], "left_anti").select(*cols)
    return write_back(trained, only_positive_tags).select(*cols).unionByName(kept)


def snapshot_delta(table: KeyedTable, trained: DataFrame, batch: int, only_positive_tags: bool = True) -> bool:
    """INC-06 as a delta of a stored state ``(kind, k1, k2, weight)``: writes the trained keys
    alone; a tag trained to zero or below is taken out (``only_positive_tags``)."""
    from skein.operators.features import write_back

    gone = trained.where((F.col("kind") == "t") & (F.col("weight") <= 0)) if only_positive_tags else None
    return table.apply(write_back(trained, only_positive_tags), batch, gone)


def upsert_delta(table: KeyedTable, updates: DataFrame, batch: int, order_col: str | None = None) -> bool:
    """SET-03 as a delta of a stored dictionary: writes the updated keys alone."""
    if order_col is not None:
        updates = latest_per_key(updates, table.key[0], order_col)
    return table.apply(updates, batch)


def write_version(df: DataFrame, root: str, name: str, version: str, mode: str = "errorifexists") -> str:
    """Write one state version to ``root/name/v=<version>`` and return the path."""
    path = f"{root}/{name}/v={version}"
    df.write.mode(mode).parquet(path)
    return path
