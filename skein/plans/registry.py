"""Registry of query keys: ``QUERIES[key] = fn(spark, sf_dir)`` and ``ORACLE[key] = sql`` of the keys of
SURVEY §2, ``OWN_QUERIES`` and ``OWN_ORACLE`` of this library's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
OWN_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
OWN_ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None, own: bool = False):
    """Register a plan builder under ``key`` with its DuckDB oracle (None: rows-only check). ``own``:
    a key that SURVEY does not have."""
    queries, oracles = (OWN_QUERIES, OWN_ORACLE) if own else (QUERIES, ORACLE)

    def wrap(fn):
        if key in QUERIES or key in OWN_QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from skein.plans.common import prep
            return fn(prep(spark), sf_dir.rstrip("/"))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        queries[key] = run
        if oracle is not None:
            oracles[key] = oracle
        return fn

    return wrap


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from skein.plans import (  # noqa: F401
        q_events, q_incremental, q_model, q_profiles, q_store, q_stream, q_text,
    )
