"""Each registered query against its DuckDB oracle on the driver tables.

All keys run at sf0.001; ``SKEIN_QUICK_ORACLE=1`` runs a representative subset.
"""

import os

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of

QUICK = [
    "parse_instances", "parse_instances_pair", "filter_events", "explode_impressions", "json_parse", "event_ts",
    "instance_profile_join", "profile_category", "profile_by_ids", "user_categories_full", "profile_title_entities",
    "profile_content_tfidf", "profile3", "drop_bad_rows", "time_gt", "time_gte", "encode_custom_category",
    "category_names", "train_features", "feature_registry", "sgd_train", "candidate_topn", "rank_explained",
    "recommend", "rec_publish", "dict_upsert", "state_snapshot", "start_ms", "word_count", "md5_bucket",
    "registry_load", "sparse_weights_load", "active_users_batch", "recommend_batch", "last_per_key",
]

from skein.plans.registry import ORACLE, QUERIES, load_all

load_all()
KEYS = QUICK if os.environ.get("SKEIN_QUICK_ORACLE") else sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = QUERIES, ORACLE
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql())
    assert len(q) == 114
    assert set(o) <= set(q)
    assert set(q) == set(o)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    ocols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, srows) == rows_of(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["user", "rank", "item", "score"]
    assert len(rows) > 0
