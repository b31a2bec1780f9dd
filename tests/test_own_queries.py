"""This library's own queries against their DuckDB SQL, as ``test_oracle.py`` checks those of SURVEY."""

import pytest

import __spark_entry__ as E
from skein.plans.registry import OWN_ORACLE, OWN_QUERIES
from test_oracle import con, test_matches_oracle as matches  # noqa: F401


def test_own_queries_are_among_the_registered():
    assert set(OWN_QUERIES) == {"state_deltas", "state_lookup", "dict_deltas", "line_routes", "stream_dead_letters"}
    assert set(OWN_ORACLE) == set(OWN_QUERIES) and set(OWN_QUERIES) <= set(E.queries()) and set(OWN_ORACLE) <= set(E.oracle_sql())
    assert len(E.queries()) == 114 + len(OWN_QUERIES) + len(E._corpus()[0])


@pytest.mark.parametrize("key", sorted(OWN_ORACLE))
def test_own_queries_match(spark, con, key):  # noqa: F811
    matches(spark, con, key)
