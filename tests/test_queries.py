"""Every registered query against its SQL in DuckDB, on the small tables."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import compare, duck

SMALL = os.environ.get("TEST_SMALL_SF_DIR", "/root/testdata/sf0.001")
SLOW = {"ml_1_train", "ml_2_cross_validate", "ml_5_select_best"}
# no row of the small tables meets these conditions
MAY_BE_EMPTY = {"win_2_channel_events", "vec_3_threshold", "str_10_rollout", "str_10_rollout_stream"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(set(queries()) - SLOW))
def test_query(spark, con, name):
    sql = oracle_sql().get(name)
    ok, note = compare(spark, con, SMALL, name, queries()[name], sql)
    assert ok or (name in MAY_BE_EMPTY and note.startswith("0 rows")), note


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
