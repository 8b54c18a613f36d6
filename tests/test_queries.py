"""Every registered query against its DuckDB equivalent."""

import pytest
from conftest import SF_DIR
from oracle import differences, duck

import __spark_entry__ as entry
from vectable.workload.oracles import oracles
from vectable.workload.queries import QUERIES

SQL = oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry_counts_rows_per_partition(spark):
    assert {r.asDict()["__partition"]: r.row_count for r in entry.entry(spark).collect()} == {
        "_default": 248, "p5": 51, "p6": 42, "p7": 50, "p8": 46, "p9": 63,
    }
