"""Every query that has SQL gives the same rows as DuckDB."""

import oracle
import pytest
from __spark_entry__ import entry, oracle_sql, queries

from drover.registry import ALL

SMALL = f"{oracle.DATA}/sf0.001"
CHUNKED = f"{oracle.DATA}/sf0.01"


@pytest.fixture(scope="module")
def small():
    return oracle.connect(SMALL)


@pytest.fixture(scope="module")
def chunked():
    return oracle.connect(CHUNKED)


@pytest.mark.parametrize("name", sorted(n for n, q in ALL.items() if q.sql is not None))
def test_query_matches_sql(spark, small, name):
    oracle.compare(spark, name, SMALL, small)


# At this size the 60,000 lines fall into several chunks.
@pytest.mark.parametrize(
    "name", ["row_index", "seq_sorted", "seq_changing", "seq_hold", "slice_deep", "insert_pk_check"]
)
def test_chunked_query_matches_sql(spark, chunked, name):
    assert oracle.compare(spark, name, CHUNKED, chunked) > 0


def test_entry_and_registry(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
