"""Every registered query against DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry
from check_oracle import compare, connect
from tableops.catalog import queries
from tableops.catalog.oracle import ORACLE_SQL
from tableops.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name, QUERIES[name], ORACLE_SQL[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) >= 25


def test_multiline_files_are_few(spark):
    """A file holds thousands of events, so a larger table does not become mostly a listing of files."""
    path = queries._events_json(spark, "/root/testdata/sf0.01", pretty=True)
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").count()
    assert len(spark.read.text(path).inputFiles()) <= events / 1_000
    assert queries.q_scan_json_multiline(spark, "/root/testdata/sf0.01").count() == events
