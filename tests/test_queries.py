"""Every registered query against its SQL in DuckDB at the smallest scale."""

from __future__ import annotations

import glob
import os
import threading

import duckdb
import pytest

import __spark_entry__ as entry
from tests.support import same_rows

SQL = entry.oracle_sql()
#: Seconds that a query without SQL may take at the smallest scale.
LIMIT = 300


def duck(folder):
    """A fresh database per query, so that a fault in one cannot spoil the others."""
    con = duckdb.connect(config={"threads": 1})
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, sf):
    expected = duck(sf).sql(SQL[name]).df()
    assert same_rows(entry.queries()[name](spark, sf).toPandas(), expected) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_others_run_to_the_end(name, spark, sf):
    """Queries that SQL cannot express: their results are tested elsewhere, here that each ends with rows."""
    rows = []
    work = threading.Thread(target=lambda: rows.append(entry.queries()[name](spark, sf).count()), daemon=True)
    work.start()
    work.join(LIMIT)
    if work.is_alive():
        spark.sparkContext.cancelAllJobs()
    assert rows and rows[0] > 0


def test_flagship_runs(spark):
    assert entry.entry(spark).count() == 6


def test_names_agree():
    assert set(SQL) <= set(entry.queries())
