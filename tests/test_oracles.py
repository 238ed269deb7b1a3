"""Every registered query against its SQL twin on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from registry.catalog import QUERIES
from registry.oracles import ORACLES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries())
    assert set(ORACLES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_twin(spark, con, name):
    result = registered.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = sorted(repr(tuple(row[c] for c in columns)) for row in result.collect())
    answer = con.execute(registered.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    expected = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in answer.fetchall())
    assert got == expected


def test_entry_runs(spark):
    assert registered.entry(spark).count() > 0
