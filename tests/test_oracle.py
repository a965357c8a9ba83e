"""Every registered query against its SQL."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, oracle, name):
    found = queries()[name](spark, DATA)
    answer = oracle.execute(oracle_sql()[name])
    names, expected = table([d[0] for d in answer.description], answer.fetchall())
    got_names, got = table(found.columns, found.collect())
    assert got_names == names
    assert len(got) == len(expected) > 0
    for g, e in zip(got, expected):
        assert g == e


def test_entry(spark):
    assert entry(spark).count() > 0
