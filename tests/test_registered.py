"""Every registered query against its oracle on the given tables, exactly."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from registered.oracles import ORACLES
from registered.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS FROM '{SF}/{file}'")
    return con


def bag(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([(type(row[i]).__name__, row[i]) for i in order]) for row in rows)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLES.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, oracle, name):
    found = entry_module.queries()[name](spark, SF)
    expected = oracle.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert bag([tuple(r) for r in found.collect()], found.columns) == bag(expected.fetchall(), columns)


def test_dirty_report_has_something_to_count_in_every_check(spark):
    report = entry_module.queries()["quality_report_dirty"](spark, SF).collect()
    assert len(report) == 23
    assert [r["check"] for r in report if r["violations"] == 0] == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
