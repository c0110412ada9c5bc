"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline")


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v

    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def check(spark, sf, name):
    got = entry.queries()[name](spark, sf)
    con = duckdb.connect()
    for file in os.listdir(sf):
        con.sql(f"create view {file.split('.')[0]} as select * from '{sf}/{file}'")
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, name):
    check(spark, sf, name)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
