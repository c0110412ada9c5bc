"""Queries whose SQL knows entities with their semicolon only, on pages that cut one off."""

import duckdb
import pytest

import __spark_entry__ as entry

TEXTS = ["<title>A &amp;&amp</title>p{x} &lt &copy &lt;b&gt; &amp;lt", "<h1>B&ampC; &amp</h1><p>&eacute;&eacute</p>&am<br>p;", "&amp", None]


@pytest.mark.parametrize("name", ["text_clean", "block_lines", "html_strip", "html_title", "page_body"])
def test_open_names_stay(spark, tmp_path, name):
    for table, key, column in (("pages", "page_id", "html"), ("documents", "doc_id", "text")):
        rows = [(i, t) for i, t in enumerate(TEXTS)]
        spark.createDataFrame(rows, f"{key} long, {column} string").write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    for table in ("pages", "documents"):
        con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    want = sorted(con.sql(entry.oracle_sql()[name]).fetchall())
    assert sorted(tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).collect()) == want
