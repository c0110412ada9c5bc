"""Queries whose rows cost much work on them in several tasks, though their tables are files of one row group."""

import pytest

import __spark_entry__ as entry

NAMES = ["post_dates", "rss_events", "mixed_json", "field_price_structs", "page_fields"]


@pytest.mark.parametrize("name", NAMES)
def test_rows_are_dealt_over_tasks(spark, sf, name):
    assert entry.queries()[name](spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
