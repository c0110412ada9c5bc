"""Helpers on arrays take time in the arrays' length, and dto_explode ships only what its lines hold."""

import re
import time

from pyspark.sql import functions as F

from playbill.functions.columns import ordered_distinct, stretches
from playbill.operators.provenance import distinct_links
from playbill.plans.queries import QUERIES


def test_ordered_distinct(spark):
    rows = spark.sql("select array('b','a',null,'B','c','a','',' x') as a union all select array() union all select null")
    got = [r.o for r in rows.select(ordered_distinct(F.col("a"), lambda x: F.nullif(F.lower(x), F.lit(""))).alias("o")).collect()]
    assert got == [["b", "a", "c", " x"], [], None]


def test_links_of_a_long_array(spark):
    """Every link was compared with all before, whose keys were worked out anew for each."""
    links = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(5999)), lambda i: F.concat(F.lit("https://s.example/"), (i % 3000).cast("string"))).alias("l"))
    began = time.time()
    got = links.select(distinct_links("l").alias("l")).first().l
    assert got == [f"https://s.example/{i}" for i in range(3000)]
    assert time.time() - began < 30


def test_stretches(spark):
    rows = spark.sql("select array(1, 1, null, null, 2, 1) as a union all select array(7) union all select array() union all select null")
    got = [r.o and [(x.key, x["items"]) for x in r.o] for r in rows.select(stretches(F.col("a"), lambda x: x).alias("o")).collect()]
    assert got == [[(1, [1, 1]), (None, [None, None]), (2, [2]), (1, [1])], [(7, [7])], [], None]


def test_lines_are_shuffled_once(spark, sf):
    plan = QUERIES["dto_explode"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "resolution" not in below and "is_official_seller" not in below
