"""Counts over merged events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: events before and after, the overlap between them, events with several providers."""
    a = before.agg(F.count("*").alias("total_before"))
    b = after.agg(F.count("*").alias("total_after"), F.count_if(F.size("providers") > 1).alias("multi_provider"))
    # two one-row frames side by side
    return a.withColumn("k", F.lit(1)).join(b.withColumn("k", F.lit(1)), "k").drop("k").withColumn("overlap", F.col("total_before") - F.col("total_after"))


def source_counts(events: DataFrame, column: str = "source") -> DataFrame:
    return events.groupBy(column).agg(F.count("*").alias("n"))


def combination_counts(events: DataFrame, column: str = "providers") -> DataFrame:
    """How many events have each combination of providers, joined by plus signs."""
    return events.groupBy(F.array_join(column, "+").alias("combination")).agg(F.count("*").alias("n"))
