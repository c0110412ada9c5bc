"""Sinks: provider tables with their counts, the merged table, the trend report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from playbill.operators.stats import combination_counts, source_counts


def write_provider(events: DataFrame, path: str, fetched_at: str, form: str = "json") -> int:
    """events by provider under path/events, and their counts under path/stats; returns how many there are.

    The events are evaluated once: their number is observed while they are written, the counts are
    taken from what was written.
    """
    seen = Observation()
    named = events.withColumn("provider_name", F.coalesce("source", F.lit("unknown")))
    named.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy("provider_name").format(form).save(f"{path}/events")
    written = events.sparkSession.read.schema("source string, provider_name string").format(form).load(f"{path}/events")
    written.groupBy("source").agg(F.count("*").alias("total_events")).withColumn("last_fetch", F.lit(fetched_at)).write.mode("overwrite").json(f"{path}/stats")
    return int(seen.get["n"])


def write_merged(before: DataFrame, after: DataFrame, path: str) -> dict[str, int]:
    """Merged events with totals, source counts and provider combinations beside them; returns the totals.

    before and after are evaluated once each: totals are observed while the events and the source counts are
    written, the combinations are counted from the written events' one column.
    """
    counted, merged = Observation(), Observation()
    spark = after.sparkSession
    after.observe(merged, F.count(F.lit(1)).alias("total_after"), F.count_if(F.size("providers") > 1).alias("multi_provider")).write.mode("overwrite").parquet(f"{path}/events")
    source_counts(before).observe(counted, F.coalesce(F.sum("n"), F.lit(0)).alias("total_before")).write.mode("overwrite").json(f"{path}/sources")
    totals = {k: int(v) for k, v in (counted.get | merged.get).items()}
    totals["overlap"] = totals["total_before"] - totals["total_after"]
    row = spark.range(1).select(*(F.lit(totals[k]).cast("long").alias(k) for k in ("total_before", "total_after", "multi_provider", "overlap")))
    row.write.mode("overwrite").json(f"{path}/stats")
    combination_counts(spark.read.schema(after.schema).parquet(f"{path}/events")).write.mode("overwrite").json(f"{path}/combinations")
    return totals


def write_report(report: DataFrame, path: str) -> None:
    """The report's cells as JSON and as Markdown text."""
    from playbill.plans.trends import markdown

    report.write.mode("overwrite").json(f"{path}/cells")
    markdown(report).write.mode("overwrite").text(f"{path}/markdown")
