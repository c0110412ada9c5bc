"""De-duplication and ranking by an explicit order; the survivor is always defined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions.columns import col
from playbill.functions.text import normalize_for_match


def first_by(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in the given order; equal rows of the order leave any one.

    Runs as min_by over structs, so rows are combined before the shuffle and a hot key costs one
    row a task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*(col(o) for o in order))).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def show_key(title: Column | str, date: Column | str, time: Column | str) -> Column:
    """The key by which a provider's listings repeat: title, date and time."""
    return F.concat_ws("|", normalize_for_match(title), F.coalesce(col(date), F.lit("")), F.coalesce(col(time), F.lit("")))


def dedup_shows(events: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The first of a provider's events with equal title and first occurrence's date and time."""
    first = F.get(F.col("occurrences"), 0)
    keyed = events.withColumn("_key", show_key("title", first["local_date"], first["local_time"]))
    return first_by(keyed, ["_key"], ordinal).drop("_key")


def top_k(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each key; Spark cuts each partition's rows to k before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def arg_max(df: DataFrame, keys: list[str], value: str, *order: str) -> DataFrame:
    """value of the row with the greatest order in each key."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def fallback_union(first: DataFrame, *others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the first frame that has any for a key; null is a key like any other."""
    parts = [df.withColumn("_priority", F.lit(i)) for i, df in enumerate((first, *others))]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    best = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min("_priority").alias("_best"))
    same = F.col("_priority") == F.col("_best")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(best, same).drop("_priority", "_best", *(f"_{k}" for k in keys))


def union_sources(*frames: DataFrame, place: str = "place") -> DataFrame:
    """UNION ALL with the frames' order as source_rank; ordinal order is (source_rank, place)."""
    parts = [df.withColumn("source_rank", F.lit(i)) for i, df in enumerate(frames)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def chunk_numbers(df: DataFrame, size: int, *order: str) -> DataFrame:
    """chunk: which group of `size` rows in the order a row is in."""
    from playbill.schema import number_rows

    numbered = number_rows(df, *order, name="_place")
    return numbered.withColumn("chunk", F.floor(F.col("_place") / size)).drop("_place")
