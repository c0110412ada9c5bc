"""Runs over time: upserts and sweeps of stored rows, chunked delivery, and the same on streams."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.operators.dedup import chunk_numbers


def sweep(stored: DataFrame, seen: DataFrame, keys: list[str], provider: str | None = None, provider_col: str = "provider") -> DataFrame:
    """stored with is_active: false for rows whose key this run hasn't seen.

    With a provider only its rows can become inactive. A run that failed to upload is not swept by
    its caller.
    """
    now = seen.select(*keys).distinct().withColumn("_seen", F.lit(True))
    marked = stored.drop("is_active").join(now, keys, "left")
    kept = F.col("_seen").isNotNull()
    if provider is not None:
        kept = kept | (F.col(provider_col) != provider)
    return marked.withColumn("is_active", kept).drop("_seen")


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], run_id: str) -> DataFrame:
    """incoming rows, active and with this run's id, over the stored ones of the same key."""
    fresh = incoming.withColumn("is_active", F.lit(True)).withColumn("run_id", F.lit(run_id))
    return stored.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def retire(stored: DataFrame, as_of: str, last_seen: str, days: int = 7) -> DataFrame:
    """Rows not seen for so many days become inactive."""
    return stored.withColumn("is_active", F.col("is_active") & (F.to_date(last_seen) >= F.date_sub(F.lit(as_of).cast("date"), days)))


def deliver(rows: DataFrame, send: Callable[[int, list[dict]], bool], order: list[str], size: int = 50, attempts: int = 3, waits: tuple[float, ...] = (5.0, 10.0), pause: float = 1.5) -> DataFrame:
    """Send rows in chunks of `size`; returns chunk, n_rows, status, attempts.

    send(chunk, rows) runs on executors and says whether the receiver took them; it is asked again
    after the waits. A failed chunk doesn't stop the others. Chunks are idempotent by number, as a
    lost task sends its chunks again.
    """
    import pandas as pd

    def one(key, pdf):
        ok, n = False, 0
        for n in range(1, attempts + 1):
            ok = bool(send(int(key[0]), pdf.sort_values(order).drop(columns=["chunk"]).to_dict("records")))
            if ok or n == attempts:
                break
            time.sleep(waits[min(n - 1, len(waits) - 1)])
        time.sleep(pause)
        return pd.DataFrame([(int(key[0]), len(pdf), "success" if ok else "failed", n)])

    return chunk_numbers(rows, size, *order).groupBy("chunk").applyInPandas(one, "chunk long, n_rows long, status string, attempts int")


def run_status(delivered: DataFrame) -> DataFrame:
    """One row: success, partial_failure or skipped, with counts."""
    return delivered.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("found"), F.coalesce(F.sum(F.when(F.col("status") == "success", F.col("n_rows"))), F.lit(0)).alias("synced"), F.when(F.count("*") == 0, "skipped").when(F.bool_and(F.col("status") == "success"), "success").otherwise("partial_failure").alias("status"))


def hourly(events: DataFrame) -> DataFrame:
    """Counts and summed values (in cents) of each hour and type; on a stream after withWatermark."""
    w = F.window(F.col("ts"), "1 hour")
    cents = (F.col("value") * 100).cast("decimal(20,6)")
    return events.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.round(cents, 0).cast("long")).alias("cents")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n", "cents")


def dedup_stream(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 day") -> DataFrame:
    """The first of equal keys on a stream; state is dropped once the watermark has passed."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """One scheduled run: take what is there, write it, stop."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def put_in_place(table: DataFrame, path: str) -> None:
    """Replace the Parquet table at path: written beside it, then moved; the old one goes last.

    A run that dies leaves the old table, or both, and recover() puts things right.
    """
    spark = table.sparkSession
    make = spark._jvm.org.apache.hadoop.fs.Path
    table.write.mode("overwrite").parquet(f"{path}.next")
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(make(f"{path}.old"), True)
    if fs.exists(make(path)):
        fs.rename(make(path), make(f"{path}.old"))
    fs.rename(make(f"{path}.next"), make(path))
    fs.delete(make(f"{path}.old"), True)


def recover(spark, path: str) -> bool:
    """Whether there is a table at path, after finishing a replacement that was broken off."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(make(path)):
        whole = fs.exists(make(f"{path}.next/_SUCCESS"))
        if not whole and not fs.exists(make(f"{path}.old")):
            return False
        fs.rename(make(f"{path}.next" if whole else f"{path}.old"), make(path))
    return True


def upsert_stream(stream: DataFrame, table_path: str, checkpoint: str, keys: list[str], run_id: str, order: list[str] | None = None) -> None:
    """Micro-batches upserted into a Parquet table, which put_in_place() replaces.

    Of a batch's rows of one key the last in `order` counts (default: by all other columns, so
    that a batch that runs again gives the same rows).
    """
    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        rows = _last_by(df, keys, order or [c for c in df.columns if c not in keys])
        stored = spark.read.parquet(table_path) if recover(spark, table_path) else upsert(rows.limit(0), rows.limit(0), keys, "")
        put_in_place(upsert(stored, rows, keys, f"{run_id}-{number}"), table_path)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*").select(*df.columns)
