"""Leaders on streams: keyed state that goes once a key hasn't been seen for the retention's days."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

OUT = "ordinal long, leader long"


def leaders_with_retention(rows: DataFrame, key: str = "key", ordinal: str = "ordinal", ts: str = "ts", days: int = 7) -> DataFrame:
    """ordinal and leader of a whole table: the first record of a key leads the later ones until the key rests for over `days`.

    Records are taken by time, then ordinal; rows without a key lead themselves.
    """
    by_key = Window.partitionBy(key).orderBy(ts, ordinal)
    rest = F.col(ts) - F.lag(ts).over(by_key) > F.expr(f"interval {days} days")
    runs = rows.where(F.col(key).isNotNull()).withColumn("_run", F.sum(F.when(F.coalesce(rest, F.lit(False)), 1).otherwise(0)).over(by_key))
    led = runs.select(F.col(ordinal).alias("ordinal"), F.first(ordinal).over(Window.partitionBy(key, "_run").orderBy(ts, ordinal)).alias("leader"))
    return led.union(rows.where(F.col(key).isNull()).select(F.col(ordinal).alias("ordinal"), F.col(ordinal).alias("leader")))


class _Leaders(StatefulProcessor):
    """A key's leader and when it was last seen; a timer clears both once the retention has passed."""

    def __init__(self, days: int) -> None:
        self.rest = days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "leader long, seen long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["at", "ordinal"], kind="stable")
        leader, seen = self.held.get() if self.held.exists() else (None, None)
        out = []
        for at, ordinal in zip(batch["at"].tolist(), batch["ordinal"].tolist(), strict=True):
            if leader is None or at - seen > self.rest:
                leader = ordinal
            seen = at if seen is None else max(seen, at)
            out.append((ordinal, leader))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.held.update((leader, seen))
        self.handle.registerTimer(seen + self.rest + 1)
        yield pd.DataFrame(out, columns=["ordinal", "leader"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        yield pd.DataFrame({"ordinal": pd.Series([], dtype="int64"), "leader": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


def stream_leaders(stream: DataFrame, key: str = "key", ordinal: str = "ordinal", ts: str = "ts", days: int = 7, late: str = "1 hour") -> DataFrame:
    """leaders_with_retention() of a stream, in any cut into micro-batches, as long as a key's records come in order of time.

    A record that comes out of order, by less than `late`, joins the leader that its key has; later
    ones are lost, as behind any watermark. State is a leader and a time a key, in RocksDB
    (spark.sql.streaming.stateStore.providerClass); it goes once the watermark is over the retention past
    the key's last record, and what comes then leads anew, as in the whole table. Records without a
    key are left out: they lead themselves. The rows of one key and batch are gathered in its task.
    """
    at = F.unix_millis(ts)
    keyed = stream.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(ordinal).cast("long").alias("ordinal"), at.alias("at"), F.col(ts).alias("ts")).withWatermark("ts", late)
    schema = StructType([StructField(f.name, f.dataType) for f in stream.sparkSession.createDataFrame([], OUT).schema.fields])
    return keyed.groupBy("key").transformWithStateInPandas(statefulProcessor=_Leaders(days), outputStructType=schema, outputMode="Append", timeMode="EventTime")
