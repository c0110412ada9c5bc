"""Leaders on streams equal those of the whole table, however the records are cut into batches."""

import datetime as dt
import random

import pytest

from playbill.streaming import leaders

START = dt.datetime(2026, 1, 1)


def records():
    rng = random.Random(5)
    at, out = START, []
    for i in range(300):
        at += dt.timedelta(hours=rng.choice([0, 1, 5, 30, 60]))
        out.append((i, f"k{rng.randrange(12)}", at))
    out.append((300, "k0", at + dt.timedelta(days=7, seconds=1)))
    out.append((301, "k0", at + dt.timedelta(days=14, seconds=1)))  # exactly the retention later: still led
    return out


def model(rows):
    held, out = {}, {}
    for ordinal, key, at in rows:
        leader, seen = held.get(key, (None, None))
        if leader is None or at - seen > dt.timedelta(days=7):
            leader = ordinal
        held[key] = (leader, at)
        out[ordinal] = leader
    return out


@pytest.mark.parametrize("cuts", [1, 3, 7])
def test_any_cut_equals_the_table(spark, tmp_path, cuts):
    rows = records()
    schema = "ordinal long, key string, ts timestamp"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    (tmp_path / "in").mkdir()
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        per = -(-len(rows) // cuts)
        for k in range(cuts):
            spark.createDataFrame(rows[k * per : (k + 1) * per], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            query = leaders.stream_leaders(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {r.ordinal: r.leader for r in spark.read.schema("ordinal long, leader long").parquet(f"{tmp_path}/out").collect()}
    assert got == model(rows)
    state = spark.read.format("statestore").option("path", f"{tmp_path}/cp").option("stateVarName", "held").load().count() if cuts == 7 else 0
    assert state < 12  # keys that have rested for a week have left


def test_of_a_table(spark):
    rows = records()
    df = spark.createDataFrame([*rows, (900, None, START), (901, None, START)], "ordinal long, key string, ts timestamp")
    got = {r.ordinal: r.leader for r in leaders.leaders_with_retention(df).collect()}
    assert got == model(rows) | {900: 900, 901: 901}
    assert leaders.leaders_with_retention(df.limit(0)).collect() == []
