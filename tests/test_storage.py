"""Keyed tables, patterns, sources side by side, and counts taken while writing."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from playbill.operators import patterns
from playbill.sources import runner, sinks
from playbill.streaming import keyed_table
from playbill.streaming.keyed_table import KeyedTable, upsert_keyed


def made(spark, ids, value, **more):
    return spark.createDataFrame([(i, value) for i in ids], "id long, v string")


def state(table, version=None):
    return {r.id: (r.v, r.is_active, r.run_id) for r in table.read(version).collect()}


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 32)
    with pytest.raises(ValueError):
        table.read()
    assert len(table.upsert(made(spark, range(2000), "a" * 50), "r1")) == 32
    first = size(tmp_path)
    touched = table.upsert(spark.createDataFrame([(3, "x"), (3, "y"), (5000, "new")], "id long, v string"), "r2")
    assert len(touched) <= 2 and size(tmp_path) - first < first / 8
    got = state(table)
    assert len(got) == 2001 and got[3] == ("y", True, "r2") and got[5000] == ("new", True, "r2") and got[4] == ("a" * 50, True, "r1")
    assert state(table, 1)[3] == ("a" * 50, True, "r1")
    assert table.sweep(made(spark, [i for i in range(5001) if i != 7], "")) == [spark.sql("select pmod(xxhash64(7L), 32)").first()[0]]
    got = state(table)
    assert got[7][1] is False and sum(not x[1] for x in got.values()) == 1
    assert table.sweep(made(spark, range(5001), "")) == [] and table.version() == 3
    with pytest.raises(ValueError):
        table.upsert(made(spark, [1], "z").withColumn("w", F.lit(1)), "r3")
    table.vacuum(1)
    assert state(table) == got and size(tmp_path) < 1.5 * first


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_run_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step):
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 4)
    table.upsert(made(spark, range(10), "a"), "r1")
    before = state(table)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(keyed_table.uuid if step == "write" else KeyedTable, "uuid4" if step == "write" else "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(made(spark, range(5), "b"), "r2")
    assert state(table) == before and table.version() == 1
    table.upsert(made(spark, range(5), "b"), "r2")
    assert {v for v, _, _ in state(table).values()} == {"a", "b"}
    table.vacuum(1)
    assert sum(v == "b" for v, _, _ in state(table).values()) == 5


def test_two_writers(spark, tmp_path):
    one = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 4)
    one.upsert(made(spark, range(4), "a"), "r1")
    with pytest.raises(RuntimeError):
        one._commit(1, one.manifest())


def test_readers_while_a_stream_writes(spark, tmp_path):
    """Every batch goes in once, also if it comes again; a reader in a loop sees whole versions only."""
    table = KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 8)
    table.upsert(made(spark, range(100), "0"), "r0")
    for k in range(1, 4):
        made(spark, range(100), str(k)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stop, seen, errors = threading.Event(), [], []

    def look():
        while not stop.is_set():
            try:
                seen.append({v for v, _, _ in state(table).values()})
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=look)
    reader.start()
    stream = spark.readStream.schema("id long, v string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    upsert_keyed(stream, table, f"{tmp_path}/cp", "run")
    stop.set()
    reader.join()
    assert not errors and seen and all(len(v) == 1 for v in seen)
    version = table.version()
    assert version == 4 and table.manifest()["batches"] == {"stream": 2}
    assert table.upsert(made(spark, range(100), "again"), "r", stream=("stream", 1)) == [] and table.version() == version


def test_patterns(spark):
    rng = random.Random(1)
    words = ["ab", "abc", "bc", "ca", "ğü", "a b", "x", "zz", "abcabc", None, "", "ab"] + [f"w{i}" for i in range(300)]
    texts = [(i, " ".join(rng.choice([w or "" for w in words]) for _ in range(rng.randint(0, 12))), "c") for i in range(200)] + [(None, None, "c"), (7, "abc", "c")]
    docs = spark.createDataFrame(texts, "id long, text string, pattern string")
    made = spark.createDataFrame([(w,) for w in words], "pattern string")
    want = sorted(((i, w) for i, t, _ in texts for w in {w for w in words if w} if t and w in t), key=repr)
    for chars in (10**6, 200):
        got = patterns.find_patterns(docs, "text", ["id"], made, pass_chars=chars)
        assert got.columns == ["id", "pattern"] and sorted(((r.id, r.pattern) for r in got.collect()), key=repr) == want
    assert patterns.find_patterns(docs, "text", ["id"], made.limit(0)).collect() == []
    few = patterns.find_patterns(docs, "text", ["id"], made.where("pattern in ('ab', 'zz')"))
    assert sorted(((r.id, r.pattern) for r in few.collect()), key=repr) == [x for x in want if x[1] in ("ab", "zz")]


def test_sources_side_by_side(spark, tmp_path):
    def broken():
        raise OSError("no answer")

    sources = {"a": lambda: spark.range(3), "b": broken, "c": lambda: spark.range(5).select(F.raise_error(F.lit("bad row")).alias("id")), "d": lambda: spark.range(0), "e": lambda: spark.range(7)}
    pools = {}

    def write(name, rows):
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        rows.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}").count()

    got = runner.run_sources(spark, sources, write, 3)
    assert [(r.source, r.synced, r.status) for r in got.collect()] == [("a", 3, "success"), ("b", 0, "failed"), ("c", 0, "failed"), ("d", 0, "skipped"), ("e", 7, "success")]
    assert pools == {k: k for k in "acde"} and runner.overall(got) == "partial_failure"
    assert runner.overall(got.where("status <> 'failed'")) == "success" and runner.overall(got.where("status = 'failed'")) == "failed"


def test_counts_are_taken_while_writing(spark, tmp_path):
    """Each frame is evaluated once, and the numbers are those of the frames."""
    evaluated = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            evaluated.add(b.num_rows)
            yield b

    rows = [(k, ["a", "b"] if k % 3 == 0 else ["a"], f"s{k % 2}") for k in range(30)]
    after = spark.createDataFrame(rows, "id long, providers array<string>, source string").mapInArrow(count, "id long, providers array<string>, source string")
    before = after.union(after)
    totals = sinks.write_merged(before, after, f"file://{tmp_path}/m")
    assert totals == {"total_before": 60, "total_after": 30, "multi_provider": 10, "overlap": 30} and evaluated.value == 90
    assert spark.read.json(f"{tmp_path}/m/stats").first().asDict() == totals
    assert {(r.combination, r.n) for r in spark.read.json(f"{tmp_path}/m/combinations").collect()} == {("a", 20), ("a+b", 10)}
    assert sinks.write_provider(after, f"file://{tmp_path}/p", "2026-01-01") == 30 and evaluated.value == 120
    assert {(r.source, r.total_events) for r in spark.read.json(f"{tmp_path}/p/stats").collect()} == {("s0", 15), ("s1", 15)}
