"""Sources that are read in parts: paged answers with pushed filters, and JSON arrays over several tasks."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan

from playbill.sources import json_split, paged


def put(root, country, segment, page, items, total=None):
    at = root / f"country={country}" / f"segment={segment}" / f"page={page}"
    at.mkdir(parents=True)
    text = items if isinstance(items, str) else json.dumps({"_embedded": {"events": items}, "page": {"totalPages": total}})
    (at / "part-0.json").write_text(text)


def item(key, day, **more):
    return {"id": key, "dates": {"start": {"localDate": day}}} | more


@pytest.fixture
def answers(tmp_path):
    put(tmp_path, "TR", "Music", 0, [item("a", "2026-01-01"), item("b", "2026-01-05"), "no object", {"name": "no id"}], 3)
    put(tmp_path, "TR", "Music", 1, [item("a", "2026-02-01"), {"eventId": "c", "id": "x", "date": "2026-02-02"}], 3)
    put(tmp_path, "TR", "Music", 2, [item("d", "2026-03-01")], 3)
    put(tmp_path, "TR", "Music", 3, [item("beyond totalPages", "2026-04-01")], 3)
    put(tmp_path, "TR", "Sports", 0, [item("b", "2026-01-02", n=2), item("e", "2026-01-09")])
    put(tmp_path, "TR", "Sports", 1, [])
    put(tmp_path, "TR", "Sports", 2, [item("after an empty page", "2026-05-01")])
    put(tmp_path, "TR", "Sports", 4, [item("after a missing page", "2026-05-01")])
    put(tmp_path, "DE", "Music", 0, [item("a", "2026-01-01")], 1)
    put(tmp_path, "DE", "Film", 0, "no JSON")
    return f"file://{tmp_path}"


def test_first_ids_up_to_the_last_page(spark, answers):
    got = {(r.country, r.id): (r.segment, r.page, r.place) for r in paged.discovery_items(spark, answers).collect()}
    assert got == {
        ("TR", "a"): ("Music", 0, 0), ("TR", "b"): ("Music", 0, 1), ("TR", "c"): ("Music", 1, 1), ("TR", "d"): ("Music", 2, 0), ("TR", "e"): ("Sports", 0, 1), ("DE", "a"): ("Music", 0, 0),
    }
    turned = {r.id: r.segment for r in paged.discovery_items(spark, answers, F.col("country") == "TR", ["Sports", "Music"]).collect()}
    assert turned == {"a": "Music", "b": "Sports", "c": "Music", "d": "Music", "e": "Sports"}
    assert {r.id for r in paged.discovery_items(spark, answers, F.col("country") == "TR", max_pages=1).collect()} == {"a", "b", "e"}
    assert paged.discovery_items(spark, answers + "/none").collect() == []


def test_filters_reach_the_reader(spark, answers, capsys):
    paged.register(spark)
    rows = spark.read.format("paged_answers").option("path", answers).load()
    found = rows.where("country = 'TR' and segment in ('Music', 'Film') and event_date >= '2026-01-05' and event_date < '2026-02-02' and place >= 0")
    assert sorted((r.page, r.id) for r in found.collect()) == [(0, "b"), (1, "a")]
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(country,TR)" in plan.replace(" ", "") or "country" in plan.split("Filter")[-1]
    condition = next(x for x in plan.splitlines() if x.startswith("Condition"))
    assert "event_date" not in condition.replace("isnotnull(event_date", "") and "TR" not in condition and "Music" not in condition


def test_pages_that_are_not_read(tmp_path):
    """Of 64 pages by date only those of the range are planned, and few are looked at to find them."""
    for n in range(64):
        put(tmp_path, "TR", "Music", n, [item(f"{n}-{k}", f"2026-{n // 28 + 1:02d}-{n % 28 + 1:02d}") for k in range(3)], 64)
        put(tmp_path, "TR", "Sports", n, "unreadable if anyone looks")
    reader = paged.PageReader({"path": f"file://{tmp_path}"})
    looked = []
    answer = reader._answer
    reader._answer = lambda folder: looked.append(folder) or answer(folder)
    left = list(reader.pushFilters([EqualTo(("country",), "TR"), In(("segment",), ("Music",)), GreaterThanOrEqual(("event_date",), "2026-02-03"), LessThan(("event_date",), "2026-02-06"), IsNotNull(("id",))]))
    pages = reader.partitions()
    assert left == [IsNotNull(("id",))]
    assert [p.page for p in pages] == [30, 31, 32, 33] and len(looked) <= 14 and not any("Sports" in x for x in looked)
    assert sorted(r[5] for p in pages for r in reader.read(p)) == sorted(f"{n}-{k}" for n in (30, 31, 32) for k in range(3))


HARD = ['}{][",', '\\"}', "a\\\\", "\\\\\\", 'x"y', "ü]}€", "", "\n\t", "{}[],", '"']


def records(rng, n):
    deep = lambda d: {"k": rng.choice(HARD), "l": [rng.choice([1, None, True, rng.choice(HARD), [], {}, [{"z": "]"}]]) for _ in range(rng.randint(0, 3))]} | ({"d": deep(d - 1)} if d else {})
    return [deep(rng.randint(0, 4)) for _ in range(n)]


def test_split_arrays(spark, tmp_path):
    rng = random.Random(4)
    made = {f"{k}.json": records(rng, n) for k, n in enumerate([0, 1, 2, 300, 1500])}
    made["4.json"][700] = {"long": HARD * 3000}  # over several parts
    made["4.json"][3:3] = [5, "text, with } in it", [1, {"a": 2}]]
    for k, (name, rows) in enumerate(made.items()):
        (tmp_path / name).write_text(json.dumps(rows, indent=k % 3 or None, ensure_ascii=k % 2 == 0))
    want = {(name, i): x for name, rows in made.items() for i, x in enumerate(rows) if isinstance(x, dict)}
    counts = []
    for size in ("128m", "20k", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        try:
            rows = json_split.json_elements(spark, str(tmp_path)).collect()
            counts.append(spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        got = {(os.path.basename(r.path), r.place): json.loads(r.item) for r in rows}
        assert len(rows) == len(want) and got == want
    assert counts[0] < 10 < counts[1] < counts[2]


def test_landed_arrays(spark, tmp_path):
    rows = spark.range(1000).repartition(3).select(F.to_json(F.struct("id", F.lit('}"]').alias("x"))).alias("j"))
    json_split.land_arrays(rows.union(rows.limit(0)), str(tmp_path / "a"))
    for f in (tmp_path / "a").glob("part-*"):
        json.loads(f.read_text())
    got = json_split.json_elements(spark, str(tmp_path / "a")).select(F.get_json_object("item", "$.id").cast("int").alias("i")).collect()
    assert sorted(r.i for r in got) == list(range(1000))


def test_many_pages_share_partitions(tmp_path, monkeypatch):
    monkeypatch.setattr(paged, "MOST_PARTITIONS", 4)
    for n in range(30):
        put(tmp_path, "TR", "Music", n, [item(f"{n}-{k}", "2026-01-01") for k in range(2)], 30)
    reader = paged.PageReader({"path": f"file://{tmp_path}"})
    parts = reader.partitions()
    assert len(parts) == 4
    assert [(r[3], r[5]) for p in parts for r in reader.read(p)] == [(n, f"{n}-{k}") for n in range(30) for k in range(2)]


def test_parts_are_streamed():
    """A part's fragments and elements go through a task a few at a time, however long the part is."""
    import pyarrow as pa

    taken = 0

    def batches(columns):
        nonlocal taken
        for k in range(40):
            n = 1000
            values = [("[" if not k and not i else ",") + json.dumps({"n": k * n + i, "t": "x" * 20})[:-1] for i in range(n)]
            taken += 1
            yield pa.RecordBatch.from_arrays([*(pa.array([c] * n) for c in columns), pa.array(values)], [f"c{i}" for i in range(len(columns) + 1)])

    made, first = [], 0
    for batch in json_split._cutter(True)(batches(("p", 0, False, 0, 0))):
        first = first or taken
        assert batch.num_rows <= 1000
        made += batch.column(3).to_pylist()
    assert first == 1 and [json.loads(x)["n"] for x in made] == list(range(39_999))  # no bracket ends the last
    summary = list(json_split._summaries(batches(("p", 0))))
    assert len(summary) == 1 and summary[0].column(3).to_pylist() == [[1, 0]]
    parts = json_split._parts(batches(("p", 0)), 2)
    taken = 0
    next(next(parts)[1])
    assert taken == 1
