"""Chunks are delivered once each, over failures of the receiver, of tasks and of the driver."""

import json
import os

import pytest

from playbill.streaming import delivery


def log(folder):
    return sorted((json.loads((folder / f).read_text()) for f in os.listdir(folder)), key=lambda x: (x["chunk"], x["n"]))


def sender(folder, fail=lambda chunk, n: None):
    folder = str(folder)

    def send(chunk, rows):
        n = sum(f.startswith(f"{chunk}-") for f in os.listdir(folder))
        with open(f"{folder}/{chunk}-{n}", "w") as f:
            json.dump({"chunk": chunk, "n": n, "ids": [r["id"] for r in rows]}, f)
        how = fail(chunk, n)
        if how == "die":
            raise OSError("lost")
        return how != "refuse"

    return send


def test_every_chunk_once(spark, tmp_path):
    (tmp_path / "log").mkdir()
    rows = spark.range(230).withColumnRenamed("id", "id").repartition(5)
    send = sender(tmp_path / "log", lambda chunk, n: "refuse" if chunk == 3 or (chunk == 1 and n == 0) else None)
    status = delivery.deliver_once(rows, send, f"file://{tmp_path}/ledger", ["id"], 50, 2, (0.0,), 0.0)
    assert sorted(map(tuple, status.collect())) == [(0, 50, "success", 1), (1, 50, "success", 2), (2, 50, "success", 1), (3, 50, "failed", 2), (4, 30, "success", 1)]
    assert [x["ids"] for x in log(tmp_path / "log") if x["chunk"] == 4] == [list(range(200, 230))]
    assert tuple(delivery.run_summary(spark, f"file://{tmp_path}/ledger").first()) == ("committed", 5, 230, 180, "partial_failure")
    # the same rows again: only what failed goes out
    again = delivery.deliver_once(rows, sender(tmp_path / "log"), f"file://{tmp_path}/ledger", ["id"], 50, 2, (0.0,), 0.0)
    assert {r.status for r in again.collect()} == {"success"} and again.count() == 5
    sent = [x["chunk"] for x in log(tmp_path / "log")]
    assert sent.count(3) == 3 and sent.count(0) == 1 and sent.count(2) == 1
    assert delivery.run_summary(spark, f"file://{tmp_path}/ledger").first().status == "success"


def test_a_lost_task_does_not_send_again(spark, tmp_path):
    (tmp_path / "log").mkdir()
    rows = spark.range(100).coalesce(1)
    ledger = f"file://{tmp_path}/ledger"
    with pytest.raises(Exception, match="lost"):
        delivery.deliver_once(rows, sender(tmp_path / "log", lambda chunk, n: "die" if chunk == 6 and n == 0 else None), ledger, ["id"], 10, 1, (0.0,), 0.0)
    assert delivery.run_summary(spark, ledger).first().state == "aborted"
    taken = {x["chunk"] for x in log(tmp_path / "log")} - {6}
    status = delivery.deliver_once(rows, sender(tmp_path / "log"), ledger, ["id"], 10, 1, (0.0,), 0.0)
    assert status.count() == 10 and {r.status for r in status.collect()} == {"success"}
    sent = [x["chunk"] for x in log(tmp_path / "log")]
    assert all(sent.count(c) == 1 for c in range(10) if c != 6) and sent.count(6) == 2 and taken
    none = delivery.deliver_once(rows.limit(0), sender(tmp_path / "log"), f"file://{tmp_path}/empty", ["id"], 10)
    assert none.count() == 0 and delivery.run_summary(spark, f"file://{tmp_path}/empty").first().status == "skipped"
