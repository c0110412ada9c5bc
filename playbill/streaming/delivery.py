"""Delivery of rows in chunks by a data source whose tasks report to one commit, with a ledger of what was sent."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from playbill.operators.dedup import chunk_numbers

STATUS = "chunk long, n_rows long, status string, attempts int"
#: How a delivery waits between attempts, and between chunks of a task, in seconds.
WAITS, PAUSE = (5.0, 10.0), 1.5


class Ledger:
    """Chunks that the receiver has taken: a small file each, in a folder that driver and executors share."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        self.fs, self.base = fs.FileSystem.from_uri(path)
        self.fs.create_dir(self.base, recursive=True)

    def _file(self, chunk: int) -> str:
        return f"{self.base}/chunk-{chunk}.json"

    def entry(self, chunk: int) -> dict | None:
        from pyarrow import fs

        if self.fs.get_file_info(self._file(chunk)).type != fs.FileType.File:
            return None
        with self.fs.open_input_stream(self._file(chunk)) as f:
            return json.loads(f.readall())

    def put(self, entry: dict) -> None:
        """In one step: a reader sees the whole entry or none."""
        draft = f"{self.base}/.{entry['chunk']}-{time.time_ns()}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps(entry).encode())
        self.fs.move(draft, self._file(entry["chunk"]))


@dataclass
class Sent(WriterCommitMessage):
    chunks: list[dict]


def _source(send: Callable[[int, list[dict]], bool], ledger: str, attempts: int, waits: tuple[float, ...], pause: float) -> type[DataSource]:
    """A data source that hands chunks to send(); made here, so that it takes the function along to executors."""

    class Writer(DataSourceWriter):
        def write(self, iterator: Iterator) -> Sent:
            book, sent = Ledger(ledger), []
            for chunk, rows in groupby(iterator, key=lambda r: r["chunk"]):
                known = book.entry(chunk)
                if known and known["status"] == "success":  # an earlier try of this task, or an earlier run, has sent it
                    sent.append(known)
                    continue
                held, ok, n = [{k: v for k, v in r.asDict(recursive=True).items() if k != "chunk"} for r in rows], False, 0
                for n in range(1, attempts + 1):
                    ok = bool(send(int(chunk), held))
                    if ok or n == attempts:
                        break
                    time.sleep(waits[min(n - 1, len(waits) - 1)])
                entry = {"chunk": int(chunk), "n_rows": len(held), "status": "success" if ok else "failed", "attempts": n}
                book.put(entry)
                sent.append(entry)
                time.sleep(pause)
            return Sent(sent)

        def _close(self, messages: list, state: str) -> None:
            chunks = [c for m in messages if m for c in m.chunks]
            done = [c for c in chunks if c["status"] == "success"]
            said = {"state": state, "chunks": len(chunks), "found": sum(c["n_rows"] for c in chunks), "synced": sum(c["n_rows"] for c in done)}
            said["status"] = "aborted" if state == "aborted" else "skipped" if not chunks else "success" if len(done) == len(chunks) else "partial_failure"
            book = Ledger(ledger)
            with book.fs.open_output_stream(f"{book.base}/run.json") as f:
                f.write(json.dumps(said).encode())

        def commit(self, messages: list) -> None:
            self._close(messages, "committed")

        def abort(self, messages: list) -> None:
            self._close(messages, "aborted")

    class Delivery(DataSource):
        @classmethod
        def name(cls) -> str:
            return "chunk_delivery"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return Writer()

    return Delivery


def deliver_once(rows: DataFrame, send: Callable[[int, list[dict]], bool], ledger: str, order: list[str], size: int = 50, attempts: int = 3, waits: tuple[float, ...] = WAITS, pause: float = PAUSE) -> DataFrame:
    """Send rows in chunks of `size` in the given order; returns STATUS, a row a chunk.

    send(chunk, rows) runs on executors and says whether the receiver took the rows; it is asked again after the
    waits, and a chunk that fails doesn't stop the others. The ledger (a folder of this run in the shared
    file system) says which chunks have been taken: a task that runs again, or a whole run that is
    started again over the same rows, doesn't send these anew. Only where a task dies between the receiver's
    answer and the ledger's entry does a chunk go out twice, with the same number and rows. The
    driver gets one message a task and writes run.json: committed or aborted, with the counts.
    """
    spark = rows.sparkSession
    spark.dataSource.register(_source(send, ledger, attempts, waits, pause))
    laid = chunk_numbers(rows, size, *order).repartition("chunk").sortWithinPartitions("chunk", *order)
    laid.write.format("chunk_delivery").mode("append").save()
    return spark.read.schema(STATUS).option("pathGlobFilter", "chunk-*.json").json(ledger)


def run_summary(spark, ledger: str) -> DataFrame:
    """state, chunks, found, synced and status of the ledger's last run."""
    return spark.read.schema("state string, chunks long, found long, synced long, status string").json(f"{ledger}/run.json")
