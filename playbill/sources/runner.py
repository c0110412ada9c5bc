"""Sources side by side: each in a pool of its own, a failure of one is its own."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

STATUS = "source string, found long, synced long, failed long, status string, error string"


def run_sources(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], write: Callable[[str, DataFrame], int], at_once: int = 5) -> DataFrame:
    """Read and write every source, some at once; returns STATUS, a row a source in the given order.

    write(name, rows) says how many rows it has taken. Each source's jobs run in a scheduler pool of its name
    (spark.scheduler.mode FAIR shares the cluster's cores among them). A source that raises counts as failed
    with the name of its error; the others go on. What a source reads is found once, by write; a
    writer that takes fewer rows than it is given should raise.
    """

    def one(name: str) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            n = int(write(name, sources[name]()))
            return name, n, n, 0, "success" if n else "skipped", None
        except Exception as e:  # noqa: BLE001  any failure of a source stays its own
            logging.error("source %s failed with %s", name, type(e).__name__)
            return name, 0, 0, 1, "failed", type(e).__name__
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        tasks = [pool.submit(inheritable_thread_target(spark)(one), name) for name in sources]
        return spark.createDataFrame([t.result() for t in tasks], STATUS)


def overall(statuses: DataFrame) -> str:
    """success, partial_failure, failed or skipped, of all sources together."""
    said = {r.status for r in statuses.select("status").distinct().collect()}
    if "failed" not in said:
        return "success" if "success" in said else "skipped"
    return "partial_failure" if said - {"failed"} else "failed"
