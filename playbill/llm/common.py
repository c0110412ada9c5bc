"""Shared helpers: runs of equal keys, groups of bounded size, forests."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hash_sample(df: DataFrame, n: int, salt: str, *keys: str) -> DataFrame:
    """At most n rows, those with the smallest hashes of the keys; about n if there are as many.

    Rows are counted and all but about 2 n cut by their hash before any is sorted, so that what
    meets in one task is bounded whatever the number of partitions.
    """
    total = df.count()
    h = F.xxhash64(F.lit(salt), *keys)
    if total > 2 * n:
        df = df.where(h < -(2**63) + (2**64) * 2 * n // total)
    return df.orderBy(h, *keys).limit(n)


#: Most bytes of a batch of rows that goes to Python. Spark's own 64 MB are held several times over by each task, in the JVM's buffers and in Python.
BATCH_BYTES = 1 << 22


def small_batches(spark: SparkSession) -> None:
    """Let batches for Python end at BATCH_BYTES in this session, unless they end earlier; a larger row is a batch of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if held > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Indices at which a new run of equal keys begins."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 32_768) -> Iterator[pa.Table]:
    """Tables of about `rows` rows, none of which ends inside a run of equal keys.

    The input is sorted by the (integer) keys. A run is held whole in memory; callers bound
    runs with bounded_groups() first.
    """
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        cut = run_starts(*(table[k].to_numpy() for k in keys))[-1]
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        held, n = table.combine_chunks().to_batches(), table.num_rows
    if n:
        yield pa.Table.from_batches(held)


def bounded_groups(df: DataFrame, keys: list[str], node: str, most: int) -> DataFrame:
    """Give each row the blocks in which it meets every other row of its group.

    Adds block_a <= block_b and side. A group of up to `most` rows is one block (0, 0). A larger
    group is cut by a hash of `node` into chunks of about `most` rows, and each pair of chunks
    is a block of its own, so no task holds a whole hot group and no pair is lost: rows of one
    side meet those of the other, and those of their own side in block (a, a).
    """
    sizes = df.groupBy(*keys).count().where(F.col("count") > most)
    chunks = F.coalesce(F.ceil(F.col("count") / F.lit(most)), F.lit(1)).cast("int")
    return (
        df.join(sizes, keys, "left")
        .withColumn("side", F.pmod(F.xxhash64(node), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("block_a", F.least("side", "other"))
        .withColumn("block_b", F.greatest("side", "other"))
        .drop("count", "other")
    )


def run_pairs(starts: np.ndarray, n: int, at_once: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of rows in the same run, in arrays of at most about at_once."""
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    left = np.arange(n)
    held, size = [], 0
    d = 0
    while len(left):
        d += 1
        left = left[left + d < ends[left]]
        if len(left):
            held.append((left, left + d))
            size += len(left)
        if size and (size >= at_once or not len(left)):
            yield np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
            held, size = [], 0


class Forest:
    """Union of index pairs; keeps a label (the smallest index) for each of n items."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        lab = self.label
        while True:
            x, y = lab[a], lab[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(lab, np.maximum(x, y), np.minimum(x, y))
            while (lab[lab] != lab).any():
                lab[:] = lab[lab]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(item, its label) of items that are not their own label."""
        items = np.flatnonzero(self.label != np.arange(len(self.label)))
        return items, self.label[items]
