"""A table by key in hashed buckets: a batch rewrites the buckets it touches, readers see one version."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbill.streaming.lifecycle import _last_by, upsert


class KeyedTable:
    """Rows of distinct keys under a path, as Parquet.

    A row's bucket is a hash of its keys. Each change writes the touched buckets anew in a folder of its own, then
    adds a manifest (versions/N.json) that says where every bucket is. The last manifest is the table: a
    reader takes all from one, a run that dies before its manifest leaves the table as it was, and what it wrote is never
    read. So the bytes written follow the batch and the size of a bucket, not the table's size. Manifests
    hold one short line a bucket. One writer at a time; a second one that is beaten to a version gets an error.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 256) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._make(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the last manifest, 0 if there is none."""
        folder = self._make(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return 0
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """schema, folders (of buckets), batches (last number of each stream) and size of a version."""
        number = self.version() if version is None else version
        if not number:
            return {"schema": None, "folders": {}, "batches": {}, "buckets": self.buckets}
        stream = self._fs.open(self._make(f"{self.path}/versions/{number}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, number: int, manifest: dict) -> None:
        """Add the manifest in one step: written under another name, then renamed."""
        final, draft = self._make(f"{self.path}/versions/{number}.json"), self._make(f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"another writer has made version {number} of {self.path}")

    def _of(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of some buckets (default: all) in a version; None if there is no such bucket."""
        folders = [f for b, f in manifest["folders"].items() if buckets is None or int(b) in set(buckets)]
        if not folders:
            return None
        return self.spark.read.schema(T.StructType.fromJson(manifest["schema"])).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self, version: int | None = None) -> DataFrame:
        """The table, of the last version or an older one that vacuum() has kept."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise ValueError(f"no table at {self.path}")
        rows = self._of(found)
        return self.spark.createDataFrame([], T.StructType.fromJson(found["schema"])) if rows is None else rows

    def _bucket(self, manifest: dict):
        return F.pmod(F.xxhash64(*self.keys), F.lit(manifest["buckets"])).cast("int")

    def _replace(self, change, touching: DataFrame, number: int, manifest: dict, stream: tuple[str, int] | None) -> list[int]:
        """Rewrite the buckets of the rows of `touching` with change(stored rows of these or None)."""
        touched = sorted(r[0] for r in touching.select(self._bucket(manifest).alias("b")).distinct().collect())
        if touched:
            stored = self._of(manifest, touched)
            rows = change(stored)
            if manifest["schema"] is not None and set(rows.columns) != {f["name"] for f in manifest["schema"]["fields"]}:
                raise ValueError("a batch has other columns than the table")
            if manifest["schema"] is not None:
                rows = rows.select(*(F.col(f"`{f['name']}`") for f in manifest["schema"]["fields"]))
            folder = f"data/{number}-{uuid.uuid4().hex}"
            rows.repartition(min(len(touched), 200), self._bucket(manifest)).withColumn("_bucket", self._bucket(manifest)).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            written = {s.getPath().getName().removeprefix("_bucket=") for s in self._fs.listStatus(self._make(f"{self.path}/{folder}")) if s.isDirectory()}
            folders = {b: f for b, f in manifest["folders"].items() if int(b) not in touched} | {b: f"{folder}/_bucket={b}" for b in written}
            manifest = manifest | {"folders": folders, "schema": manifest["schema"] or rows.schema.jsonValue()}
        if touched or stream:
            batches = manifest["batches"] | ({stream[0]: stream[1]} if stream else {})
            self._commit(number, manifest | {"batches": batches})
        return touched

    def upsert(self, rows: DataFrame, run_id: str, order: list[str] | None = None, stream: tuple[str, int] | None = None) -> list[int]:
        """Put rows, active and with the run's id, over stored ones of their keys; returns the buckets rewritten.

        Of rows of one key the last in `order` counts (default: by all other columns). stream names a
        stream and its batch: a batch that the table has seen is not put in twice.
        """
        number = self.version()
        manifest = self.manifest(number)
        if stream and manifest["batches"].get(stream[0], -1) >= stream[1]:
            return []
        rows = _last_by(rows, self.keys, order or [c for c in rows.columns if c not in self.keys])

        def change(stored: DataFrame | None) -> DataFrame:
            return upsert(stored if stored is not None else upsert(rows.limit(0), rows.limit(0), self.keys, run_id), rows, self.keys, run_id)

        return self._replace(change, rows, number + 1, manifest, stream)

    def sweep(self, seen: DataFrame) -> list[int]:
        """Rows that are active but whose keys a run hasn't seen become inactive; only their buckets are rewritten."""
        number = self.version()
        manifest = self.manifest(number)
        stored = self._of(manifest)
        if stored is None:
            return []
        stale = stored.where("is_active").join(seen.select(*self.keys).distinct(), self.keys, "left_anti").select(*self.keys)

        def change(held: DataFrame) -> DataFrame:
            marked = held.join(stale.withColumn("_stale", F.lit(True)), self.keys, "left")
            return marked.withColumn("is_active", F.col("is_active") & F.col("_stale").isNull()).drop("_stale")

        return self._replace(change, stale, number + 1, manifest, None)

    def vacuum(self, keep: int = 2) -> None:
        """Delete all but the last `keep` versions and the folders that none of these reads."""
        last = self.version()
        for n in range(1, last - keep + 1):
            self._fs.delete(self._make(f"{self.path}/versions/{n}.json"), False)
        used = {f for n in range(max(1, last - keep + 1), last + 1) for f in self.manifest(n)["folders"].values()}
        runs = {f.split("/")[1] for f in used}
        data = self._make(f"{self.path}/data")
        for run in self._fs.listStatus(data) if self._fs.exists(data) else []:
            name = run.getPath().getName()
            if name not in runs:
                self._fs.delete(run.getPath(), True)
                continue
            for bucket in self._fs.listStatus(run.getPath()):
                if bucket.isDirectory() and f"data/{name}/{bucket.getPath().getName()}" not in used:
                    self._fs.delete(bucket.getPath(), True)


def upsert_keyed(stream: DataFrame, table: KeyedTable, checkpoint: str, run_id: str, order: list[str] | None = None, name: str = "stream") -> None:
    """Micro-batches put into a keyed table, each once: the table remembers the last batch of the stream."""

    def batch(df: DataFrame, number: int) -> None:
        table.upsert(df, f"{run_id}-{number}", order, (name, number))

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
