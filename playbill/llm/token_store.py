"""Token-id shards with a minimal perfect hash index from document keys to records.

A shard is raw little-endian unsigned ids, of 16 bits where the vocabulary fits and else of 32,
then the records' bounds (unsigned 64-bit, in ids, one more than there are records) and a footer
that states the width. Shards follow each other in ascending key
order. The index is split by key hash into parts of bounded size; each is a level-wise minimal
perfect hash and a table of slots (fingerprint, shard, record, copies), so a key costs one part,
one slot and one read of its ids.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.llm.common import run_starts, whole_runs
from playbill.storage import scratch
from playbill.llm.tokens import default_tokenizer, encoder

SHARD_MAGIC, INDEX_MAGIC = b"TIDSHRD1", b"TIDMPHF1"
SHARD_FOOTER = struct.Struct("<QQQ8s")
INDEX_HEAD = struct.Struct("<8sQI")
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("record", "<u4"), ("copies", "<u4")])
#: Keys in one part of the index, on average.
PART_KEYS = 1 << 17
LEVELS = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key (the splitmix64 finaliser; one-to-one for each seed)."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, LEVELS + 1) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Maps n distinct keys one-to-one to 0..n-1.

    On each level every key left has one bit; keys that have theirs to themselves stay, the
    others go on to the next level. A key's value is the rank of its bit over all levels.
    """

    def __init__(self, sizes: list[int], words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 2.0) -> PerfectHash:
        left, sizes, levels = np.asarray(keys, np.int64).view(np.uint64), [], []
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys repeat")
            size = -(-int(room * len(left)) // 64) * 64 or 64
            at = mix(left, len(sizes)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(sizes, np.concatenate(levels) if levels else np.empty(0, "<u8"))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's value; -1, or any other key's value, for keys that were not built in."""
        left, out, base = np.arange(len(keys)), np.full(len(keys), -1, np.int64), 0
        keys = np.asarray(keys, np.int64).view(np.uint64)
        for level, size in enumerate(self.sizes):
            at = (mix(keys[left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.ranks[word] + np.bitwise_count(below))[hit]
            left, base = left[~hit], base + size
        return out

    def dump(self, slots: np.ndarray) -> bytes:
        return INDEX_HEAD.pack(INDEX_MAGIC, len(slots), len(self.sizes)) + np.array(self.sizes, "<u8").tobytes() + self.words.tobytes() + slots.tobytes()

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, np.ndarray]:
        magic, n, levels = INDEX_HEAD.unpack_from(data)
        if magic != INDEX_MAGIC:
            raise ValueError("no index part")
        sizes = np.frombuffer(data, "<u8", levels, INDEX_HEAD.size)
        at = INDEX_HEAD.size + 8 * levels
        words = np.frombuffer(data, "<u8", int(sizes.sum()) // 64, at)
        return cls([int(x) for x in sizes], words), np.frombuffer(data, SLOT, n, at + 8 * len(words))


def _open(root: str):
    fs, base = pafs.FileSystem.from_uri(root)
    return fs, base


def _write_bytes(root: str, name: str, data: bytes) -> None:
    fs, base = _open(root)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(data)


RECORDS = pa.schema([("part", pa.int32()), ("file", pa.string()), ("record", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64())])


def shard_writer(root: str, tokenizer: str, end_id: int, width: int):
    """Task function over (doc_id, text): writes one shard a task, ids of `width` bytes, and returns its records."""
    end = int(end_id).to_bytes(width, "little")

    def run(batches):
        from pyspark import TaskContext

        part, name, out, lengths = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.ids", None, []
        for batch in batches:
            if out is None:
                fs, base = _open(root)
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            first, sizes = len(lengths), []
            for i in range(0, batch.num_rows, 256):
                for ids in encoder(tokenizer).encode(batch.column(1).slice(i, 256).to_pylist()):
                    out.write((ids if width == 4 else np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()) + end)
                    sizes.append(len(ids) // 4 + 1)
            lengths += sizes
            n = len(sizes)
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([name] * n), pa.array(range(first, first + n), pa.int64()), batch.column(0), pa.array(sizes, pa.int64())], schema=RECORDS)
        if out is not None:
            bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.uint64)]).astype("<u8")
            out.write(shard_end(bounds, width))
            out.close()

    return run


def shard_end(bounds: np.ndarray, width: int) -> bytes:
    return bounds.tobytes() + SHARD_FOOTER.pack(len(bounds) - 1, int(bounds[-1]), width, SHARD_MAGIC)


def id_width(tokenizer: str, *more: int) -> int:
    """Bytes for each id of the tokenizer's vocabulary and of `more` ids."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), *more) < 1 << 16 else 4


class Shard:
    """An open shard: bounds of its records, and their ids."""

    def __init__(self, root: str, name: str) -> None:
        fs, base = _open(root)
        self.file = fs.open_input_file(f"{base}/{name}")
        size = self.file.size()
        self.file.seek(size - SHARD_FOOTER.size)
        n, total, self.width, magic = SHARD_FOOTER.unpack(self.file.read(SHARD_FOOTER.size))
        if magic != SHARD_MAGIC:
            raise ValueError(f"{name} is no shard")
        self.file.seek(self.width * total)
        self.bounds = np.frombuffer(self.file.read(8 * (n + 1)), "<u8").astype(np.int64)

    def ids(self, record: int) -> bytes:
        """A record's ids as little-endian unsigned 32-bit bytes."""
        a, b = int(self.bounds[record]), int(self.bounds[record + 1])
        self.file.seek(self.width * a)
        data = self.file.read(self.width * (b - a))
        return data if self.width == 4 else np.frombuffer(data, f"<u{self.width}").astype("<u4").tobytes()


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(np.asarray(keys, np.int64).view(np.uint64), LEVELS) % np.uint64(parts)).astype(np.int32)


def _parts(parts: int):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(part_of(batch.column(0).to_numpy(), parts)), *batch.columns], names=["index_part", *batch.schema.names])

    return run


def _index_writer(root: str):
    def run(batches):
        for table in whole_runs(batches, ["index_part"]):
            part, keys = table["index_part"].to_numpy(), table["doc_id"].to_numpy()
            starts = run_starts(part)
            for a, b in zip(starts, np.append(starts[1:], len(part)), strict=True):
                perfect = PerfectHash.build(keys[a:b])
                slots = np.zeros(b - a, SLOT)
                at = perfect.find(keys[a:b])
                slots["print"][at] = fingerprints(keys[a:b].view(np.uint64))
                for c in ("shard", "record", "copies"):
                    slots[c][at] = table[c].to_numpy()[a:b]
                name = f"{uuid.uuid4().hex}.mph"
                _write_bytes(root, name, perfect.dump(slots))
                yield pa.RecordBatch.from_pydict({"index_part": pa.array([part[a]], pa.int32()), "file": [name], "n_keys": pa.array([b - a], pa.int64())})

    return run


class TokenStore:
    """A written store: shards in key order, the index, and reading by key or in bulk."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        # One row a shard and one row an index part: as many as the store has files, never documents.
        self.shards = [tuple(r) for r in spark.read.parquet(f"{self.root}/shards").orderBy("shard").toLocalIterator()]
        self.parts = {r.index_part: r.file for r in spark.read.parquet(f"{self.root}/index").toLocalIterator()}
        self.n_parts = next((r.n_parts for r in spark.read.parquet(f"{self.root}/index").take(1)), 1)

    @classmethod
    def write(cls, docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 1) -> TokenStore:
        """Encode every text whole (null: empty), append end_id, and write shards and index under root.

        Records are in ascending id order, null ids first and not in the index; rows that repeat
        an id follow each other in the order of their texts' hashes, and the index names the
        first and their number. Text of any length is one record. An empty table has no shards.
        """
        spark, root = docs.sparkSession, root.rstrip("/")
        tokenizer = tokenizer or default_tokenizer()
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
        laid = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text")
        laid.mapInArrow(shard_writer(f"{root}/payload", tokenizer, end_id, id_width(tokenizer, end_id)), "part int, file string, record long, doc_id long, n_tokens long").write.parquet(f"{root}/records")
        records = spark.read.parquet(f"{root}/records")
        files = records.groupBy("part", "file").agg(F.count("*").alias("n_records"), F.sum("n_tokens").alias("n_tokens")).collect()  # one row a file
        base, shards = 0, []
        for i, r in enumerate(sorted(files, key=lambda r: r.part)):
            shards.append((i, r.part, r.file, base, r.n_records))
            base += r.n_tokens
        table = spark.createDataFrame(shards, "shard int, part int, file string, base long, n_records long")
        table.write.parquet(f"{root}/shards")
        # Keys span few shards: the shard in which a key begins, its first record there, its copies.
        runs = records.join(F.broadcast(table.select("shard", "file")) if len(shards) < 100_000 else table.select("shard", "file"), "file").where("doc_id is not null")
        keys = runs.groupBy("doc_id").agg(F.min(F.struct("shard", "record")).alias("at"), F.count("*").alias("copies")).select("doc_id", "at.shard", "at.record", "copies")
        n_keys = sum(r[4] for r in shards)
        n_parts = max(1, -(-n_keys // PART_KEYS))
        named = keys.mapInArrow(_parts(n_parts), "index_part int, doc_id long, shard int, record long, copies long")
        index = named.repartition("index_part").sortWithinPartitions("index_part").mapInArrow(_index_writer(f"{root}/mph"), "index_part int, file string, n_keys long")
        index.withColumn("n_parts", F.lit(n_parts)).write.parquet(f"{root}/index")
        return cls(spark, root)

    def _slots(self, keys: np.ndarray, part: int) -> np.ndarray:
        fs, base = _open(f"{self.root}/mph")
        with fs.open_input_file(f"{base}/{self.parts[part]}") as file:
            perfect, slots = PerfectHash.load(file.read())
        return _match(perfect, slots, keys)

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document with this key; none if it is not there."""
        keys = np.array([key], np.int64)
        part = int(part_of(keys, max(1, self.n_parts))[0])
        if part not in self.parts:
            return []
        slot = self._slots(keys, part)[0]
        found, shard, record = [], int(slot["shard"]), int(slot["record"])
        for _ in range(int(slot["copies"])):
            while record >= self.shards[shard][4]:
                shard, record = shard + 1, 0
            found.append(np.frombuffer(Shard(f"{self.root}/payload", self.shards[shard][2]).ids(record), "<u4"))
            record += 1
        return found

    def read(self, keys: DataFrame) -> DataFrame:
        """doc_id, start, n_tokens and ids_crc32 of every record of the given distinct keys (column doc_id).

        Keys are looked up part by part, and records then read shard by shard. Keys that the
        store doesn't have return no row; a null key returns the records without id.
        """
        spark, root = self.spark, self.root
        named = keys.where("doc_id is not null").mapInArrow(_parts(max(1, self.n_parts)), "index_part int, doc_id long")
        found = named.repartition("index_part").sortWithinPartitions("index_part").mapInArrow(_finder(root, self.parts), "doc_id long, shard int, record long, copies long")
        # copies of a key may run on into later shards
        sizes = spark.createDataFrame([(s[0], s[4]) for s in self.shards], "shard int, n_records long")
        ends = sizes.withColumn("end", F.sum("n_records").over(_by_shard())).withColumn("begin", F.col("end") - F.col("n_records"))
        at = found.join(ends, "shard").select("doc_id", F.explode(F.sequence(F.col("begin") + F.col("record"), F.col("begin") + F.col("record") + F.col("copies") - 1)).alias("row"))
        nulls = keys.where("doc_id is null").limit(1).count()
        if nulls:
            of_null = spark.read.parquet(f"{root}/records").where("doc_id is null").join(spark.read.parquet(f"{root}/shards").select("shard", "file"), "file").join(ends, "shard")
            at = at.union(of_null.select("doc_id", (F.col("begin") + F.col("record")).alias("row")))
        placed = at.mapInArrow(_placer([s[4] for s in self.shards]), "doc_id long, shard int, record long")
        return placed.repartition("shard").sortWithinPartitions("shard", "record").mapInArrow(_reader(root, {s[0]: (s[2], s[3]) for s in self.shards}), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _by_shard():
    from pyspark.sql import Window

    return Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _match(perfect: PerfectHash, slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Slots of keys; those whose fingerprint differs are not in the index and have no copies."""
    at = perfect.find(keys)
    found = slots[np.maximum(at, 0)].copy() if len(slots) else np.zeros(len(keys), SLOT)
    found["copies"][(at < 0) | (found["print"] != fingerprints(np.asarray(keys, np.int64).view(np.uint64)))] = 0
    return found


def _finder(root: str, parts: dict[int, str]):
    def run(batches):
        fs, base = _open(f"{root}/mph")
        held, perfect, slots = None, None, None
        for batch in batches:
            part, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = run_starts(part)
            for a, b in zip(starts, np.append(starts[1:], len(part)), strict=True):
                if part[a] not in parts:
                    continue
                if part[a] != held:
                    with fs.open_input_file(f"{base}/{parts[part[a]]}") as file:
                        (perfect, slots), held = PerfectHash.load(file.read()), part[a]
                found = _match(perfect, slots, keys[a:b])
                ok = found["copies"] > 0
                yield pa.RecordBatch.from_arrays([pa.array(keys[a:b][ok]), *(pa.array(found[c][ok].astype(t)) for c, t in (("shard", np.int32), ("record", np.int64), ("copies", np.int64)))], names=["doc_id", "shard", "record", "copies"])

    return run


def _placer(n_records: list[int]):
    ends = np.cumsum(n_records)

    def run(batches):
        for batch in batches:
            row = batch.column(1).to_numpy()
            shard = np.searchsorted(ends, row, side="right")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard.astype(np.int32)), pa.array(row - np.concatenate([[0], ends])[shard])], names=["doc_id", "shard", "record"])

    return run


def _reader(root: str, shards: dict[int, tuple[str, int]]):
    def run(batches):
        held, shard, base = None, None, 0
        for batch in batches:
            rows = []
            for doc_id, no, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if no != held:
                    held, (name, base) = no, shards[no]
                    shard = Shard(f"{root}/payload", name)
                ids = shard.ids(record)
                rows.append((doc_id, base + int(shard.bounds[record]), len(ids) // 4, zlib.crc32(ids)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def op5_token_store(spark, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back by key from the store."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = TokenStore.write(docs, scratch(spark, "tokens"))
    return store.read(docs.select("doc_id").distinct())
