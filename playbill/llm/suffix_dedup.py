"""Removal of long repeated byte strings: blockwise suffix sorting with a difference cover.

Every two positions i, j have a shift d < PERIOD that brings both onto the cover (i + d and j + d
modulo PERIOD in COVER). So two equal strings of n bytes share n - PERIOD + 1 bytes from some
cover position on. First the cover's suffixes are named by that many bytes and sorted; only
suffixes with a repeated name within the next PERIOD bytes can start a repeat. Those are then
sorted one bucket at a time by all n bytes; a bucket is a range of names. Names are 64-bit
fingerprints, sorted as numbers: the order of unequal strings isn't asked for, only which are equal.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.storage import materialize, scratch

#: A perfect difference set: each shift modulo PERIOD is the difference of exactly one pair.
PERIOD, COVER = 133, (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
#: Text bytes of a shard, names (8 bytes each) of a bucket, and passes over the suffix buckets.
SHARD_BYTES, BUCKET_BYTES, PASSES = 24 << 20, 16 << 20, 4
STEP = 1 << 17
HEAD = struct.Struct("<QQ")
BASE = 0x9E3779B97F4A7C15
#: Random numbers that stand for the 256 byte values.
LETTERS = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out, dtype=np.uint64)


def window_names(text: np.ndarray, length: int, at: np.ndarray | slice) -> np.ndarray:
    """A 64-bit fingerprint of text[i:i + length] for each chosen i; every window must be inside."""
    sums = np.zeros(len(text) + 1, np.uint64)
    up = _powers(BASE, len(text) + 1)
    np.cumsum(LETTERS[text] * up[:-1], out=sums[1:])
    down = _powers(pow(BASE, -1, 1 << 64), len(text) + 1)
    start = np.arange(len(text) - length + 1)[at] if isinstance(at, slice) else at
    h = (sums[start + length] - sums[start]) * down[start]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Texts:
    """The texts of one shard as one byte array, with the bounds of its documents."""

    def __init__(self, ids: list[int | None], data: np.ndarray, bounds: np.ndarray) -> None:
        self.ids, self.data, self.bounds = ids, data, bounds

    def names(self, chosen: np.ndarray, length: int) -> np.ndarray:
        """Fingerprints of the windows at ascending positions, in steps of bounded size."""
        out = np.empty(len(chosen), np.uint64)
        i = 0
        while i < len(chosen):
            first = chosen[i]
            j = int(np.searchsorted(chosen, first + STEP))
            out[i:j] = window_names(self.data[first : chosen[j - 1] + length], length, chosen[i:j] - first)
            i = j
        return out

    def fits(self, positions: np.ndarray, length: int) -> np.ndarray:
        """Which windows end within the document they start in."""
        end = self.bounds[np.searchsorted(self.bounds, positions, side="right")]
        return positions + length <= end

    def cover(self, length: int) -> np.ndarray:
        """Ascending cover positions whose windows of `length` bytes are within a document."""
        n = len(self.data)
        at = (np.arange(0, n + PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
        at = at[at < n]
        return at[self.fits(at, length)] if n else at


def write_shard(root: str, ids: list[int | None], texts: list[bytes]) -> str:
    fs, base = pafs.FileSystem.from_uri(root)
    fs.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}.zst"
    data = b"".join(texts)
    body = HEAD.pack(len(ids), len(data)) + np.array([len(t) for t in texts], "<i8").tobytes() + np.array([i is None for i in ids], "u1").tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes() + data
    with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(zstandard.ZstdCompressor(level=1).compress(body))
    return name


def read_shard(root: str, name: str) -> Texts:
    fs, base = pafs.FileSystem.from_uri(root)
    with fs.open_input_file(f"{base}/{name}") as file:
        body = zstandard.ZstdDecompressor().decompress(file.read())
    n, size = HEAD.unpack_from(body)
    at = HEAD.size
    lengths, none, ids = np.frombuffer(body, "<i8", n, at), np.frombuffer(body, "u1", n, at + 8 * n), np.frombuffer(body, "<i8", n, at + 9 * n)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return Texts([None if x else i for x, i in zip(none.tolist(), ids.tolist(), strict=True)], np.frombuffer(body, np.uint8, size, at + 17 * n), bounds)


FILES = pa.schema([("file", pa.string()), ("n_bytes", pa.int64())])


def _shards(root: str):
    def run(batches):
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size >= SHARD_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([write_shard(root, ids, texts)]), pa.array([size], pa.int64())], schema=FILES)
                    ids, texts, size = [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([write_shard(root, ids, texts)]), pa.array([size], pa.int64())], schema=FILES)

    return run


def bucket_cuts(n_buckets: int) -> np.ndarray:
    """Upper ends (but the last) of equal ranges of names."""
    return np.array([(i << 64) // n_buckets for i in range(1, n_buckets)], np.uint64)


def distinct_names(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct names, and which of them occur more than once."""
    names = np.sort(names)
    first = np.ones(len(names), bool)
    first[1:] = names[1:] != names[:-1]
    starts = np.flatnonzero(first)
    return names[starts], np.diff(np.append(starts, len(names))) > 1


BUCKETS = pa.schema([("bucket", pa.int32()), ("file", pa.string()), ("names", pa.binary()), ("many", pa.binary())])
MARKS = pa.schema([("file", pa.string()), ("bucket", pa.int32()), ("marks", pa.binary())])


def bucket_rows(file: str, names: np.ndarray, n_buckets: int, buckets: range) -> Iterator[pa.RecordBatch]:
    """A row per bucket with the shard's distinct names in it."""
    distinct, many = distinct_names(names)
    cuts = np.concatenate([[0], np.searchsorted(distinct, bucket_cuts(n_buckets)), [len(distinct)]])
    for b in buckets:
        lo, hi = int(cuts[b]), int(cuts[b + 1])
        if lo < hi:
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([file]), pa.array([distinct[lo:hi].tobytes()], pa.binary()), pa.array([np.packbits(many[lo:hi]).tobytes()], pa.binary())], schema=BUCKETS)


def marked(names: np.ndarray, n_buckets: int, marks: dict[int, bytes]) -> np.ndarray:
    """Which of the names are repeated somewhere, from the marks of each bucket's distinct names."""
    distinct, _ = distinct_names(names)
    cuts = np.concatenate([[0], np.searchsorted(distinct, bucket_cuts(n_buckets)), [len(distinct)]])
    again = np.zeros(len(distinct), bool)
    for b, bits in marks.items():
        lo, hi = int(cuts[b]), int(cuts[b + 1])
        again[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
    repeated = distinct[again]
    at = np.searchsorted(repeated, names)
    return (repeated[np.minimum(at, len(repeated) - 1)] == names) if len(repeated) else np.zeros(len(names), bool)


def _sort_bucket(rows: list[tuple[str, bytes, bytes]], bucket: int) -> Iterator[pa.RecordBatch]:
    """Sort one bucket: mark names that several shards have, or one has more than once."""
    names = [np.frombuffer(x[1], np.uint64) for x in rows]
    _, index, counts = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
    shared = np.split(counts[index] > 1, np.cumsum([len(x) for x in names])[:-1])
    several = [np.unpackbits(np.frombuffer(x[2], np.uint8), count=len(n)).astype(bool) for x, n in zip(rows, names, strict=True)]
    # a name that one shard has twice is marked there; another shard's is marked as shared
    marks = [np.packbits(a | b).tobytes() for a, b in zip(shared, several, strict=True)]
    for (file, _, _), bits in zip(rows, marks, strict=True):
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([bucket], pa.int32()), pa.array([bits], pa.binary())], schema=MARKS)


def _bucket_sorter(batches):
    held, rows = None, []
    for batch in batches:
        for bucket, file, names, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != held and rows:
                yield from _sort_bucket(rows, held)
                rows = []
            held = bucket
            rows.append((file, names, many))
    if rows:
        yield from _sort_bucket(rows, held)


def _by_file(batches) -> Iterator[tuple[str, dict[int, dict[int, bytes]]]]:
    """(file, stage -> bucket -> bytes) of each shard; stage -1 rows only name the shard."""
    held, found = None, {}
    for batch in batches:
        for file, stage, bucket, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if file != held:
                if held is not None:
                    yield held, found
                held, found = file, {}
            if stage >= 0:
                found.setdefault(stage, {})[bucket] = marks
    if held is not None:
        yield held, found


def suspect_runs(texts: Texts, length: int, n_buckets: int, marks: dict[int, bytes]) -> np.ndarray:
    """Runs (start, end) of positions that can start a repeat: a cover position with a repeated name is at most PERIOD - 1 on."""
    short = length - PERIOD + 1
    cover = texts.cover(short)
    cover = cover[marked(texts.names(cover, short), n_buckets, marks)]
    if not len(cover):
        return np.empty((0, 2), np.int64)
    begin = np.maximum(cover - PERIOD + 1, 0)
    new = np.concatenate([[True], begin[1:] > cover[:-1]])
    return np.stack([begin[new], np.append(cover[:-1][new[1:]], cover[-1]) + 1], axis=1)


def unpacked(runs: bytes) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = np.frombuffer(runs, np.int64).reshape(-1, 2).T
    return starts, ends


def inside(runs: bytes) -> np.ndarray:
    """All positions of the runs (start, end), ascending."""
    starts, ends = unpacked(runs)
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(sizes) else np.empty(0, np.int64)


def as_runs(at: np.ndarray) -> np.ndarray:
    """Runs (start, end) of ascending positions."""
    if not len(at):
        return np.empty((0, 2), np.int64)
    new = np.flatnonzero(np.diff(at) != 1)
    return np.stack([at[np.append(0, new + 1)], at[np.append(new, len(at) - 1)] + 1], axis=1)


def suspects(texts: Texts, length: int, runs: bytes, known: int = 0) -> np.ndarray:
    """Positions, ascending, from which a string of `length` bytes may repeat.

    The runs hold what may start one, or, if `known` is given, all that starts a repeat of that
    many bytes: a longer repeat starts and ends with one.
    """
    at = inside(runs)
    if not known:
        return at[texts.fits(at, length)]
    there = np.zeros(len(texts.data) + length, bool)
    there[at] = True
    return at[there[at + (length - known)]]


def removed_runs(texts: Texts, runs: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [a, b) of bytes under the windows that start in the given runs, none across documents."""
    starts, ends = unpacked(runs)
    if not len(starts):
        return starts, starts
    ends = ends + (length - 1)
    doc = np.searchsorted(texts.bounds, starts, side="right")
    new = np.concatenate([[True], (starts[1:] > ends[:-1]) | (doc[1:] != doc[:-1])])
    return starts[new], np.append(ends[:-1][new[1:]], ends[-1])


RESULT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("n_kept", pa.int64()), ("n_repeated", pa.int64()), ("kept", pa.binary())]


def _emit_cover(root: str, length: int, n_buckets: int):
    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                texts = read_shard(root, file)
                yield from bucket_rows(file, texts.names(texts.cover(length), length), n_buckets, range(n_buckets))

    return run


RUNS = pa.schema([("file", pa.string()), ("runs", pa.binary())])


def _find_suspects(root: str, length: int, n_cover: int):
    def run(batches):
        for file, marks in _by_file(batches):
            runs = suspect_runs(read_shard(root, file), length, n_cover, marks.get(0, {}))
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([runs.tobytes()], pa.binary())], schema=RUNS)

    return run


def _emit_suspects(root: str, length: int, known: int, n_buckets: int, buckets: range):
    lo, hi = (buckets.start << 64) // n_buckets, ((buckets.stop << 64) // n_buckets) - 1

    def run(batches):
        for batch in batches:
            for file, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if runs:
                    texts = read_shard(root, file)
                    names = texts.names(suspects(texts, length, runs, known), length)
                    yield from bucket_rows(file, names[(names >= np.uint64(lo)) & (names <= np.uint64(hi))], n_buckets, buckets)

    return run


def _find_starts(root: str, length: int, known: int, n_buckets: int):
    """Runs of the positions that do start a repeat, of each shard."""

    def run(batches):
        for file, marks in _by_file(batches):
            runs = marks[0][-1]
            at = np.empty(0, np.int64)
            if runs:
                texts = read_shard(root, file)
                at = suspects(texts, length, runs, known)
                at = at[marked(texts.names(at, length), n_buckets, marks.get(1, {}))]
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([as_runs(at).tobytes()], pa.binary())], schema=RUNS)

    return run


def _finish(root: str, levels: list[int], with_text: bool):
    schema = pa.schema(RESULT if with_text else RESULT[:-1])

    def run(batches):
        for file, starts in _by_file(batches):
            texts = read_shard(root, file)
            spans = [removed_runs(texts, starts[k][-1], length) for k, length in enumerate(levels)]
            cuts = [np.searchsorted(a, texts.bounds) for a, _ in spans]
            rows = []
            for i, doc_id in enumerate(texts.ids):
                begin, end = int(texts.bounds[i]), int(texts.bounds[i + 1])
                own = [np.stack([a[cut[i] : cut[i + 1]], b[cut[i] : cut[i + 1]]], axis=1) for (a, b), cut in zip(spans, cuts, strict=True)]
                edges = [begin, *own[-1].ravel().tolist(), end]
                kept = b"".join(texts.data[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2], strict=True))
                row = (doc_id, end - begin, end - begin - len(kept), len(own[-1]), hashlib.sha256(kept).hexdigest(), len(kept), int(np.diff(own[0]).sum()), kept)
                rows.append(row if with_text else row[:-1])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _ranked(rows: DataFrame, parts: int) -> DataFrame:
    """Marks of each shard's names, bucket by bucket."""
    laid = rows.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return materialize(laid.mapInArrow(_bucket_sorter, "file string, bucket int, marks binary"), "marks")


def _staged(rows: DataFrame, stage: int, value: str = "marks") -> DataFrame:
    bucket = "bucket" if "bucket" in rows.columns else F.lit(-1).alias("bucket")
    return rows.select("file", F.lit(stage).alias("stage"), bucket, F.col(value).alias("marks"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, with_text: bool = True, passage: int | None = None) -> DataFrame:
    """Remove each byte of the UTF-8 texts under a string of `length` bytes that also starts elsewhere.

    Elsewhere is any other place of any row, the same row included; overlaps count, and all is
    judged on the input. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept,
    n_repeated and, with_text, the kept bytes (binary: a cut can fall inside a character).
    n_repeated counts the bytes under a string of `passage` bytes that also starts elsewhere
    (default: `length`); these stay unless the longer one takes them. Null and empty texts have
    no bytes. Repeated rows repeat each other's text. Ids are numbers. The shorter length is at
    least twice the period of the cover (266), the longer one under twice the shorter. No rows
    in, no rows out.

    Texts go once to compressed shards of bounded size in the shared folder. Shuffled are only
    names, distinct in each shard, packed by bucket (a row has at least one name, so rows never
    outnumber names), so a string that a third of all documents hold is one name a shard.
    Fingerprints of 64 bits confuse two of n strings with a chance of about n * n / 2**65.
    """
    levels = [length] if passage in (None, length) else [passage, length]
    if levels[0] < 2 * PERIOD or not levels[0] <= length < 2 * levels[0]:
        raise ValueError(f"the lengths must be at least {2 * PERIOD} and within a factor of two")
    spark = docs.sparkSession
    root = scratch(spark, "texts")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    files = materialize(rows.mapInArrow(_shards(root), "file string, n_bytes long"), "shards")
    n_files, n_bytes = files.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    n_cover = max(1, -(-n_bytes * 8 * len(COVER) // PERIOD // BUCKET_BYTES))
    n_buckets = PASSES * max(1, -(-n_bytes * 8 // 4 // BUCKET_BYTES // PASSES))
    # rows of a shard or a bucket are small to Spark and much work: their tasks are not to be merged
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard_parts, bucket_parts = max(1, min(n_files, most)), min(n_buckets // PASSES, most)

    def by_shard(staged: DataFrame) -> DataFrame:
        return staged.repartition(shard_parts, "file").sortWithinPartitions("file", "stage", "bucket")

    spread, least = files.select("file").repartition(shard_parts), levels[0]
    cover = _ranked(spread.mapInArrow(_emit_cover(root, least - PERIOD + 1, n_cover), "bucket int, file string, names binary, many binary"), min(n_cover, most))
    name = files.select("file", F.lit(-1).alias("stage"), F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("marks"))
    found = by_shard(name.union(_staged(cover, 0))).mapInArrow(_find_suspects(root, least, n_cover), "file string, runs binary")
    runs, known, per_pass = materialize(found, "suspects"), 0, n_buckets // PASSES
    starts: list[DataFrame] = []
    for size in levels:
        marks = _staged(runs, 0, "runs")
        for i in range(PASSES):  # one range of suffix buckets at a time bounds what is on disk
            emitted = runs.repartition(shard_parts).mapInArrow(_emit_suspects(root, size, known, n_buckets, range(i * per_pass, (i + 1) * per_pass)), "bucket int, file string, names binary, many binary")
            done = _ranked(emitted, bucket_parts)
            spark._jvm.System.gc()  # lets Spark drop the pass's shuffle files
            marks = marks.union(_staged(done, 1))
        runs, known = materialize(by_shard(marks).mapInArrow(_find_starts(root, size, known, n_buckets), "file string, runs binary"), "starts"), size
        starts.append(_staged(runs, len(starts), "runs"))
    laid = by_shard(reduce(DataFrame.union, starts))
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, n_repeated long" + ", kept binary" * with_text
    return laid.mapInArrow(_finish(root, levels, with_text), fields)


#: The least that the cover allows; 50 words of prose are seldom shorter.
PASSAGE = 2 * PERIOD


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document: repeats of 400 bytes go.

    n_kept are the bytes that stay; n_repeated the bytes under repeats of PASSAGE bytes, which
    tell passages of some 50 words that are too short to go.
    """
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False, passage=PASSAGE)
