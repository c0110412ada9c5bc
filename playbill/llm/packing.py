"""Packing into fixed windows: a non-negative least squares plan over the histogram of lengths.

Only the histogram (one count for each length below the window) reaches the driver, and only
the plan (a bounded number of combinations) goes back. Where a document lands then follows from
its rank among the documents of its length, by arithmetic.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.common import small_batches
from playbill.storage import scratch
from playbill.llm.token_store import Shard, id_width, shard_writer
from playbill.llm.tokens import default_tokenizer

WINDOW = 4096
#: Most combinations in the plan; what they don't cover is packed as residual, none is left out.
COMBINATIONS = 20_000


def combinations(counts: np.ndarray, window: int, most: int = COMBINATIONS) -> np.ndarray:
    """Rows of up to three lengths (0: none) that fill the window exactly, the most plentiful first.

    counts[l] is the number of pieces of length l, l < window.
    """
    present = np.flatnonzero(counts[1:window]) + 1
    found = []
    pair = present[(present <= window - present) & (counts[window - present] > 0)]
    found.append(np.stack([window - pair, pair, np.zeros_like(pair)], axis=1))
    for a in present[present * 3 >= window]:  # a >= b >= c > 0
        b = present[(present <= a) & (2 * present >= window - a) & (present < window - a)]
        c = window - a - b
        ok = counts[c] > 0
        found.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    rows = np.concatenate(found).astype(np.int64)
    plenty = np.where(rows > 0, counts[rows], counts.max(initial=0)).min(axis=1) if len(rows) else np.empty(0)
    return rows[np.lexsort((*rows.T, -plenty))[:most]]


def solve(rows: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations that least-squares fit the histogram, accelerated projected gradient."""
    goal = counts.astype(float)
    goal[0] = 0
    x = y = np.zeros(len(rows))
    used = np.bincount(rows.ravel(), minlength=len(goal))
    used[0] = 0
    step, t = 1.0 / max(1.0, 3.0 * used.max(initial=1)), 1.0
    real = rows > 0
    for _ in range(rounds if len(rows) else 0):
        fit = np.bincount(rows.ravel(), np.repeat(y, 3) * real.ravel(), len(goal))
        gain = np.where(real, (goal - fit)[rows], 0.0).sum(axis=1)
        nxt = np.maximum(0.0, y + step * gain)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = nxt, nxt + (t - 1) / t_next * (nxt - x), t_next
    return x


def whole_repeats(rows: np.ndarray, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """x rounded to what the histogram has: largest first, each as often as its lengths last."""
    left, out = counts.copy(), np.zeros(len(rows), np.int64)
    for i in np.argsort(-x, kind="stable"):
        lengths, each = np.unique(rows[i][rows[i] > 0], return_counts=True)
        n = min(int(round(x[i])), int((left[lengths] // each).min())) if x[i] >= 0.5 else 0
        if n:
            out[i] = n
            left[lengths] -= n * each
    return out


class Plan:
    """Where the k-th piece of each length goes: blocks of ranks for combinations, then residual."""

    def __init__(self, counts: np.ndarray, window: int, first_sequence: int) -> None:
        self.window = window
        rows = combinations(counts, window)
        repeats = whole_repeats(rows, solve(rows, counts), counts)
        begin = np.zeros(window, np.int64)  # ranks dealt so far of each length
        blocks: list[list[tuple[int, int, int]]] = [[] for _ in range(window)]
        sequence = first_sequence
        for row, n in zip(rows[repeats > 0].tolist(), repeats[repeats > 0].tolist(), strict=True):
            offset = 0
            for length in row:
                if length:
                    blocks[length].append((int(begin[length]), sequence, offset))
                    begin[length] += n
                    offset += length
            sequence += n
        self.starts = {l: np.array(b, np.int64) for l, b in enumerate(blocks) if b}
        # greedy rest: longest first, one after another, cut at window ends
        rest = counts - begin
        rest[0] = 0
        tokens = rest * np.arange(window)
        self.rest_rank = begin
        self.rest_token = np.concatenate([np.cumsum(tokens[::-1])[::-1][1:], [0]])
        self.rest_sequence = sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, offset, first part's length) of each piece; the rest of it, if any, begins the next sequence."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        rest = rank >= self.rest_rank[length]
        token = self.rest_token[length[rest]] + (rank[rest] - self.rest_rank[length[rest]]) * length[rest]
        sequence[rest], offset[rest] = self.rest_sequence + token // self.window, token % self.window
        for l in np.unique(length[~rest]).tolist():
            at = np.flatnonzero(~rest & (length == l))
            block = self.starts[l][np.searchsorted(self.starts[l][:, 0], rank[at], side="right") - 1]
            sequence[at], offset[at] = block[:, 1] + rank[at] - block[:, 0], block[:, 2]
        return sequence, offset, np.minimum(length, self.window - offset)


PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def _pieces(root: str, plan: Plan, full_base: dict[str, int]):
    def run(batches):
        held = shard = None
        for batch in batches:
            files = batch.column(0).to_pylist()
            record, tokens, rank, full = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 3, 4, 5))
            doc_ids = batch.column(2).to_pylist()
            rest = tokens % plan.window
            sequence, offset, first = plan.place(rest, np.where(rest > 0, rank, 0))
            out = []
            for i, file in enumerate(files):
                if file != held:
                    held, shard = file, Shard(root, file)
                ids, n = memoryview(shard.ids(int(record[i]))), int(tokens[i])
                whole = n - int(rest[i])
                cuts = [(s, plan.window, full_base[file] + int(full[i]) + s // plan.window, 0) for s in range(0, whole, plan.window)]
                if rest[i]:
                    cuts.append((whole, int(first[i]), int(sequence[i]), int(offset[i])))
                    if first[i] < rest[i]:
                        cuts.append((whole + int(first[i]), int(rest[i] - first[i]), int(sequence[i]) + 1, 0))
                out += [(doc_ids[i], s, l, zlib.crc32(ids[4 * s : 4 * (s + l)]), n, q, o) for s, l, q, o in cuts]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=PIECES)

    return run


def pack(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """Pack whole texts, each with end_id behind it, into sequences of `window` ids.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    Null and empty texts are the end id alone. Whole windows of a long document are sequences of
    their own; of what remains, combinations of up to three lengths fill windows exactly, as often
    as the least squares solution says; the rest goes one after another, longest first, cut at
    window ends. So only the last sequence has padding. Rows that repeat an id, or have none, are
    packed each. No rows in, no rows out. Ids stay in shards under root; only record rows are
    shuffled.
    """
    spark, root = docs.sparkSession, root.rstrip("/")
    small_batches(spark)
    tokenizer = tokenizer or default_tokenizer()
    width = id_width(tokenizer, end_id)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows.mapInArrow(shard_writer(f"{root}/payload", tokenizer, end_id, width), "part int, file string, record long, doc_id long, n_tokens long").write.parquet(f"{root}/records")
    records = spark.read.parquet(f"{root}/records").select("file", "record", "doc_id", "n_tokens", (F.col("n_tokens") % window).cast("int").alias("rest"), F.floor(F.col("n_tokens") / window).alias("full"))
    counts = np.zeros(window, np.int64)
    for r in records.groupBy("rest").count().collect():  # at most `window` rows
        counts[r["rest"]] = r["count"]
    counts[0] = 0
    base, full_base = 0, {}
    for r in records.groupBy("file").agg(F.sum("full").alias("n")).collect():  # one row a file
        full_base[r.file] = base
        base += int(r.n)
    plan = Plan(counts, window, base)
    # rank among all pieces of a length: those in earlier files, then those before it in its file
    by_file = records.groupBy("rest", "file").count()
    before = by_file.select("rest", "file", (F.sum("count").over(Window.partitionBy("rest").orderBy("file")) - F.col("count")).alias("before"))
    local = records.withColumn("nth", F.row_number().over(Window.partitionBy("file", "rest").orderBy("record")) - 1)
    local = local.withColumn("full_before", F.sum("full").over(Window.partitionBy("file").orderBy("record")) - F.col("full"))
    ranked = local.join(before, ["rest", "file"]).select("file", "record", "doc_id", "n_tokens", (F.col("nth") + F.col("before")).alias("rank"), "full_before")
    laid = ranked.repartition("file").sortWithinPartitions("file", "record")
    return laid.mapInArrow(_pieces(f"{root}/payload", plan, full_base), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark, "packing"))
