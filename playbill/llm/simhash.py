"""SimHash near-dedup: links fingerprints by pigeonring filtering on a ring of bit segments."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.common import Forest, bounded_groups, run_pairs, run_starts, whole_runs
from playbill.storage import materialize
from playbill.llm.components import connected_components

BITS = 64
#: Fingerprints compared in one block; larger buckets are refined, then cut into blocks.
BLOCK = 1024
#: Buckets of more blocks than this are split by further bits first.
REFINE = 8
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of `words` words, repeats included; of the whole sequence if it is shorter."""
    found = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(line, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    begin = np.concatenate([[0], ends[:-1] + 1])[: len(found) - words + 1].tolist()
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(begin, ends[words - 1 :].tolist(), strict=True)), np.uint64, len(begin))


def fingerprint(hashes: np.ndarray, at_once: int = 1 << 16) -> int:
    """Unsigned 64 bits, each set if over half the hashes have it; zero for no hashes."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), at_once):
        part = hashes[i : i + at_once].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def spread(hashes: np.ndarray, k: int) -> np.ndarray:
    """Other hashes of the same shingles, for further fingerprint bits."""
    x = (hashes + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _fingerprints(words: int, seed: int):
    schema = pa.schema([(c, pa.int64()) for c in ("id", "fp", "n")])

    def run(batches):
        for batch in batches:
            hashes = [shingle_hashes(t.as_py(), words, seed) for t in batch.column(1)]
            fps = np.array([fingerprint(h) for h in hashes], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), pa.array([len(h) for h in hashes], pa.int64())], schema=schema)

    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, seed: int = 42) -> DataFrame:
    """id, fp (the fingerprint's bits as a signed long) and n (shingles, repeats included) of each row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(words, seed), "id long, fp long, n long")


class Ring:
    """max_distance + 1 segments around the 64 bits, with a budget for each chain of them.

    If two fingerprints differ in at most t bits, then from some segment on every chain of l
    segments differs in at most l * t / (t + 1) bits; the first segment is thus equal.
    """

    def __init__(self, max_distance: int) -> None:
        m = max_distance + 1
        cuts = [round(i * BITS / m) for i in range(m + 1)]
        self.most = max_distance
        self.start = cuts[:-1]
        widths = np.diff(cuts)
        self.width = [[int(widths[(i + k) % m]) for k in range(m)] for i in range(m)]
        self.budget = [l * max_distance // m for l in range(1, m + 1)]

    @staticmethod
    def top(bits: int) -> int:
        return ((1 << bits) - 1) << (BITS - bits)

    def chain(self, i: int, length: int) -> int:
        """Mask of the first `length` segments from segment i, with i at the top."""
        return self.top(sum(self.width[i][:length]))

    def refined(self, i: int) -> list[int]:
        """Masks for hot buckets: of the next two segments, cut into budget + 2 parts, two parts are equal."""
        first, spare = self.width[i][0], sum(self.width[i][1:3])
        parts = min(self.budget[min(2, self.most)] + 2, spare)
        if parts < 3 or self.most < 2:
            return []
        cuts = [first + round(k * spare / parts) for k in range(parts + 1)]
        masks = [self.top(b) & ~self.top(a) for a, b in itertools.pairwise(cuts)]
        keep = parts - self.budget[2]
        return [self.top(first) | sum(c) for c in itertools.combinations(masks, keep)]


def _long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _turned(i: int):
    """fp turned left by i bits."""
    return F.col("fp") if not i else F.shiftleft("fp", i).bitwiseOR(F.shiftrightunsigned("fp", BITS - i))


def _linker(ring: Ring, min_ratio: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    keys = ["seg", "key", "block_a", "block_b"]

    def run(batches):
        for table in whole_runs(batches, keys):
            seg, key, block_a, block_b, side, bits, n = (table[c].to_numpy() for c in [*keys, "side", "bits", "n"])
            bits = bits.view(np.uint64)
            forest = Forest(len(seg))
            for i, j in run_pairs(run_starts(seg, key, block_a, block_b), len(seg)):
                meet = (block_a[i] == block_b[i]) | (side[i] != side[j])
                if min_ratio:  # rows from the class below have -n; they met each other there
                    a, b = np.abs(n[i]), np.abs(n[j])
                    meet &= (np.minimum(a, b) >= min_ratio * np.maximum(a, b)) & ((n[i] > 0) | (n[j] > 0))
                i, j = i[meet], j[meet]
                x = bits[i] ^ bits[j]
                for l in range(2, ring.most + 1):  # chains that go over their budget leave
                    ok = np.bitwise_count(x & chains[l][seg[i]]) <= ring.budget[l - 1]
                    i, j, x = i[ok], j[ok], x[ok]
                    if not len(i):
                        break
                ok = np.bitwise_count(x) <= ring.most
                forest.join(i[ok], j[ok])
            a, b = forest.edges()
            turn = lambda k: (bits[k] >> starts[seg[k]]) | (bits[k] << ((BITS - starts[seg[k]]) & 63))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(turn(a).view(np.int64)), pa.array(turn(b).view(np.int64))], schema=schema)

    starts = np.array(ring.start, np.uint64)
    chains = [np.array([ring.chain(i, l) for i in range(ring.most + 1)], np.uint64) for l in range(ring.most + 2)]
    return run


def links(nodes: DataFrame, max_distance: int, min_ratio: float = 0.0, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within max_distance bits of each other.

    nodes: distinct fp, and n. With min_ratio, the smaller n must also be at least that share of
    the larger (n is positive then), and buckets are split by size class. In each bucket only a
    spanning forest of its links is returned, never all pairs. Buckets over `block` are compared
    chunk by chunk, and those over REFINE blocks are first split by bits of the next segments, so
    none is dropped or sampled.
    """
    ring = Ring(max_distance)
    size_class = F.lit(0)
    if min_ratio:
        # a partner's n is within 1 / min_ratio: it is in the same class or the next
        size_class = F.floor(F.log(F.greatest("n", F.lit(1)).cast("double")) / float(-np.log(min_ratio) + 1e-9)).cast("int")
        placed = F.array(F.struct(size_class.alias("class"), F.col("n").alias("n")), F.struct((size_class + 1).alias("class"), (-F.col("n")).alias("n")))
        nodes = nodes.select("fp", F.explode(placed).alias("at")).select("fp", "at.n", "at.class")
    else:
        nodes = nodes.withColumn("class", size_class)
    at = [F.struct(F.lit(i).alias("seg"), _turned(s).alias("bits"), _turned(s).bitwiseAND(F.lit(_long(ring.chain(i, 1)))).alias("first")) for i, s in enumerate(ring.start)]
    keyed = nodes.select("fp", "n", "class", F.explode(F.array(*at)).alias("at")).select("fp", "n", "at.seg", "at.bits", "class", F.xxhash64("class", "at.first").alias("key") if min_ratio else F.col("at.first").alias("key"))
    if masks := {i: m for i in range(max_distance + 1) if (m := ring.refined(i))}:
        hot = keyed.groupBy("seg", "key").count().where(F.col("count") > REFINE * block).select("seg", "key", F.lit(True).alias("hot"))
        finer = F.expr("case seg " + " ".join(f"when {i} then array({', '.join(f'{_long(m)}L' if _long(m) != -(2**63) else 'bigint(-9223372036854775808)' for m in ms)})" for i, ms in masks.items()) + " end")
        parts = F.when(F.col("hot"), F.transform(finer, lambda m, k: F.xxhash64("class", F.col("bits").bitwiseAND(m), k))).otherwise(F.array("key"))
        keyed = keyed.join(hot, ["seg", "key"], "left").withColumn("key", F.explode(parts)).drop("hot")
    keyed = bounded_groups(keyed.select("fp", "n", "seg", "bits", "key"), ["seg", "key"], "fp", block)
    order = ["seg", "key", "block_a", "block_b"]
    # comparing is more work than the rows' size tells: as many tasks as a shuffle has
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = keyed.select(*order, "side", "bits", "n").repartition(parts, *order).sortWithinPartitions(*order)
    return laid.mapInArrow(_linker(ring, min_ratio), "a long, b long")


def _labelled(rows: DataFrame, max_distance: int, min_ratio: float, min_shingles: int) -> DataFrame:
    """fp, its smallest id and its component (the smallest linked fp) of each fingerprint."""
    nodes = rows.groupBy("fp").agg(F.min("n").alias("n"), F.min("id").alias("least"))
    linked = nodes.where(F.col("n") >= min_shingles) if min_shingles else nodes
    groups = connected_components(links(linked.select("fp", "n"), max_distance, min_ratio))
    return nodes.select("fp", "least").join(groups, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_distance: int = 4, min_ratio: float = 0.0, min_shingles: int = 0) -> DataFrame:
    """doc_id, fingerprint, n_shingles and component_id of every row of docs.

    Texts lose their A-Z to lower case; words end at ASCII white space; a fingerprint has a bit
    where over half the shingle hashes (XXH64, seed 42) have it, and is zero without words. Null
    and empty texts are texts without words. Documents whose fingerprints differ in at most
    max_distance bits are linked, equal fingerprints always. min_ratio asks for shingle counts
    that close (the least count stands for equal fingerprints), min_shingles for so many in both.
    component_id is the smallest id reachable; null ids are never it. Ids are numbers. Repeated
    rows each return. No rows in, no rows out.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    labelled = _labelled(rows, max_distance, min_ratio, min_shingles)
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(smallest, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("n").alias("n_shingles"), "component_id")


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document: 4-word shingles, at most 4 bits apart."""
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "fingerprint", "component_id")
