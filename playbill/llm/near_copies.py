"""SimHash near copies at a Jaccard similarity: MinHash keys propose, pigeonring on wide SimHash prunes, whole sets decide.

At similarity 0.8 fingerprints of 64 bits differ in 9.7 bits on average. Equal segments would be
of four bits then and hardly tell texts apart, so candidates are sought by prefixes and MinHash
bands instead; fingerprints of 256 bits, with ring and Hamming check, let go what isn't alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.common import Forest, bounded_groups, run_pairs, run_starts, small_batches, whole_runs
from playbill.llm.components import connected_components
from playbill.llm.simhash import fingerprint, shingle_hashes, spread
from playbill.storage import materialize

#: MinHash values in bands: a pair of similarity 0.8 shares no band in 3 of a million cases.
BANDS, BAND = 24, 4
#: Sets of at most this many shingles meet by their prefixes, without loss; those of at least 0.8
#: of it (so that every possible pair has one way or the other) by their bands.
SHORT = 80
#: 64-bit parts of a fingerprint, and bits in which two of its sets may differ: texts of similarity
#: 0.8 differ in 39 on average with a deviation of 6, unrelated ones in 128.
PARTS, MOST = 4, 72
#: Segments of the ring around a fingerprint.
SEGMENTS = 2 * PARTS
#: Sets compared in one block: of candidates by their fingerprints, of whole sets.
BLOCK, SET_BLOCK = 1024, 256
#: Odd multipliers, one a MinHash value.
TURNS = np.random.default_rng(42).integers(0, 2**63, BANDS * BAND).astype(np.uint64) * np.uint64(2) + np.uint64(1)

SIGNED = "id long, node long, n long, sketch binary, keys array<long>"


def digest(hashes: np.ndarray) -> int:
    """A 64-bit hash of a set of shingles (sorted, distinct) as a signed long."""
    return int(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), 7)], np.uint64).view(np.int64)[0])


def signature(hashes: np.ndarray) -> np.ndarray:
    """The MinHash values of a set that isn't empty."""
    return np.array([(hashes * t).min() for t in TURNS], np.uint64)


def meeting_keys(hashes: np.ndarray, mins: np.ndarray, similarity: float) -> list[int]:
    """Keys of which two sets of at least that similarity share one.

    Of two short sets, the prefixes (sorted alike, so long that what is left is too little) share
    a shingle. Longer ones share a band but for a chance.
    """
    n = len(hashes)
    keys = []
    if n <= SHORT:
        keys.append(hashes[: n - int(np.ceil(similarity * n - 1e-9)) + 1])
    if n >= int(similarity * SHORT):
        keys.append(np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(mins.reshape(BANDS, BAND))], np.uint64))
    return np.concatenate(keys).view(np.int64).tolist()


def _sign(words: int, similarity: float):
    schema = pa.schema([("id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            made = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = np.unique(shingle_hashes(t.as_py(), words))
                if i is not None and len(hashes):
                    mins = signature(hashes)
                    made.append((i, digest(hashes), len(hashes), wide_fingerprint(hashes), meeting_keys(hashes, mins, similarity)))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    return run


def _sets(words: int):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            for t in batch.column(0):  # a row at a time: sets are as long as their texts
                hashes = np.unique(shingle_hashes(t.as_py(), words))
                yield pa.RecordBatch.from_arrays([pa.array([digest(hashes)], pa.int64()), pa.array([hashes.tobytes()], pa.binary())], schema=schema)

    return run


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """PARTS * 64 bits of a set's SimHash, each part over other hashes of the shingles."""
    return np.array([fingerprint(spread(hashes, k)) for k in range(PARTS)], np.uint64).tobytes()


def ring_near(apart: np.ndarray, most: int) -> np.ndarray:
    """Which rows of differing bits (PARTS words each) have at most `most` of them.

    If so, from some segment of the ring on every chain of l segments differs in at most
    l * most / SEGMENTS bits: rows leave with the last such chain, before all bits are counted.
    """
    left = np.arange(len(apart))
    counts = np.bitwise_count(apart.view(np.uint32)).astype(np.int64).reshape(len(apart), SEGMENTS)
    chain, alive = np.zeros_like(counts), np.ones(counts.shape, bool)
    for length in range(1, SEGMENTS):
        chain += np.roll(counts, 1 - length, axis=1)
        alive &= chain <= length * most // SEGMENTS
        some = alive.any(axis=1)
        left, counts, chain, alive = left[some], counts[some], chain[some], alive[some]
    near = np.zeros(len(apart), bool)
    near[left[counts.sum(axis=1) <= most]] = True
    return near


def _candidates(table: pa.Table, keys: list[str], similarity: float, forest: Forest | None, at_once: int):
    """Index pairs that meet in a block, whose sizes allow the similarity and whose fingerprints are near."""
    columns = [table[c].to_numpy() for c in keys]
    block_a, block_b = columns[-2:]
    side, n = table["side"].to_numpy(), table["n"].to_numpy()
    bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(n), PARTS)
    for i, j in run_pairs(run_starts(*columns), len(n), at_once):
        meet = ((block_a[i] == block_b[i]) | (side[i] != side[j])) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9)
        if forest is not None:
            meet &= forest.label[i] != forest.label[j]
        i, j = i[meet], j[meet]
        close = np.empty(len(i), bool)
        for at in range(0, len(i), 1 << 14):
            part = slice(at, at + (1 << 14))
            close[part] = ring_near(bits[i[part]] ^ bits[j[part]], MOST)
        yield i[close], j[close]


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(node: np.ndarray, forest: Forest) -> pa.RecordBatch:
    a, b = forest.edges()
    return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], schema=EDGES)


def _proposer(similarity: float):
    keys = ["key", "block_a", "block_b"]

    def run(batches):
        for table in whole_runs(batches, keys, 8192):
            forest = Forest(table.num_rows)
            for i, j in _candidates(table, keys, similarity, forest, 1 << 16):
                forest.join(i, j)
            yield _edges(table["node"].to_numpy(), forest)

    return run


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have at least that Jaccard similarity."""
    if len(a) > len(b):
        a, b = b, a
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _decider(similarity: float):
    keys = ["component", "block_a", "block_b"]

    def run(batches):
        for table in whole_runs(batches, keys, 64):
            sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
            forest = Forest(len(sets))
            part = table["part"].to_numpy()
            order = np.argsort(part, kind="stable")
            same = part[order[1:]] == part[order[:-1]]
            forest.join(order[1:][same], order[:-1][same])  # these hang together already
            for i, j in _candidates(table, keys, similarity, forest, 1 << 12):
                for x, y in zip(i.tolist(), j.tolist()):  # those that hang together by now need no look
                    if forest.label[x] != forest.label[y] and alike(sets[x], sets[y], similarity):
                        forest.join(np.array([x]), np.array([y]))
            yield _edges(table["node"].to_numpy(), forest)

    return run


def _hash_of(n: Column) -> Column:
    return F.pmod(F.xxhash64("node"), n).cast("int")


def first_blocks(crowd: DataFrame) -> DataFrame:
    """Each set in one block of about SET_BLOCK sets of its component; the component's smallest node in all of its blocks.

    large tells components of several blocks: their blocks don't meet but over that node.
    """
    sizes = crowd.groupBy("component").count().where(F.col("count") > SET_BLOCK)
    chunks = F.coalesce(F.ceil(F.col("count") / F.lit(SET_BLOCK)), F.lit(1)).cast("int")
    at = F.when(F.col("node") == F.col("component"), F.sequence(F.lit(0), chunks - 1)).otherwise(F.array(_hash_of(chunks)))
    laid = crowd.join(sizes, "component", "left").withColumn("block_a", F.explode(at)).withColumn("large", F.col("count").isNotNull()).drop("count")
    return laid.withColumn("block_b", F.col("block_a")).withColumn("side", F.lit(0)).withColumn("part", F.col("node"))


def further_blocks(crowd: DataFrame) -> DataFrame:
    """Blocks in which all pairs of a component's sets meet whose parts (sets that hang together) differ.

    Components of one part have none. Sets of the largest part, if that is over a block, meet the
    other parts' sets only.
    """
    sizes = crowd.groupBy("component", "part").count()
    main = sizes.groupBy("component").agg(F.max(F.struct("count", "part")).alias("main"), F.sum("count").alias("whole"), F.count("*").alias("parts")).where("parts > 1")
    alone = F.when(F.col("main.count") > SET_BLOCK, F.col("main.count")).otherwise(0)
    main = main.select("component", "main.part", alone.alias("alone"), F.col("whole")).withColumnRenamed("part", "largest")
    chunks = lambda n: F.ceil(n / F.lit(SET_BLOCK)).cast("int")
    main = main.withColumn("mixed", chunks(F.col("whole") - F.col("alone"))).withColumn("pure", chunks(F.col("alone")))
    apart = (F.col("pure") > 0) & (F.col("part") == F.col("largest"))
    rows = crowd.join(main, "component").withColumn("side", F.when(apart, F.col("mixed") + _hash_of(F.greatest("pure", F.lit(1)))).otherwise(_hash_of(F.col("mixed"))))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(apart, F.col("mixed")).otherwise(F.col("mixed") + F.col("pure")) - 1)))
    return rows.withColumn("block_a", F.least("side", "other")).withColumn("block_b", F.greatest("side", "other"))


def _laid(rows: DataFrame, keys: list[str]) -> DataFrame:
    # comparing is more work than the rows' size tells: as many tasks as a shuffle has
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id and component_id of every row with an id and words: near copies, checked exactly.

    Rows are linked if their sets of distinct shingles (see simhash_groups) have at least that
    Jaccard similarity, or the same id; component_id is the smallest id reachable. Every link is
    checked by the whole sets. What they are checked for is proposed by shared prefixes (short
    sets) or MinHash bands, unless their SimHash fingerprints differ in more than MOST of 256 bits.
    Sets are told apart by 64-bit hashes. Ids are numbers. Texts without words (null, empty) and
    rows without an id have no row here. Repeated rows each return. No rows in, no rows out.

    Proposals only make groups. In a first pass each set of a group is shipped once, SET_BLOCK at a
    time, and one set of the group meets all. Groups up to SET_BLOCK are done then, and larger
    ones if all their sets hang together; of others the sets that don't hang with the largest part
    meet all sets of the group. With r such sets in a group of m this ships about 2 m r / SET_BLOCK sets.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    small_batches(docs.sparkSession)
    rows = materialize(texts.mapInArrow(_sign(words, similarity), SIGNED), "signed")
    nodes = materialize(rows.groupBy("node").agg(F.min("id").alias("least"), *(F.first(c).alias(c) for c in ("n", "sketch", "keys"))), "sets")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = keyed.join(keyed.groupBy("key").count().where("count > 1").select("key"), "key")
    order = ["key", "block_a", "block_b"]
    met = bounded_groups(shared.join(nodes.select("node", "n", "sketch"), "node"), ["key"], "node", BLOCK)
    proposed = _laid(met.select(*order, "side", "node", "n", "sketch"), order).mapInArrow(_proposer(similarity), "a long, b long")
    crowd = connected_components(proposed).join(nodes.select("node", "least", "n", "sketch"), "node")
    crowd = materialize(crowd, "crowd")
    whole = texts.join(crowd.select(F.col("least").alias("id")).distinct(), "id", "left_semi").select("text").mapInArrow(_sets(words), "node long, shingles binary")
    whole = materialize(whole, "shingles")
    order = ["component", "block_a", "block_b"]

    def decided(blocks: DataFrame, name: str) -> DataFrame:
        pool = blocks.join(whole, "node").select(*order, "side", "part", "node", "n", "sketch", "shingles")
        return materialize(_laid(pool, order).mapInArrow(_decider(similarity), "a long, b long"), name)

    blocks = first_blocks(crowd.select("node", "component", "n", "sketch"))
    linked = decided(blocks, "linked")
    large = materialize(blocks.where("large").select("node", "component", "n", "sketch").distinct(), "large-groups")
    if not large.isEmpty():
        hang = connected_components(linked.join(large.select(F.col("node").alias("a")), "a", "left_semi").select("a", "b")).withColumnRenamed("component", "part")
        parts = materialize(large.join(hang, "node", "left").withColumn("part", F.coalesce("part", "node")), "group-parts")
        linked = linked.union(decided(further_blocks(parts), "linked-later"))
    # rows of one id hang together too
    first = rows.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b <> last").select("id", "b")
    same = rows.select("id", F.col("node").alias("a")).join(first, "id").where("a <> b").select("a", "b")
    groups = connected_components(linked.union(same))
    named = nodes.select("node", "least").join(groups, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = named.join(smallest, "component").select("node", "component_id")
    return rows.select("id", "node").join(by_node, "node").select(F.col("id").alias("doc_id"), "component_id")
