"""Embedding near-dedup: ITQ binary codes, multi-index Hamming tables, exact cosine rerank."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType

from playbill.llm.common import Forest, bounded_groups, hash_sample, run_pairs, run_starts, whole_runs
from playbill.llm.components import connected_components
from playbill.storage import materialize

#: Vectors from which the rotations are learnt and the tables are planned: those with the smallest
#: content hashes. The bound holds at every size; every vector is coded, indexed and compared.
FIT_VECTORS = 8192
#: Share of pairs just at the threshold that the tables are planned to find.
RECALL = 0.98
#: Bits by which pairs of the sample are looked at while planning.
TRIAL_BITS = 512
#: A row in a table costs about as much as comparing so many codes.
ROW_COST = 100
BLOCK = 1024
#: With fewer vectors there is nothing to learn tables from, and comparing all is cheaper.
FEWEST = 512
#: Tables that may be planned; where so many don't find the asked share, all vectors are compared.
MOST_TABLES = 1 << 14


class Rotation:
    """Learnt rotations: code bit k is the sign of (unit vector - mean) @ matrix[:, k]."""

    def __init__(self, mean: np.ndarray, matrix: np.ndarray) -> None:
        self.mean, self.matrix = mean, matrix

    def bits(self, units: np.ndarray) -> np.ndarray:
        return ((units - self.mean) @ self.matrix) > 0


def learn_rotation(units: np.ndarray, bits: int, rounds: int = 20, seed: int = 7) -> Rotation:
    """Iterative quantisation: alternate codes = sign(V R) and the R that best maps V to the codes.

    V is the sample on its leading principal axes. Where bits exceed the dimension, further
    independently learnt rotations give the rest.
    """
    d = units.shape[1]
    mean = units.mean(axis=0) if len(units) else np.zeros(d)
    centred = units - mean
    axes = np.linalg.eigh(centred.T @ centred if len(units) else np.eye(d))[1][:, ::-1]
    parts, rng = [], np.random.default_rng(seed)
    while (have := sum(p.shape[1] for p in parts)) < bits:
        c = min(d, bits - have)
        v = centred @ axes[:, :c]
        r = np.linalg.qr(rng.standard_normal((c, c)))[0]
        for _ in range(rounds if len(units) else 0):
            left, _, right = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = (left @ right).T
        parts.append(axes[:, :c] @ r)
    return Rotation(mean, np.concatenate(parts, axis=1))


def trial_pairs(units: np.ndarray, cosine: float, most: int = 2000, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at the threshold: sample vectors turned towards others of the sample, turned anywhere, and real pairs."""
    rng = np.random.default_rng(seed)
    u = units[:most]
    pairs = []
    for away in (units[rng.permutation(len(units))][: len(u)], rng.standard_normal(u.shape)):
        away = away - (away * u).sum(axis=1, keepdims=True) * u
        size = np.sqrt((away * away).sum(axis=1, keepdims=True))
        turned = u * cosine + away / np.maximum(size, 1e-12) * np.sqrt(1 - cosine**2)
        pairs.append((u, np.where(size > 1e-9, turned, u)))
    near = u @ units.T
    i, j = np.nonzero((near >= cosine) & (near < cosine + 0.3 * (1 - cosine)))
    i, j = (x[rng.permutation(len(i))[: 4 * most]] for x in (i, j))
    return [*pairs, (u[i], units[j])] if len(i) >= 50 else pairs


def plan_tables(alike: list[np.ndarray], any_pair: np.ndarray, n: int, recall: float) -> tuple[int, int]:
    """(tables, bits of a table): the cheapest that find that share of each kind of pairs; no tables if MOST_TABLES don't.

    alike and any_pair hold for each pair the share of code bits that agree. Wider tables have
    fewer vectors an entry, so the more vectors there are the wider they get.
    """
    best = (float("inf"), 0, 1)
    for width in range(1, 31):
        hits = [q**width for q in alike]
        low, high = 0, 1
        while any((1 - (1 - h) ** high).mean() < recall for h in hits) and high <= MOST_TABLES:
            low, high = high, 2 * high
        if high > MOST_TABLES:
            break  # wider tables find less
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if any((1 - (1 - h) ** mid).mean() < recall for h in hits) else (low, mid)
        cost = high * (ROW_COST + n / 2 * float((any_pair**width).mean()))
        best = min(best, (cost, high, width))
    return best[1:]


class Index:
    """The planned tables: their rotations, how many bits a pair may differ in, and the share of trial pairs found under both.

    good says whether that share is what was asked for.
    """

    def __init__(self, sample: np.ndarray, n: int, cosine: float, recall: float = RECALL) -> None:
        pairs = trial_pairs(sample, cosine)
        trial = learn_rotation(sample, TRIAL_BITS)
        shift = max(1, len(sample) // 2)
        agree = lambda r, a, b: (r.bits(a) == r.bits(b)).mean(axis=1)
        other = agree(trial, sample, np.roll(sample, shift, axis=0)) if len(sample) > 1 else np.array([0.5])
        self.tables, self.width = plan_tables([agree(trial, a, b) for a, b in pairs], other, n, recall)
        self.recall, self.most = 0.0, 0
        while 0 < self.tables <= MOST_TABLES:  # measured with the tables' own bits
            self.rotation = learn_rotation(sample, self.tables * self.width, seed=8)
            apart = [self.rotation.bits(a) != self.rotation.bits(b) for a, b in pairs]
            far = np.concatenate([x.sum(axis=1) for x in apart])
            self.most = int(np.ceil(far.mean() + 5 * far.std()))
            self.recall = min(float(((~x.reshape(len(x), self.tables, self.width).any(axis=2)).any(axis=1) & (x.sum(axis=1) <= self.most)).mean()) for x in apart)
            if self.recall >= recall:
                break
            self.tables += -(-self.tables // 4)
        self.good = self.recall >= recall


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _coder(rotation: Rotation, tables: int, width: int, schema: pa.Schema):
    weights = (1 << np.arange(width)).astype(np.int64)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                bits = rotation.bits(_unit(_matrix(batch.column(1))))
                padded = np.zeros((len(bits), -(-tables * width // 64) * 64), bool)
                padded[:, : bits.shape[1]] = bits
                vals = pa.array((bits.reshape(len(bits), tables, width) @ weights).tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in np.packbits(padded, axis=1, bitorder="little")], pa.binary()), vals], schema=schema)

    return run


ENTRY = ["tab", "val", "block_a", "block_b"]


def _near_pairs(table: pa.Table, index_tables: int, width: int, most: int):
    """Index pairs that meet in an entry, differ in at most `most` bits and have no earlier entry in common."""
    tab, val, block_a, block_b, side = (table[c].to_numpy() for c in [*ENTRY, "side"])
    code = np.frombuffer(b"".join(table["code"].to_pylist()), "<u8").reshape(table.num_rows, -1)
    for i, j in run_pairs(run_starts(tab, val, block_a, block_b), table.num_rows):
        meet = (block_a[i] == block_b[i]) | (side[i] != side[j])
        i, j = i[meet], j[meet]
        for s in range(0, len(i), 1 << 16):
            k, m = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
            x = code[k] ^ code[m]
            near = np.bitwise_count(x).sum(axis=1) <= most
            k, m, x = k[near], m[near], x[near]
            apart = np.unpackbits(x.view(np.uint8), axis=1, bitorder="little")[:, : index_tables * width]
            first = apart.reshape(len(k), index_tables, width).any(axis=2).argmin(axis=1) == tab[k]
            yield k[first], m[first]


def _finder(tables: int, width: int, most: int):
    """The entries' nodes that have a candidate there."""
    schema = pa.schema([("tab", pa.int32()), ("val", pa.int64()), ("block_a", pa.int32()), ("block_b", pa.int32()), ("side", pa.int32()), ("node", pa.int64())])

    def run(batches):
        for table in whole_runs(batches, ENTRY, 8192):
            wanted = np.zeros(table.num_rows, bool)
            for i, j in _near_pairs(table, tables, width, most):
                wanted[i] = wanted[j] = True
            for batch in table.select(schema.names).filter(pa.array(wanted)).combine_chunks().to_batches():
                yield batch.cast(schema)

    return run


def _verifier(tables: int, width: int, most: int, min_cosine: float):
    """Exact cosines of the candidates: each node's number of links in the entry, and a spanning forest."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for table in whole_runs(batches, ENTRY, 4096):
            node, copies, units = table["node"].to_numpy(), table["copies"].to_numpy(), _unit(_matrix(table["vector"]))
            forest, found = Forest(len(node)), np.zeros(len(node), np.int64)
            for i, j in _near_pairs(table, tables, width, most):
                for s in range(0, len(i), 16_384):
                    k, m = i[s : s + 16_384], j[s : s + 16_384]
                    ok = np.einsum("ij,ij->i", units[k], units[m]) >= min_cosine
                    k, m = k[ok], m[ok]
                    forest.join(k, m)
                    np.add.at(found, k, copies[m])
                    np.add.at(found, m, copies[k])
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[forest.label[at]]), pa.array(found[at])], schema=schema)

    return run


def _all_verifier(min_cosine: float):
    """As _verifier, for blocks in which every row is compared with every other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for table in whole_runs(batches, ENTRY, 2 * BLOCK):
            node, copies, side, units = (*(table[c].to_numpy() for c in ("node", "copies", "side")), _unit(_matrix(table["vector"])))
            block_a, block_b = table["block_a"].to_numpy(), table["block_b"].to_numpy()
            forest, found = Forest(len(node)), np.zeros(len(node), np.int64)
            starts = [*run_starts(*(table[c].to_numpy() for c in ENTRY)).tolist(), len(node)]
            for at, end in zip(starts, starts[1:], strict=False):
                for s in range(at, end, 256):
                    e = min(s + 256, end)
                    k, m = np.nonzero(units[s:e] @ units[s:end].T >= min_cosine - 1e-9)
                    k, m = k + s, m + s
                    ok = (k < m) & ((block_a[k] == block_b[k]) | (side[k] != side[m]))
                    k, m = k[ok], m[ok]
                    ok = np.einsum("ij,ij->i", units[k], units[m]) >= min_cosine
                    k, m = k[ok], m[ok]
                    forest.join(k, m)
                    np.add.at(found, k, copies[m])
                    np.add.at(found, m, copies[k])
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[forest.label[at]]), pa.array(found[at])], schema=schema)

    return run


def _laid(rows: DataFrame) -> DataFrame:
    # comparing is more work than the rows' size tells: as many tasks as a shuffle has
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *ENTRY).sortWithinPartitions(*ENTRY)


def _links(nodes: DataFrame, min_cosine: float, fit_vectors: int, recall: float) -> DataFrame:
    """a, b, n: for each entry and node the number of rows linked there (n) and a node it hangs together with (b)."""
    sample = _unit(_matrix(hash_sample(nodes, fit_vectors, "rotation", "h1", "h2").select("vector").toArrow()["vector"]))
    n = nodes.count()
    index = Index(sample, n, min_cosine, recall) if n >= FEWEST else None
    if index is None or not index.good:
        whole = bounded_groups(nodes.select(F.lit(0).alias("tab"), F.lit(0).cast("long").alias("val"), "node", "copies", "vector"), ["tab", "val"], "node", BLOCK)
        return _laid(whole.select(*ENTRY, "side", "node", "copies", "vector")).mapInArrow(_all_verifier(min_cosine), "a long, b long, n long")
    shape = (index.tables, index.width)
    schema = nodes.select("node", "vector", "copies").schema.add("code", BinaryType()).add("vals", ArrayType(LongType()))
    coded = materialize(nodes.select("node", "vector", "copies").mapInArrow(_coder(index.rotation, *shape, to_arrow_schema(schema)), schema), "codes")
    keyed = coded.select("node", "code", F.posexplode("vals").alias("tab", "val"))
    entries = _laid(bounded_groups(keyed, ["tab", "val"], "node", BLOCK).select(*ENTRY, "side", "node", "code"))
    wanted = entries.mapInArrow(_finder(*shape, index.most), "tab int, val long, block_a int, block_b int, side int, node long")
    held = _laid(wanted.join(coded.drop("vals"), "node").select(*ENTRY, "side", "node", "code", "copies", "vector"))
    return held.mapInArrow(_verifier(*shape, index.most, min_cosine), "a long, b long, n long")


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = 0.9, fit_vectors: int = FIT_VECTORS, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors.

    Two rows link if their cosine, in double precision, is at least min_cosine and a table finds
    them. Tables are planned on a bounded sample (fit_vectors): as many and as wide as the cheapest
    that find the share `recall` of pairs just at min_cosine, whatever the vectors' mean; their
    width grows with the number of vectors. Where no tables do that, and with fewer than 512
    distinct vectors, all are compared, block by block. Equal vectors always link. Null, empty and zero
    vectors and those with null or non-finite components link with nothing; vectors of different
    lengths neither. Ids are numbers. Rows that repeat an id are separate rows. n_links counts
    rows; component_id is the smallest id reachable; kept says id = component_id (null ids are
    never kept nor a component's id, unless alone: then component_id is null). No rows in, no
    rows out.

    Equal vectors (told apart by 128 bits of hash) are counted once, so a hot copy costs one row.
    Tables hold ids and codes; vectors go only to entries where their codes are near another's.
    Large entries are compared block by block; only counts and a spanning forest leave a block,
    never its pairs. A pair that several tables find counts in the first alone.
    """
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vector"))
    valid = F.expr("vector is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)")
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False))).withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit("second"), "vector"))
    rows = materialize(rows, "vectors")
    nodes = rows.where("valid").groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = materialize(nodes.withColumn("dim", F.size("vector")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    parts = [_links(nodes.where(F.col("dim") == dim), min_cosine, fit_vectors, recall) for (dim,) in nodes.select("dim").distinct().toLocalIterator()]
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    if not parts:
        return alone.withColumn("kept", kept)
    found = materialize(reduce(DataFrame.union, parts).groupBy("a", "b").agg(F.sum("n").alias("n")), "links")
    groups = connected_components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    labelled = nodes.select("h1", "h2", "node", "copies", "least").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = labelled.join(smallest, "component").join(counts, F.col("node") == F.col("a"), "left").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.where("valid").select("vec_id", "h1", "h2").join(by_node, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    return linked.union(alone).withColumn("kept", kept)


def op3_embeddings(spark, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every embedding at cosine 0.9 or more."""
    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
