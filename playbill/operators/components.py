"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.storage import discard, materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of edges (a, b); component is its smallest node.

    Nodes are longs. Self-loops, repeated and reversed edges are allowed; null ends are ignored.
    Each round is written to the shared folder. Minimums are combined before the shuffle, so a
    node with very many edges costs no single task; its rows in the join are split by AQE.
    """
    clean = edges.where("a is not null and b is not null and a <> b")
    edges = materialize(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(rounds if mark[0] else 0):
        large = _large_star(edges)
        after = materialize(_small_star(large), "edges")
        discard(edges)
        edges, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    else:
        if mark[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
