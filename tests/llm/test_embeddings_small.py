"""Embedding links on tables too small, or too unlike their sample, for tables of codes."""

import numpy as np
import pytest

from playbill.llm import embeddings


def brute(vectors, cosine):
    x = np.array(vectors, float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = list(range(len(x)))
    for _ in x:
        for i, j in zip(*np.nonzero(near)):
            label[i] = min(label[i], label[j])
    return {i: (int(near[i].sum()), label[i], label[i] == i) for i in range(len(x))}


def found(spark, vectors, **options):
    rows = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>")
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.embedding_groups(rows, **options).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_few_vectors(spark, n):
    rng = np.random.default_rng(n)
    u = rng.standard_normal(32)
    vectors = [u + 0.2 * rng.standard_normal(32) * k for k in range(n)]
    assert found(spark, vectors) == brute(vectors, 0.9)
    if n == 2:
        v = rng.standard_normal(32)
        v -= v @ u / (u @ u) * u
        pair = [u / np.linalg.norm(u), 0.95 * u / np.linalg.norm(u) + np.sqrt(1 - 0.95**2) * v / np.linalg.norm(v)]
        assert found(spark, pair) == {0: (1, 0, True), 1: (1, 0, False)}


def test_all_compared_where_tables_do_not_do(spark, monkeypatch):
    """More vectors than a block, and no number of tables allowed: exact all the same."""
    monkeypatch.setattr(embeddings, "MOST_TABLES", 0)
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((150, 16))
    vectors = [centres[k % 150] + 0.25 * rng.standard_normal(16) for k in range(1500)]
    want = brute(vectors, 0.9)
    assert sum(n for n, _, _ in want.values()) > 3000
    assert found(spark, vectors) == want


def test_index_counts_what_its_limit_of_bits_loses():
    rng = np.random.default_rng(7)
    sample = rng.standard_normal((1000, 24))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    index = embeddings.Index(sample, 100_000, 0.9)
    assert index.good and index.recall >= embeddings.RECALL
