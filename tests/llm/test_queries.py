"""The registered queries: SQL where there is one, accuracy or invariants elsewhere, and the pipeline's stages."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.test_entry import check


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_equals_sql(spark, sf, name):
    check(spark, sf, name)


def test_quality_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = entry.queries()["op6_quality"](spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(scored, on="doc_id")
    assert len(scored) == 1000
    assert (labels.keep == (labels.quality == 1)).mean() > 0.95
    assert labels[labels.quality == 1].keep.mean() > 0.97


def test_quality_on_held_out_labels(spark):
    """Fitted on about 280 labelled documents; judged on those whose labels it hasn't seen."""
    from playbill.llm import quality

    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    some = labels.where("pmod(xxhash64(doc_id), 10) < 7")
    rest = labels.join(some, "doc_id", "left_anti").toPandas().merge(quality.score_quality(docs, some, keep_columns=("doc_id",)).toPandas(), on="doc_id")
    assert len(rest) > 100 and (rest.keep == (rest.quality == 1)).mean() > 0.95
    assert rest[rest.quality == 1].keep.mean() > 0.95


def test_licenses_found(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    got = {(r.doc_id, r.family) for r in entry.queries()["op10_licenses"](spark, sf).collect()}
    signs = {"Apache-2.0": "Apache License", "MIT": "MIT License", "GPL": "GNU General", "CC-BY-NC": "CC BY-NC", "proprietary": "All rights reserved."}
    assert got == {(d, f) for f, s in signs.items() for d in docs[docs.text.str.contains(s, regex=False)].doc_id}


def test_benchmark_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").toPandas() for t in ("documents", "benchmark"))
    verbatim = {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, x in zip(items.item_id, items.text) if x in t}
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op4_decontamination"](spark, sf).collect()}
    assert verbatim and verbatim <= got


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        held[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in held.items()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    for a, b in zip(names, names[1:]):
        assert ids[b] <= ids[a]
    assert ids[names[0]] == ids[names[1]] and ids[names[3]] == ids[names[4]]
    assert len(ids[names[2]]) < len(ids[names[1]]) and len(ids[names[3]]) < len(ids[names[2]])
    texts = [r.text for r in held[names[2]].select("text").collect() if r.text.strip()]
    assert len(texts) == len(set(texts))
