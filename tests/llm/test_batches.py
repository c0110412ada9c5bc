"""Batches of long texts that go to Python are bounded in bytes."""

import pytest

import corpus_pipeline
from playbill.llm import common, decontaminate, line_dedup, near_copies, packing, quality


@pytest.mark.parametrize("held, bound", [("64m", common.BATCH_BYTES), ("1m", 1 << 20)])
def test_limit_is_only_lowered(spark, held, bound):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, held)
        common.small_batches(spark)
        sizes = spark.range(0, 6000, 1, 1).selectExpr("id", "repeat('x', 4000) as text").mapInArrow(_sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in sizes) == 6000 and max(r.bytes for r in sizes) <= bound + 5000
    finally:
        spark.conf.set(name, before)


def _sizes(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])


def test_stages_ask_for_it(spark, sf, monkeypatch, tmp_path):
    asked = []
    for module in (quality, line_dedup, near_copies, decontaminate, packing):
        monkeypatch.setattr(module, "small_batches", lambda session, m=module: asked.append(m))
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf)
    assert asked == [quality, line_dedup, near_copies, decontaminate, packing]
