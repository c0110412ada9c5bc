"""A corpus pipeline of five stages; each takes and (but the last) returns the columns of documents.

1. quality: documents that the co-trained classifier rejects go.
2. lines: lines in at least ten of the documents go; n_chars is counted anew.
3. near copies: of documents linked by Jaccard similarity, one stays, the smallest id.
4. benchmark: documents that hold a benchmark item go.
5. packing: what is left is packed into windows of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.storage import materialize, scratch
from playbill.llm.decontaminate import contamination
from playbill.llm.line_dedup import dedup_lines
from playbill.llm.near_copies import near_copies
from playbill.llm.packing import pack
from playbill.llm.quality import score_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies: sets of distinct five-word shingles of Jaccard similarity 0.8, checked exactly.
WORDS, SIMILARITY = 5, 0.8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on these documents' labels, keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels, keep_columns=COLUMNS).where("keep").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that at least ten documents have; a text may become empty but its row stays."""
    return dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; its repeated rows all stay.

    Texts without words are no copies of each other's; rows without an id all stay.
    """
    groups = near_copies(docs, words=WORDS, similarity=SIMILARITY)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    held = materialize(found.select("doc_id").distinct(), "contaminated")
    return docs.join(held, "doc_id", "left_anti").select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 4096 ids."""
    return pack(docs, scratch(spark, "packing"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: The classifier and the packing plan have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
