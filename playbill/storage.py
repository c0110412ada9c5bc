"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only where the session names no shared folder, as in tests on one machine.
LOCAL_SCRATCH = "/tmp/checkpoints/playbill"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir), as a full URI.

    Without that setting a local folder is used where driver and executors are one process; on a
    cluster it would scatter the data over machines, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = spark._jvm.org.apache.hadoop.fs.Path(shared or f"file://{LOCAL_SCRATCH}")
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    base = f"{full.getScheme()}://{full.getAuthority() or ''}{full.getPath()}"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that materialize() wrote and that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
