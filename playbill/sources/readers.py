"""Readers of landed files: JSON arrays and envelopes, XML items, whole pages; rows dealt over tasks. A missing path is an empty frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbill.schema import EVENT, conform, schema_of


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows dealt evenly over tasks, two a core by default.

    Spark reads a file by no more tasks than it has row groups: a small file whose rows cost much would keep one core busy.
    """
    return df.repartition(tasks or 2 * df.sparkSession.sparkContext.defaultParallelism)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """path, body: each file as one text."""
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, body string")
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value").alias("body"))


def json_records(spark: SparkSession, path: str, ddl: str = EVENT, split: bool = False) -> DataFrame:
    """Records of JSON array files in the given schema; a broken file, or one that holds no array, has none.

    With split a file is read by several tasks, for files that are large (see json_split; files are taken to be whole arrays).
    """
    schema = T.ArrayType(schema_of(ddl)) if ddl.startswith("struct<") else T.ArrayType(T._parse_datatype_string(f"struct<{ddl}>"))
    if split:
        from playbill.sources.json_split import json_elements

        return json_elements(spark, path).select("path", "place", F.from_json("item", schema.elementType).alias("r")).select("path", "place", "r.*")
    body = documents(spark, path).where(F.trim("body").startswith("["))
    return body.select("path", F.posexplode(F.from_json("body", schema)).alias("place", "r")).select("path", "place", "r.*")


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """path, place, item (JSON text): elements of array files, or of an object's items, events, data, posts or results."""
    body = documents(spark, path)
    listed = [F.get_json_object("body", f"$.{k}") for k in ("items", "events", "data", "posts", "results")]
    arrays = [F.when(x.rlike(r"^\s*\["), x) for x in (F.col("body"), *listed)]
    items = F.from_json(F.coalesce(*arrays), "array<string>")
    return body.select("path", F.posexplode(items).alias("place", "item")).where(F.col("item").rlike(r"^\s*\{"))


def envelope_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of {"error": "success", "data": [...]} answers; other answers have none."""
    body = documents(spark, path).where(F.get_json_object("body", "$.error") == "success")
    return body.select("path", F.posexplode(F.from_json(F.get_json_object("body", "$.data"), "array<string>")).alias("place", "item"))


def paged_items(spark: SparkSession, path: str, list_path: str = "$._embedded.events") -> DataFrame:
    """Items of a paged API's answers, one file a page; files are named in page order."""
    body = documents(spark, path)
    return body.select("path", F.posexplode(F.from_json(F.get_json_object("body", list_path), "array<string>")).alias("place", "item"))


PRODUCT = ["title", "description", "link", "id", "price", "image_link", *(f"custom_label_{i}" for i in range(9))]
RSS = ["title", "link", "description", "pubDate", "category"]


def xml_items(spark: SparkSession, path: str, fields: list[str] = PRODUCT, row_tag: str = "item") -> DataFrame:
    """Rows of an XML feed as text columns, blank where absent; namespace prefixes are ignored, broken rows skipped.

    path, block and place order rows as the files have them: the file, where its part begins, and
    a number that rises within the part.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("path", T.StringType()), T.StructField("block", T.LongType()), T.StructField("place", T.LongType()), *schema.fields]))
    raw = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).option("mode", "DROPMALFORMED").schema(schema).load(path)
    at = (F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    return raw.select(*at, *(F.coalesce(F.trim(f), F.lit("")).alias(f) for f in fields))


def events(spark: SparkSession, path: str) -> DataFrame:
    """Normalized events that a provider's sink has written."""
    return conform(json_records(spark, path, EVENT), EVENT, ("path", "place"))
