"""The record model: an event has dated occurrences, an occurrence has the offers of its sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_RESOLUTION = "struct<strategy:string,confidence:double,legal_mode:string,source:string,is_authoritative:boolean,is_derived:boolean,requires_terms_review:boolean,note:string>"
PRICE = f"struct<min_value:double,max_value:double,text:string,currency:string,is_free:boolean,is_unknown:boolean,resolution:{PRICE_RESOLUTION}>"
SOURCE = (
    f"struct<provider:string,external_id:string,title:string,description:string,source_url:string,deep_link_url:string,price:{PRICE},"
    "ticket_status:string,ticket_url:string,sales_start_at:timestamp,brand_name:string,is_official_seller:boolean>"
)
OCCURRENCE = (
    "struct<start_at_utc:timestamp,local_date:string,local_time:string,local_end_time:string,timezone:string,"
    f"venue_name:string,district:string,sources:array<{SOURCE}>>"
)
EVENT = (
    "struct<title:string,description:string,type:string,city_name:string,image_url:string,"
    f"occurrences:array<{OCCURRENCE}>,"
    "attraction_id:string,attraction_upcoming_count:int,performer_name:string,organizer_name:string,source:string,provider:string,"
    "providers:array<string>,provider_tags:array<string>,provider_label:string,source_urls:array<string>,external_id:string,"
    "category:string,address:string,venue:string,link:string,source_url:string,ticket_info:string,ticket_url:string,"
    "thumbnail_url:string,latitude:double,longitude:double,fetched_at:timestamp>"
)
PLACE = "struct<title:string,address:string,place_id:string,latitude:double,longitude:double,rating:double,reviews:long,phone:string,hours:string,thumbnail:string,link:string>"


def schema_of(ddl: str) -> T.StructType:
    """The StructType of one of the struct texts above."""
    return T._parse_datatype_string(ddl)


def conform(df: DataFrame, ddl: str = EVENT, extra: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """df with exactly the columns of ddl, in order, absent ones null; `extra` columns that df has come first."""
    own = set(df.columns)
    made = [(F.col(f.name) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema_of(ddl).fields]
    return df.select(*[c for c in extra if c in own], *made)


def number_rows(df: DataFrame, *order: str, name: str = "ordinal") -> DataFrame:
    """Give rows their place in the given order, from 0, without bringing them to one task.

    Rows are range-partitioned, sorted and written once with their partition and their place in
    it; each written partition's count, one number a partition, gives the partitions their
    offsets. Nothing is evaluated twice, so neither new range bounds nor partitions that adaptive
    execution merges can move a row. Rows that the order doesn't tell apart are numbered in any
    order. The order's columns may be any that Spark sorts; nulls come first.
    """
    from playbill.storage import materialize

    part, at = fresh(df, "part"), fresh(df, "at")
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = materialize(laid.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "numbered")
    counts = sorted((r[0], r[1]) for r in laid.groupBy(part).count().collect())
    base, total = {}, 0
    for p, n in counts:
        base[p], total = total, total + n
    offsets = df.sparkSession.createDataFrame(list(base.items()), f"{part} int, _base long")
    start = fresh(df, "base")
    return laid.join(F.broadcast(offsets.withColumnRenamed("_base", start)), part).select(*(F.col(f"`{c}`") for c in df.columns if c != name), (F.col(start) + F.col(at)).alias(name))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name in taken:
        name = f"_{name}"
    return name
