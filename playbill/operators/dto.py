"""The flat upload rows: one for each event, occurrence and source."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.functions.prices import price_range

EVENT_FIELDS = ["title", "description", "type", "city_name", "image_url", "attraction_id", "attraction_upcoming_count", "performer_name", "organizer_name", "provider", "providers", "provider_tags", "provider_label", "source_urls", "category", "address", "latitude", "longitude", "fetched_at"]
OCCURRENCE_FIELDS = ["start_at_utc", "local_date", "local_time", "local_end_time", "timezone", "venue_name", "district"]
SOURCE_FIELDS = ["external_id", "source_url", "deep_link_url", "ticket_status", "ticket_url", "sales_start_at", "brand_name", "is_official_seller"]
#: Fields that the receiver also reads by their plain names.
TWICE = ["provider_tags", "provider_label", "source_urls", "ticket_url"]


def camel(name: str) -> str:
    return re.sub(r"_(\w)", lambda m: m[1].upper(), name)


def upload_rows(events: DataFrame, run_id: str) -> DataFrame:
    """camelCase columns; prices fall back to the amounts of the price text. Events without sources have no row."""
    flat = events.select("ordinal", *EVENT_FIELDS, F.posexplode("occurrences").alias("occurrence_index", "o"))
    flat = flat.select("*", F.posexplode("o.sources").alias("source_index", "s")).withColumn("parsed", price_range(F.col("s.price.text")))
    fields = {c: F.col(c) for c in EVENT_FIELDS} | {c: F.col(f"o.{c}") for c in OCCURRENCE_FIELDS} | {c: F.col(f"s.{c}") for c in SOURCE_FIELDS}
    fields |= {
        "source_provider": F.col("s.provider"), "source_title": F.col("s.title"), "source_description": F.col("s.description"),
        "min_price": F.coalesce("s.price.min_value", "parsed.min"), "max_price": F.coalesce("s.price.max_value", "parsed.max"),
        "price_text": F.col("s.price.text"), "currency": F.col("s.price.currency"), "is_free": F.col("s.price.is_free"), "sync_run_id": F.lit(run_id),
    }
    return flat.select("ordinal", "occurrence_index", "source_index", *(c.alias(camel(n)) for n, c in fields.items()), *(fields[n].alias(n) for n in TWICE if camel(n) != n))
