"""Feeds landed in their own formats from the test tables, read and built into events, against SQL on the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.plans.queries import query
from playbill.plans.source_queries import _text
from playbill.sources import builders, dims, json_split, paged, readers
from playbill.storage import scratch

AS_OF = "2026-06-01 00:00:00"


def _shown(events: DataFrame) -> DataFrame:
    """The columns by which events are compared: those of the first occurrence and its first source too."""
    first = F.get("occurrences", 0)
    source = F.get(first["sources"], 0)
    return events.select("external_id", "title", "type", "city_name", "description", first["local_date"].alias("day"), first["local_time"].alias("clock"), first["venue_name"].alias("hall"), source["price"]["min_value"].alias("low"), source["source_url"].alias("url"))


def _pick(key: str, *values: str | Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) if isinstance(v, str) else v for v in values)), (F.col(key) % len(values)).cast("int") + 1)


@query(
    """
select p_partkey::varchar as external_id, p_name as title, case when p_partkey % 4 = 0 then 'kids' when p_partkey % 5 < 3 then 'theatre' else 'concert' end as type,
       ['İstanbul', 'Ankara'][p_partkey % 3 + 1] as city_name, 'about ' || p_brand || ' & ç' as description, '2026-07-' || lpad((p_partkey % 28 + 1)::varchar, 2, '0') as day,
       case when p_partkey % 2 = 0 then '00:00' else '20:30' end as clock, case when p_partkey % 7 = 0 then p_name else 'Salon ' || p_brand end as hall, p_size::double as low, 'https://www.biletinial.com/tr/' || p_partkey as url
from part where p_partkey % 3 < 2 and (p_partkey % 4 = 0 or p_partkey % 5 > 0) and p_partkey % 11 > 0
"""
)
def product_feed_events(t, spark):
    """Parts as an XML product feed; unknown cities and categories, other hosts and past dates go."""
    key = F.col("p_partkey").cast("string")
    day = F.when(F.col("p_partkey") % 11 == 0, "2020-01-01").otherwise(_text("2026-07-", F.lpad((F.col("p_partkey") % 28 + 1).cast("string"), 2, "0")))
    rows = t("part").select(
        F.col("p_name").alias("title"), _text("https://www.biletinial.com/tr/", key).alias("link"), _text(F.col("p_name"), " - about ", F.col("p_brand"), " &amp; &ccedil;").alias("description"),
        key.alias("id"), F.col("p_size").cast("string").alias("price"), F.lit("https://i/x.jpg").alias("image_link"), _pick("p_partkey", "istanbul-avrupa", "ankara", "nowhere").alias("custom_label_0"), day.alias("custom_label_1"),
        F.when(F.col("p_partkey") % 4 == 0, "cocuk-tiyatrosu").otherwise("").alias("custom_label_2"), _pick("p_partkey", "spor", "tiyatro", "tiyatro", "muzik", "muzik").alias("custom_label_3"),
        _pick("p_partkey", "", "20:30").alias("custom_label_5"), F.when(F.col("p_partkey") % 7 == 0, "").otherwise(_text("Salon ", F.col("p_brand"))).alias("custom_label_7"),
    )
    path = scratch(spark, "feed")
    readers.spread(rows).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return _shown(builders.from_product_feed(readers.xml_items(spark, path), AS_OF, "biletinial.com", "7"))


@query(
    """
select 'C' || c_custkey as external_id, c_name as title, 'concert' as type, ['Ankara', 'İstanbul'][c_custkey % 3 + 1] as city_name, 'ç ' || c_mktsegment as description,
       '2026-07-' || lpad((c_custkey % 28 + 1)::varchar, 2, '0') as day, '20:00' as clock, 'Arena ' || c_nationkey as hall, (c_custkey % 50 + 10)::double as low, 'https://t.example/' || c_custkey as url
from customer where c_custkey % 3 < 2
"""
)
def ticketing_events(t, spark):
    """Customers as a ticketing API's pages by segment, some listed again in a last segment; the first of each id is built."""
    c = t("customer")
    day = _text("2026-07-", F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"))
    start = F.when(F.col("c_custkey") % 2 == 0, F.struct(day.alias("localDate"), F.lit("20:00:00").alias("localTime"), F.lit(None).cast("string").alias("dateTime"))).otherwise(F.struct(day.alias("localDate"), F.lit(None).cast("string").alias("localTime"), _text(day, "T17:00:00Z").alias("dateTime")))
    venue = F.struct(_text("Arena ", F.col("c_nationkey").cast("string")).alias("name"), F.struct(_pick("c_custkey", "Ankara", "Istanbul", "Paris").alias("name")).alias("city"))
    low = (F.col("c_custkey") % 50 + 10).cast("int")

    def item(name: Column) -> Column:
        return F.to_json(F.struct(
            _text("C", F.col("c_custkey").cast("string")).alias("id"), name.alias("name"), _text("https://t.example/", F.col("c_custkey").cast("string")).alias("url"), _text("&ccedil;  ", F.col("c_mktsegment")).alias("info"),
            F.struct(start.alias("start")).alias("dates"), F.array(F.struct(low.alias("min"), (low + 5).alias("max"), F.lit("TRY").alias("currency"))).alias("priceRanges"),
            F.array(F.struct(F.struct(F.lit("Music").alias("name")).alias("segment"))).alias("classifications"), F.struct(F.array(venue).alias("venues")).alias("_embedded"),
        ))

    listed = c.select(F.lit("TR").alias("country"), F.col("c_mktsegment").alias("segment"), day.alias("day"), "c_custkey", item(F.col("c_name")).alias("item"))
    again = c.where("c_custkey % 10 = 0").select(F.lit("TR"), F.lit("ZZ"), day, "c_custkey", item(F.lit("listed again")))
    path = scratch(spark, "discovery")
    paged.land_pages(listed.union(again), path, 50, "day", "c_custkey")
    return _shown(builders.from_ticketing_api(readers.spread(paged.discovery_items(spark, path)).withColumn("path", F.concat_ws("/", "segment", "page"))))


@query(
    f"""
select s_suppkey::varchar as external_id, s_name || ' & Co' as title, 'gosteri' as type, case when s_suppkey % 3 = 0 then 'İzmir' when s_suppkey % 3 = 1 then 'Ankara' else '{dims.DEFAULT_CITY}' end as city_name,
       'satır ü' || chr(10) || s_name as description, '2026-07-' || lpad((s_suppkey % 28 + 1)::varchar, 2, '0') as day, '21:15' as clock, 'Salon' as hall, case when s_suppkey % 4 > 0 then (s_suppkey % 40)::double + 0.5 end as low,
       case when s_suppkey % 2 = 0 then 'https://b.example/' || s_suppkey else 'https://api.example' end as url
from supplier where s_suppkey % 9 > 0
"""
)
def partner_events(t, spark):
    """Suppliers as a partner's JSON arrays, read in parts; past ones go, cities come from the field, the address, or by default."""
    key = F.col("s_suppkey").cast("string")
    when = F.when(F.col("s_suppkey") % 9 == 0, "2020-01-01 21:15").otherwise(_text("2026-07-", F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0"), " 21:15:00"))
    item = F.struct(
        key.alias("id"), _text(F.col("s_name"), " &amp;amp; Co").alias("etkinlik"), when.alias("baslangic"), _pick("s_suppkey", "", "Merkez, Ankara", "uzak").alias("adres"), F.lit(" Salon ").alias("konum"), _pick("s_suppkey", "İzmir", "", "").alias("sehir"),
        F.lit("Gosteri").alias("kategori"), F.when(F.col("s_suppkey") % 4 > 0, _text((F.col("s_suppkey") % 40).cast("string"), ",5 TL")).otherwise("sorunuz").alias("fiyat"), _pick("s_suppkey", _text("https://b.example/", key), F.lit("")).alias("url"),
        _text("sat%C4%B1r%20&uuml;%3Cbr%3E", F.col("s_name")).alias("detay"),
    )
    path = scratch(spark, "partner")
    json_split.land_arrays(t("supplier").select(F.to_json(item)), path)
    return _shown(builders.from_partner_api(json_split.json_elements(spark, path), AS_OF, "https://api.example"))


@query(
    """
select 'rss-' || substr(sha256('https://r.example/' || p_partkey), 1, 16) as external_id, p_name || ' Konseri ö' as title, 'concert' as type, 'İstanbul' as city_name, 'Giriş ' || (p_partkey % 50 + 1) || ' TL ç' as description,
       strftime(date '2026-06-01' + (p_partkey % 90)::integer, '%Y-%m-%d') as day, '20:00' as clock, 'Park ' || p_brand as hall, (p_partkey % 50 + 1)::double as low, 'https://r.example/' || p_partkey as url
from part where p_partkey % 90 < 60
"""
)
def rss_events(t, spark):
    """Parts as RSS items with entities in titles and texts, within the look-ahead."""
    key = F.col("p_partkey").cast("string")
    day = F.date_add(F.lit("2026-06-01").cast("date"), (F.col("p_partkey") % 90).cast("int"))
    rows = t("part").select(
        _text(F.col("p_name"), "  Konseri &ouml;").alias("title"), _text("https://r.example/", key).alias("link"), _text("<p><b>Giri&#351;</b> ", (F.col("p_partkey") % 50 + 1).cast("string"), " TL &ccedil;</p>").alias("description"),
        F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 17:00:00 +0000")).alias("pubDate"), F.lit("x").alias("category"), _text("Park ", F.col("p_brand")).alias("venue"),
    )
    return _shown(builders.from_rss(readers.spread(rows), "İstanbul", 60, AS_OF))
