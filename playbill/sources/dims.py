"""Small dimensions: provinces and their other names, sites, queries. A few hundred rows at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.functions.columns import col, lookup
from playbill.functions.text import ascii_fold, normalize_for_match
from playbill.functions.urls import host_of

# The provinces, other names of places in them, and the query templates of a city's search.
PROVINCES = [
    "Adana", "Adıyaman", "Afyonkarahisar", "Ağrı", "Aksaray", "Amasya", "Ankara", "Antalya", "Ardahan", "Artvin", "Aydın", "Balıkesir",
    "Bartın", "Batman", "Bayburt", "Bilecik", "Bingöl", "Bitlis", "Bolu", "Burdur", "Bursa", "Çanakkale", "Çankırı", "Çorum", "Denizli",
    "Diyarbakır", "Düzce", "Edirne", "Elazığ", "Erzincan", "Erzurum", "Eskişehir", "Gaziantep", "Giresun", "Gümüşhane", "Hakkari", "Hatay",
    "Iğdır", "Isparta", "İstanbul", "İzmir", "Kahramanmaraş", "Karabük", "Karaman", "Kars", "Kastamonu", "Kayseri", "Kilis", "Kırıkkale",
    "Kırklareli", "Kırşehir", "Kocaeli", "Konya", "Kütahya", "Malatya", "Manisa", "Mardin", "Mersin", "Muğla", "Muş", "Nevşehir", "Niğde",
    "Ordu", "Osmaniye", "Rize", "Sakarya", "Samsun", "Şanlıurfa", "Siirt", "Sinop", "Şırnak", "Sivas", "Tekirdağ", "Tokat", "Trabzon",
    "Tunceli", "Uşak", "Van", "Yalova", "Yozgat", "Zonguldak",
]
OTHER_NAMES = {
    "bodrum": "Muğla", "marmaris": "Muğla", "fethiye": "Muğla", "izmit": "Kocaeli", "adapazari": "Sakarya", "antakya": "Hatay",
    "iskenderun": "Hatay", "kapadokya": "Nevşehir", "cappadocia": "Nevşehir", "urfa": "Şanlıurfa", "afyon": "Afyonkarahisar",
    "istanbul avrupa": "İstanbul", "istanbul anadolu": "İstanbul", "kibris": "Kıbrıs",
}
UNKNOWN_CITY, DEFAULT_CITY = "Bilinmeyen Şehir", "İstanbul"

_PLAIN = str.maketrans("çğıöşüâîûÇĞİIÖŞÜ", "cgiosuaiuCGiiOSU")


def _folded(name: str) -> str:
    return name.translate(_PLAIN).lower()


CITY_KEYS = {_folded(p): p for p in PROVINCES} | OTHER_NAMES


def city(name: Column | str) -> Column:
    """The province of a name, slug or district; null if it is none."""
    key = F.trim(F.regexp_replace(normalize_for_match(F.regexp_replace(col(name), "-+", " ")), " +", " "))
    return lookup(key, CITY_KEYS)


def city_in_address(address: Column | str, default: Column | None = None) -> Column:
    """The province a comma- or slash-separated address names: its last segment that is one, else its first such word."""
    parts = F.split(F.coalesce(col(address), F.lit("")), r"[,/\-]")
    named = F.filter(F.transform(F.reverse(parts), city), lambda c: c.isNotNull())
    words = F.filter(F.transform(F.split(ascii_fold(F.coalesce(col(address), F.lit("")), dotless=False), r"[^a-z]+"), lambda w: lookup(w, CITY_KEYS)), lambda c: c.isNotNull())
    return F.coalesce(F.get(named, 0), F.get(words, 0), *([default] if default is not None else []))


QUERY_TEMPLATES = {
    "concert": "konser {city}", "theater": "tiyatro {city}", "cinema": "sinema {city}", "art": "sergi {city}", "standup": "stand up {city}",
    "festival": "festival {city}", "sports": "spor etkinlikleri {city}", "workshop": "workshop {city}", "experience": "etkinlik {city}", "family": "çocuk etkinlikleri {city}",
}


def queries(spark: SparkSession, cities: list[str]) -> DataFrame:
    """category, city, query: every template for every city, a small product of two lists."""
    t = spark.createDataFrame(list(QUERY_TEMPLATES.items()), "category string, template string")
    c = spark.createDataFrame([(x,) for x in cities], "city string")
    return t.crossJoin(c).select("category", "city", F.replace("template", F.lit("{city}"), F.col("city")).alias("query"))


# How a site's pages are read, by kind of source.
FEED_KINDS = {"kultursanat": "windows", "ataturkkitapligi": "dated_links", "wp-json": "posts"}


def feed_sources(spark: SparkSession, urls: str) -> DataFrame:
    """position, url, kind of a comma-separated list of feeds; only http links stay."""
    rows = spark.createDataFrame([(urls,)], "urls string").select(F.posexplode(F.split("urls", ",")).alias("position", "url")).withColumn("url", F.trim("url"))
    kind = F.lit("rss")
    for part, name in FEED_KINDS.items():
        kind = F.when(F.contains(F.lower("url"), F.lit(part)), F.lit(name)).otherwise(kind)
    return rows.where("url like 'http%'").withColumn("kind", kind)


SITE = "site string, base_url string, list_urls array<string>, strategy string, requires_detail boolean"


def sites(spark: SparkSession, rows: list[tuple[str, str, list[str], str, bool]]) -> DataFrame:
    """The site dimension with its order and the pages to read."""
    numbered = [(i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(numbered, "site_rank int, " + SITE).select("*", F.posexplode("list_urls").alias("page_rank", "url")).withColumn("host", host_of("url"))
