"""From staged rows to events: one function for each kind of source, all ending in the one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.functions import html as H
from playbill.functions import prices as P
from playbill.functions import rules, text, urls
from playbill.functions.columns import filled, first_filled
from playbill.functions.dates import ZONE, feed_instant, iso, local_date, local_time, local_to_utc, near_time, search_instant
from playbill.operators.dedup import first_by
from playbill.operators.filters import future, not_past, required, structural_title
from playbill.schema import EVENT, OCCURRENCE, PRICE, SOURCE, conform
from playbill.sources import dims

# Names and texts of the sources.
NO_VENUE, UNSTATED_VENUE, CITY_VENUE = "Mekan bilgisi yok", "Belirtilmedi", "Resmi Belediye Etkinlik Kaynagi"
ONGOING = "2099-12-31"
AFFILIATE = {"utm_source": "affiliate", "utm_medium": "affiliate-partner", "utm_campaign": "buy-ticket"}


def struct_of(ddl: str, **fields: Column | object) -> Column:
    """A struct of the given type; absent fields are null."""
    from playbill.schema import schema_of

    made = []
    for f in schema_of(ddl).fields:
        v = fields.get(f.name)
        made.append((v if isinstance(v, Column) else F.lit(v)).cast(f.dataType).alias(f.name))
    return F.struct(*made)


def occurrence_at(start: Column, **fields) -> Column:
    return struct_of(OCCURRENCE, start_at_utc=start, local_date=local_date(start), local_time=local_time(start), timezone=ZONE, **fields)


def finish(df: DataFrame, order: list[str], **fields: Column | object) -> DataFrame:
    """Rows with the event columns set, in the schema, keeping the order's columns for numbering."""
    made = df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *((v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()))
    return conform(made, EVENT, tuple(f"_o{i}" for i in range(len(order))))


def _as_read(items: DataFrame, *otherwise: str) -> list[str]:
    """The columns that order rows as their files have them, if the reader gave them."""
    order = [c for c in ("path", "block", "place") if c in items.columns]
    return order if "place" in order else list(otherwise)


def from_product_feed(items: DataFrame, as_of: str, domain: str, affiliate_id: str) -> DataFrame:
    """Events of XML product rows (readers.xml_items), in the feed's order.

    Rows without title, id, known category, known city, readable date, or link on the domain go,
    and so do past ones.
    """
    start = local_to_utc(F.try_to_timestamp(F.concat_ws(" ", "custom_label_1", F.when(F.col("custom_label_5") == "", "00:00").otherwise(F.col("custom_label_5"))), F.lit("yyyy-MM-dd HH:mm")))
    rows = items.withColumn("type", rules.feed_type("custom_label_3", "custom_label_2")).withColumn("city", dims.city("custom_label_0")).withColumn("start", start)
    rows = rows.where(required("title", "id") & F.col("type").isNotNull() & F.col("city").isNotNull() & urls.host_in("link", domain) & urls.is_link("link") & not_past("start", F.lit(as_of).cast("timestamp")))
    venue = F.coalesce(filled("custom_label_7"), F.col("title"))
    about = filled(text.strip_title_prefix(text.strip_html("description"), "title"))
    p = P.feed_price("price")
    price = struct_of(PRICE, min_value=p["min"], max_value=p["min"], currency="TRY", is_free=p["is_free"], is_unknown=p["is_unknown"], text=P.price_text(p["min"], p["min"], F.lit("TRY")))
    source = struct_of(SOURCE, provider="Biletinial", external_id=F.col("id"), title=F.col("title"), description=about, source_url=F.col("link"), ticket_url=urls.set_params("link", {**AFFILIATE, "a_aid": affiliate_id}), price=price, ticket_status="on_sale", brand_name="Biletinial", is_official_seller=True)
    return finish(
        rows, _as_read(items, "id"), title=F.col("title"), description=about, type=F.col("type"), category=F.col("type"), city_name=F.col("city"), image_url=filled("image_link"),
        occurrences=F.array(occurrence_at(F.col("start"), venue_name=venue, sources=F.array(source))), source="Biletinial", providers=F.array(F.lit("Biletinial")),
        provider_label="Biletinial", external_id=F.col("id"), venue=venue, performer_name=text.performer("title"), organizer_name="Biletinial",
    )


def from_ticketing_api(items: DataFrame, abouts: DataFrame | None = None) -> DataFrame:
    """Events of a ticketing API's items (item: JSON text, with path and place), the first of each id.

    Field names of the feed and of the API are both read. abouts: optional url, about for pages
    whose text fills an empty description.
    """
    j = lambda *paths: H.first_json("item", *paths)
    venue = "$._embedded.venues[0]"
    day, clock = j("$.eventStartLocalDate", "$.dates.start.localDate"), F.coalesce(j("$.eventStartLocalTime", "$.dates.start.localTime"), F.lit("00:00:00"))
    local = local_to_utc(F.try_to_timestamp(F.concat_ws(" ", day, F.substring(clock, 1, 5)), F.lit("yyyy-MM-dd HH:mm")))
    images = F.from_json(F.get_json_object("item", "$.images"), "array<struct<url:string,width:long>>")
    segment = j("$.classificationSegment", "$.classifications[0].segment.name")
    kinds = F.concat_ws(" ", segment, j("$.classificationGenre", "$.classifications[0].genre.name"), j("$.classificationSubGenre", "$.classifications[0].subGenre.name"))
    rows = items.select(
        "path", "place", j("$.eventId", "$.id").alias("id"), text.clean_text(j("$.eventName", "$.name")).alias("title"),
        F.coalesce(j("$.primaryEventUrl"), j("$.eventUrl", "$.url")).alias("link"), dims.city(j("$.venue.venueCity", f"{venue}.city.name", "$.venueCity")).alias("city"),
        F.coalesce(iso(j("$.eventStartDateTime", "$.dates.start.dateTime")), local).alias("start"),
        text.clean_text(j("$.eventInfo", "$.info", "$.description")).alias("info"), H.widest_image(images).alias("image"), F.coalesce(j("$.eventImageUrl"), H.widest_image(images)).alias("best_image"),
        rules.segment_type(j("$.eventName", "$.name"), F.nullif(F.lower(segment), F.lit("undefined")), kinds).alias("type"), j("$.venue.venueName", f"{venue}.name").alias("venue"),
        j("$.eventStatus", "$.dates.status.code").alias("status"), iso(j("$.onsaleStartDateTime", "$.sales.public.startDateTime")).alias("sales_start"),
        P.stated_price(j("$.minPrice", "$.priceRanges[0].min"), j("$.maxPrice", "$.priceRanges[0].max"), "api", 0.98, "official_api", j("$.currency", "$.priceRanges[0].currency")).alias("price"),
        j("$.attractions[0].attraction.attractionName", "$._embedded.attractions[0].name").alias("attraction"), j("$.attractions[0].attraction.attractionId", "$._embedded.attractions[0].id").alias("attraction_id"),
        j("$._embedded.attractions[0].upcomingEvents._total").cast("int").alias("upcoming"), j("$.promoters[0].promoter.promoterName", "$.promoter.name").alias("promoter"),
    )
    rows = first_by(rows.where(required("id", "title") & urls.is_link("link") & F.col("city").isNotNull() & F.col("start").isNotNull()), ["id"], "path", "place")
    about = F.lit(None).cast("string")
    if abouts is not None:
        rows = rows.join(abouts.select(F.col("url").alias("link"), F.col("about").alias("_about")), "link", "left")
        about = F.col("_about")
    described = text.resolve_description("info", about, "")
    source = struct_of(SOURCE, provider="Ticketmaster", external_id=F.col("id"), title=F.col("title"), source_url=F.col("link"), ticket_url=urls.provider_link("Ticketmaster", "link"), price=F.col("price"), ticket_status=F.coalesce("status", F.lit("unknown")), sales_start_at=F.col("sales_start"))
    return finish(
        rows, ["path", "place"], title=F.col("title"), description=described, type=F.col("type"), city_name=F.col("city"), image_url=F.col("best_image"),
        occurrences=F.array(occurrence_at(F.col("start"), venue_name=F.coalesce("venue", F.lit(NO_VENUE)), sources=F.array(source))), source="Ticketmaster", providers=F.array(F.lit("Ticketmaster")),
        external_id=F.col("id"), attraction_id=F.col("attraction_id"), attraction_upcoming_count=F.col("upcoming"), performer_name=F.col("attraction"), organizer_name=F.col("promoter"),
    )


ACTIVITY = (
    "struct<activity:struct<id:long,name:string,slug:string,description:string,details:string,url:string,affiliate_url:string,logo:string,photos:array<string>,categories:array<string>,min_price:double,max_price:double>,"
    "options:array<struct<id:long,name:string,dates:struct<single_date:string,start_date:string,end_date:string>,venue:struct<name:string,address:string,latitude:string,longitude:string>>>>"
)
LISTING = "struct<id:long,name:string,slug:string,description:string,min_price:double,max_price:double>"


def from_activities(listings: DataFrame, details: DataFrame, as_of: str) -> DataFrame:
    """Events of list rows joined with their details (both: id, item as JSON text); a listing without details goes.

    Future dates of the options are occurrences at noon; without any the activity is always open:
    one occurrence on the far date.
    """
    rows = listings.select("id", F.from_json("item", LISTING).alias("l")).join(details.select("id", F.from_json("item", ACTIVITY).alias("d")), "id").where(required("d.activity.name"))
    a = F.col("d.activity")
    venue = F.get(F.filter(F.transform("d.options", lambda o: o["venue"]), lambda v: v.isNotNull()), 0)
    given = F.flatten(F.transform(F.coalesce("d.options", F.array().cast("array<struct<id:long,name:string,dates:struct<single_date:string,start_date:string,end_date:string>,venue:struct<name:string,address:string,latitude:string,longitude:string>>>")), lambda o: F.array(o["dates"]["single_date"], o["dates"]["start_date"])))
    slugged = F.regexp_extract_all(F.concat_ws(" ", a["slug"], a["name"]), F.lit(r"(\d{4}-\d{2}-\d{2})"), 1)
    noon = lambda d: local_to_utc(F.try_to_timestamp(F.concat(F.substring(d, 1, 10), F.lit(" 12:00")), F.lit("yyyy-MM-dd HH:mm")))
    usable = lambda ds: F.array_sort(F.array_distinct(F.filter(F.transform(ds, noon), lambda t: t.isNotNull() & future(t, F.lit(as_of).cast("timestamp")))))
    rows = rows.select("id", "l", "d", venue.alias("venue"), usable(given).alias("from_options"), usable(slugged).alias("from_name"))
    rows = rows.withColumn("starts", F.when(F.size("from_options") > 0, F.col("from_options")).otherwise(F.col("from_name")))
    a, name = F.col("d.activity"), F.trim("d.activity.name")
    nonzero = lambda x, y: F.when(F.coalesce(x, F.lit(0.0)) != 0, x).otherwise(y)
    low, high = nonzero(a["min_price"], F.col("l.min_price")), nonzero(a["max_price"], F.col("l.max_price"))
    kind = rules.activity_type(a["categories"], name, a["slug"])
    about = F.coalesce(filled(F.substring(text.strip_blocks(a["description"]), 1, 2000)), filled(F.substring(text.strip_blocks(a["details"]), 1, 2000)))
    link = F.coalesce(a["url"], a["affiliate_url"], F.concat(F.lit("https://www.bilet.com/etkinlik/"), a["slug"]))
    price = struct_of(PRICE, min_value=low, max_value=high, currency="TRY", is_free=False, is_unknown=low.isNull())
    source = struct_of(SOURCE, provider="bilet.com", external_id=F.col("id").cast("string"), title=name, description=about, source_url=link, ticket_url=F.coalesce(a["affiliate_url"], a["url"]), price=price, ticket_status="on_sale", brand_name="bilet.com", is_official_seller=True)
    always = struct_of(OCCURRENCE, local_date=ONGOING, timezone=ZONE, venue_name=F.coalesce("venue.name", F.lit("")), sources=F.array(source))
    dated = F.transform("starts", lambda t: occurrence_at(t, venue_name=F.coalesce(F.col("venue.name"), name), sources=F.array(source)))
    where = dims.city_in_address(F.col("venue.address"), F.lit(dims.UNKNOWN_CITY))
    return finish(
        rows, ["id"], title=name, description=about, type=kind, category=kind, city_name=where, image_url=F.coalesce(a["logo"], F.get(a["photos"], 0)),
        occurrences=F.when(F.size("starts") > 0, dated).otherwise(F.array(always)), source="bilet.com", providers=F.array(F.lit("bilet.com")), provider_label="bilet.com",
        external_id=F.col("id").cast("string"), address=F.col("venue.address"), venue=F.col("venue.name"), latitude=F.col("venue.latitude").try_cast("double"),
        longitude=F.col("venue.longitude").try_cast("double"), performer_name=text.performer(name), organizer_name="bilet.com",
    )


def from_partner_api(items: DataFrame, as_of: str, api_url: str) -> DataFrame:
    """Events of a partner's items (path, place, item as JSON text); past ones go; no city is the default one."""
    g = lambda k: F.trim(text.unescape_fixpoint(F.coalesce(F.get_json_object("item", f"$.{k}"), F.lit(""))))
    when = F.trim(F.get_json_object("item", "$.baslangic"))
    start = local_to_utc(F.coalesce(F.try_to_timestamp(when, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(when, F.lit("yyyy-MM-dd HH:mm"))))
    rows = items.select("path", "place", "item", g("etkinlik").alias("title"), start.alias("start"), g("adres").alias("address"), g("konum").alias("venue"), g("sehir").alias("town"), g("organizator").alias("organizer"), F.get_json_object("item", "$.id").alias("id"), filled(F.get_json_object("item", "$.url")).alias("link"), filled(F.get_json_object("item", "$.gorsel")).alias("image"), rules.partner_type(F.get_json_object("item", "$.kategori")).alias("type"), P.partner_price(F.get_json_object("item", "$.fiyat")).alias("p"), filled(F.substring(text.strip_blocks_url(F.get_json_object("item", "$.detay")), 1, 4800)).alias("about"))
    rows = rows.where(required("title") & not_past("start", F.lit(as_of).cast("timestamp")))
    where = F.coalesce(dims.city("town"), dims.city_in_address("address"), dims.city_in_address("venue"), F.lit(dims.DEFAULT_CITY))
    price = struct_of(PRICE, min_value=F.col("p.min"), max_value=F.col("p.min"), currency="TRY", is_free=F.col("p.is_free"), is_unknown=F.col("p.is_unknown"))
    source = struct_of(SOURCE, provider="BiletimGO", external_id=F.col("id"), title=F.col("title"), source_url=F.coalesce("link", F.lit(api_url)), ticket_url=F.col("link"), price=price, brand_name=F.coalesce(filled("organizer"), F.lit("biletimGO")), is_official_seller=True)
    return finish(
        rows, ["path", "place"], title=F.col("title"), description=F.col("about"), type=F.col("type"), category=F.col("type"), city_name=where, image_url=F.col("image"),
        occurrences=F.array(occurrence_at(F.col("start"), venue_name=F.coalesce(filled("venue"), F.col("title")), sources=F.array(source))), source="BiletimGO",
        providers=F.array(F.lit("BiletimGO")), provider_label="biletimGO", external_id=F.col("id"), address=filled("address"), venue=filled("venue"),
        performer_name=text.performer("title"), organizer_name=filled("organizer"),
    )


def from_search(results: DataFrame) -> DataFrame:
    """Events of search answers (city, category, fetched_at, place, item as JSON text), first of each id and city."""
    t = lambda k: H.json_text("item", f"$.{k}")
    rows = results.select("city", "category", "fetched_at", "place", "item", t("title").alias("title"), F.coalesce(t("link"), F.lit("https://www.google.com")).alias("link"), t("description").alias("about"), t("venue").alias("venue"), t("thumbnail").alias("thumbnail"))
    address = F.from_json(F.get_json_object("item", "$.address"), "array<string>")
    offers = F.get_json_object("item", "$.ticket_info")
    objects = F.from_json(offers, "array<struct<source:string,price:string,link_type:string>>")
    lists = F.transform(F.from_json(offers, "array<array<string>>"), lambda p: F.struct(F.get(p, 0).alias("source"), F.get(p, 1).alias("price"), F.lit(None).cast("string").alias("type")))
    named = F.coalesce(lists, F.transform(objects, lambda o: F.struct(o["source"].alias("source"), o["price"].alias("price"), o["link_type"].alias("type"))))
    rows = rows.withColumn("address", F.coalesce(F.array_join(address, ", "), F.get_json_object("item", "$.address"))).withColumn("ticket_info", filled(text.ticket_info(named)))
    rows = rows.withColumn("start", search_instant(F.coalesce(F.get_json_object("item", "$.date.start_date"), F.get_json_object("item", "$.date.when"), F.lit("")), "fetched_at"))
    rows = rows.withColumn("id", first_filled(F.get_json_object("item", "$.event_id"), F.get_json_object("item", "$.id"), text.search_id("title", "link", "city"))).where(required("title"))
    rows = first_by(rows.withColumn("_key", F.lower(F.concat_ws("|", "id", "city"))), ["_key"], "city", "category", "place")
    price = P.first_known(
        P.stated_price(F.get_json_object("item", "$.extracted_price"), F.get_json_object("item", "$.extracted_price"), "search_extracted", 0.8, "search_indexed_api"),
        P.text_price(F.get_json_object("item", "$.price"), "search_text", 0.74, "search_indexed_api"), P.text_price("ticket_info", "search_ticket_info", 0.68, "search_indexed_api"),
    )
    kind = rules.search_type("title", "about", "category")
    source = struct_of(SOURCE, provider="serpapi_google_events", external_id=F.col("id"), title=F.col("title"), source_url=F.col("link"), price=price, ticket_status="unknown")
    return finish(
        rows, ["city", "category", "place"], title=F.col("title"), description=F.col("about"), type=kind, city_name=F.col("city"),
        occurrences=F.array(occurrence_at(F.col("start"), venue_name=F.coalesce("venue", F.lit(UNSTATED_VENUE)), sources=F.array(source))), source="serpapi_google_events", external_id=F.col("id"),
        category=F.col("category"), address=F.col("address"), venue=F.col("venue"), link=F.col("link"), ticket_info=F.col("ticket_info"), thumbnail_url=F.col("thumbnail"), fetched_at=F.col("fetched_at"),
        source_url=F.col("link"), performer_name=text.performer("title"),
    )


def from_rss(items: DataFrame, city_name: str, days: int, as_of: str) -> DataFrame:
    """Events of RSS or post rows (title, link, description, pubDate, category, venue?) within the look-ahead."""
    from playbill.operators.filters import look_ahead

    venue = F.coalesce(filled("venue"), F.lit(CITY_VENUE)) if "venue" in items.columns else F.lit(CITY_VENUE)
    rows = items.withColumn("start", feed_instant("pubDate")).withColumn("title", text.clean_text("title")).where(required("title") & urls.is_link("link") & look_ahead("start", F.lit(as_of).cast("timestamp"), days))
    about = text.truncate(text.strip_html("description"), 250)
    price = P.text_price(F.regexp_extract(F.concat_ws(" ", "description", "title", "category"), PRICE_IN_TEXT, 0), "rss_text", 0.7, "public_feed")
    kind = rules.shared_type(F.concat_ws(" ", "title", "category"))
    eid = text.surrogate_id("rss-", "link")
    source = struct_of(SOURCE, provider="MunicipalRSS", external_id=eid, title=F.col("title"), description=about, source_url=F.col("link"), price=price, ticket_status="unknown")
    return finish(
        rows, _as_read(items, "link", "title"), title=F.col("title"), description=about, type=kind, city_name=city_name, occurrences=F.array(occurrence_at(F.col("start"), venue_name=venue, sources=F.array(source))),
        source="MunicipalRSS", providers=F.array(F.lit("MunicipalRSS")), external_id=eid, link=F.col("link"), source_url=F.col("link"),
    )


PRICE_IN_TEXT = r"(?iu)(?:ücretsiz|ucretsiz|bedava|(?:\d[\d.,]*\s*(?:[-–]\s*\d[\d.,]*\s*)?(?:tl|₺|try)\b))"


def from_web(items: DataFrame, days: int, as_of: str) -> DataFrame:
    """Events of page items (site, site_rank, page_rank, place, city, title, link, venue, date, time, description, image, price_text?, html?).

    Items are as the page scans give them: entities other than those of markup are resolved (text.settle).
    Titles that are a place's name go, as do items without a date in the look-ahead. Prices come
    from the price text, JSON-LD, meta elements, then the description and title.
    """
    from playbill.operators.filters import look_ahead

    none = F.lit(None).cast("string")
    has = set(items.columns)
    page = F.col("html") if "html" in has else none
    said = F.col("price_text") if "price_text" in has else none
    rows = items.withColumn("start", F.coalesce(near_time(F.concat_ws(" ", "date", "time")), near_time("description"))).withColumn("title", text.clean_settled("title"))
    rows = rows.where(required("title") & look_ahead("start", F.lit(as_of).cast("timestamp"), days) & ~structural_title("title", "site", "venue"))
    about = text.truncate(F.coalesce(filled(text.strip_settled("description")), F.col("title")), 250)
    rows = rows.withColumns({"_said": said, "_linked": H.jsonld_price(page), "_meta": H.meta_price(page), "_in_text": F.regexp_extract(F.coalesce("description", F.lit("")), PRICE_IN_TEXT, 0), "_in_title": F.regexp_extract("title", PRICE_IN_TEXT, 0)})
    candidates = {
        "_p0": P.text_price("_said", "web_price_text", 0.8, "public_web_text"), "_p1": P.stated_price("_linked.min", "_linked.max", "web_jsonld", 0.85, "public_web_text", "_linked.currency"),
        "_p2": P.text_price("_meta", "web_meta", 0.75, "public_web_text"), "_p3": P.text_price("_in_text", "web_description", 0.6, "public_web_text"), "_p4": P.text_price("_in_title", "web_title", 0.5, "public_web_text"),
    }
    rows = rows.withColumns(candidates)
    price = P.first_known(*map(F.col, candidates))
    kind = rules.shared_type(F.concat_ws(" ", "title", "description"))
    eid = text.surrogate_id("web-", "link")
    source = struct_of(SOURCE, provider="MunicipalWeb", external_id=eid, title=F.col("title"), description=about, source_url=F.col("link"), ticket_url=F.concat_ws("|", "site", "link"), price=price, ticket_status="unknown")
    return finish(
        rows, ["site_rank", "page_rank", "place"], title=F.col("title"), description=about, type=kind, city_name=F.col("city"), image_url=filled("image"),
        occurrences=F.array(occurrence_at(F.col("start"), venue_name=F.coalesce(filled("venue"), F.col("site")), sources=F.array(source))), source="MunicipalWeb", providers=F.array(F.lit("MunicipalWeb")),
        external_id=eid, link=F.col("link"), source_url=F.col("link"), venue=filled("venue"),
    )


def fill_about(events: DataFrame, abouts: DataFrame, domain: str) -> DataFrame:
    """Events without description take the about text of their page, if that is on the domain."""
    link = F.get(F.get(F.col("occurrences"), 0)["sources"], 0)["source_url"]
    keyed = events.withColumn("_url", F.when(F.col("description").isNull() & F.contains(link, F.lit(domain)), link))
    return keyed.join(abouts.select(F.col("url").alias("_url"), F.col("about").alias("_about")), "_url", "left").withColumn("description", F.coalesce("description", "_about")).select(*events.columns)


