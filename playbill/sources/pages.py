"""Scans of HTML pages (site, site_rank, page_rank, base_url, html) into raw items.

Each returns site, site_rank, page_rank, place, title, link, venue, date, time, description, image.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions import html as H
from playbill.functions.columns import col, filled, first_filled
from playbill.functions.dates import NAMED_DATE, ZONE, event_date, feed_instant
from playbill.functions.text import clean_settled, settle, slug_title, strip_settled
from playbill.functions.urls import absolute
from playbill.operators.dedup import fallback_union, first_by
from playbill.operators.filters import event_like

ITEM = ["site", "site_rank", "page_rank", "place", "title", "link", "venue", "date", "time", "description", "image"]
PAGE = ["site", "site_rank", "page_rank", "base_url"]
ANCHOR = r"""(?is)<a\b[^>]*href=["'][^"']+["'][^>]*>.*?</a>"""


def items(df: DataFrame, **fields: Column) -> DataFrame:
    """The item columns, blank where not given."""
    blank = F.lit("")
    made = {"title": blank, "link": F.col("base_url"), "venue": F.col("site"), "date": blank, "time": blank, "description": blank, "image": blank} | fields
    return df.select("site", "site_rank", "page_rank", "place", *(F.coalesce(v, blank).alias(k) for k, v in made.items()))


def settled(pages: DataFrame) -> DataFrame:
    """Pages whose html has all entities resolved but those of markup: the scans then clean texts by the usual ones.

    Exploding an array of one keeps the optimizer from putting the expression into every filter above.
    """
    return pages.select(*(F.col(f"`{c}`") for c in pages.columns if c != "html"), F.explode(F.array(settle("html"))).alias("html"))


def date_time(text: Column) -> tuple[Column, Column]:
    """A long date (its word is a month's name) with a time at most 50 characters behind it, else a dotted date."""
    long = F.regexp_extract(text, NAMED_DATE, 0)
    clock = F.regexp_extract(text, NAMED_DATE + r".{0,50}?(\d{1,2}[:.]\d{2})", 4)
    return F.when(long != "", long).otherwise(F.regexp_extract(text, r"\d{1,2}\.\d{1,2}\.\d{4}", 0)), F.replace(clock, F.lit("."), F.lit(":"))


def cards(pages: DataFrame, patterns: list[str] | None = None, require_keywords: bool = True) -> DataFrame:
    """Link cards: matches of the patterns in their order, the first of each link of a page.

    The title is the card's text, else a title attribute, else made of the link.
    """
    found = F.flatten(F.array(*(F.regexp_extract_all("html", F.lit(p), 0) for p in patterns or [ANCHOR])))
    rows = settled(pages).select(*PAGE, F.posexplode(found).alias("place", "card"))
    raw = clean_settled(F.regexp_extract("card", r"""(?is)href=["']([^"']+)["']""", 1))
    rows = rows.withColumn("link", absolute(raw, "base_url")).where(raw != "")
    rows = first_by(rows, ["site", "page_rank", "link"], "place")
    body = F.regexp_extract("card", r"(?is)^<[^>]+>(.*)</a>", 1)
    own = strip_settled(body)
    named = F.when(~F.lower(own).isin("", "detay", "daha fazla"), own)
    attributes = [filled(strip_settled(F.regexp_extract("card", rf'(?i){a}="([^"]+)"', 1))) for a in ("title", "aria-label", "data-title")]
    title = F.coalesce(named, *attributes, filled(slug_title("link")))
    day, clock = date_time(clean_settled(F.regexp_replace(body, "<[^>]+>", " ")))
    out = rows.withColumn("_title", title).where(F.col("_title").isNotNull())
    if require_keywords:
        out = out.where(event_like(F.concat_ws(" ", "_title", "card", "link")))
    image = H.first_image("card", "base_url")
    return items(out, title=F.col("_title"), link=F.col("link"), date=day, time=clock, description=F.coalesce(filled(own), F.col("_title")), image=image)


# Labels of detail pages.
LABELS = {
    "venue": ["Yer", "Mekan", "Konum", "Adres"], "date": ["Tarih", "Etkinlik Tarihi"], "time": ["Saat", "Etkinlik Saati"],
    "description": ["Açıklama", "Detay"], "price_text": ["Ücret", "Bilet Ücreti", "Bilet Fiyatı", "Giriş Ücreti", "Ücret Bilgisi", "Fiyat"],
}


def fill_from_details(found: DataFrame, details: DataFrame, required: bool = False) -> DataFrame:
    """Items with their blanks filled from their pages (details: link, html); required: without a page they go."""
    joined = found.join(settled(details.select("link", "html")).withColumnRenamed("html", "_page"), "link", "inner" if required else "left")
    day, clock = date_time(F.array_join(H.lines("_page", True), " "))
    labelled = {k: H.label_value("_page", *v, settled=True) for k, v in LABELS.items()}
    more = {"title": H.title("_page", True), "venue": labelled["venue"], "date": F.coalesce(labelled["date"], filled(day)), "time": F.coalesce(labelled["time"], filled(clock)), "description": F.coalesce(labelled["description"], H.body_text("_page", settled=True)), "image": H.first_image("_page", "link")}
    return joined.select(*(F.coalesce(filled(c), more[c], F.lit("")).alias(c) if c in more else F.col(c) for c in ITEM), labelled["price_text"].alias("price_text"), F.col("_page").alias("html"))


def label_lines(pages: DataFrame, categories: str = "Konser|Söyleşi|Tiyatro|Sergi|Sinema|Atölye|Festival|Müzik|Diğer") -> DataFrame:
    """Pages of lines: "Category | date" begins an item, its title is the first fit one of the next three lines."""
    rows = settled(pages).select(*PAGE, F.posexplode(H.lines("html", True)).alias("place", "line"), H.first_image("html", "base_url").alias("img"))
    w = Window.partitionBy("site", "page_rank").orderBy("place")
    bare = F.trim(F.regexp_replace("line", "^[# ]+", ""))
    fit = F.when((bare != "") & ~F.upper(bare).isin("TÜM ETKİNLİKLERİMİZ", "BAKIRKÖY'DE BU HAFTA", "ETKİNLİKLERİMİZ"), bare)
    rows = rows.withColumn("_title", F.coalesce(*(F.lead(fit, i).over(w) for i in (1, 2, 3))))
    head = rf"(?iu)^({categories})\s*\|\s*(.+)$"
    kind, rest = F.regexp_extract("line", head, 1), F.regexp_extract("line", head, 2)
    day, clock = F.regexp_extract(rest, r"\d{1,2}\s+[A-Za-zÇĞİÖŞÜçğıöşü]+\s+\d{4}", 0), F.regexp_extract(rest, r"\d{1,2}[:.]\d{2}", 0)
    out = rows.where((kind != "") & (F.lower(kind) != "diğer") & F.col("_title").isNotNull() & (day != ""))
    return items(out, title=F.col("_title"), date=day, time=F.replace(clock, F.lit("."), F.lit(":")), description=F.concat_ws(" ", kind, "_title"), image=F.col("img"))


def calendar_tables(pages: DataFrame) -> DataFrame:
    """Tables of a week: a row of seven dates, then a row of seven cells; each link of a cell is an item of its date."""
    tr = F.regexp_extract_all("html", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    cells = lambda x: F.regexp_extract_all(x, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1)
    rows = settled(pages).select(*PAGE, F.posexplode(tr).alias("row", "body"))
    w = Window.partitionBy("site", "page_rank").orderBy("row")
    rows = rows.withColumn("next", F.lead("body").over(w)).where(~F.contains("next", F.lit("Etkinlik Bulunmamaktad")))
    rows = rows.withColumn("days", F.transform(cells(F.col("body")), strip_settled)).withColumn("cells", cells(F.col("next"))).where("size(days) = 7 and size(cells) = 7")
    each = rows.select(*PAGE, "row", F.posexplode(F.arrays_zip("days", "cells")).alias("day_no", "z"))
    anchors = each.select(*PAGE, "row", "day_no", F.col("z.days").alias("day"), F.posexplode(F.regexp_extract_all("z.cells", F.lit(ANCHOR), 0)).alias("nth", "card"))
    title = F.trim(F.regexp_replace(strip_settled(F.regexp_extract("card", r"(?is)^<[^>]+>(.*)</a>", 1)), "^[* ]+", ""))
    out = anchors.withColumn("_title", title).withColumn("place", F.col("row") * 10_000 + F.col("day_no") * 1_000 + F.col("nth")).where((F.col("_title") != "") & (F.col("day") != "") & ~F.contains(F.lower("_title"), F.lit("rezervasyon")))
    return items(out, title=F.col("_title"), date=F.col("day"), description=F.col("_title"), image=absolute(F.regexp_extract("card", r"""(?is)href=["']([^"']+)["']""", 1), "base_url"))


def link_lists(pages: DataFrame, pattern: str) -> DataFrame:
    """Distinct links of the pattern's first group, sorted; their details fill the rest."""
    links = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(pattern), 1), lambda x: absolute(x, F.col("base_url")))))
    rows = pages.select(*PAGE, F.posexplode(links).alias("place", "url"))
    return items(rows, link=F.col("url"), venue=F.lit(""))


def blocks(pages: DataFrame, pattern: str, groups: dict[str, int], fallback: str = ANCHOR) -> DataFrame:
    """Blocks whose fields are groups of one pattern; pages without any give their plain links instead."""
    whole = F.regexp_extract_all("html", F.lit(pattern), 0)
    rows = settled(pages).select(*PAGE, F.posexplode(whole).alias("place", "block"))
    part = {k: strip_settled(F.regexp_extract("block", pattern, i)) for k, i in groups.items() if k != "link"}
    link = absolute(F.regexp_extract("block", pattern, groups["link"]), "base_url") if "link" in groups else F.col("base_url")
    found = items(rows, **part, link=link)
    plain = cards(pages, [fallback], require_keywords=False)
    return fallback_union(found, plain, keys=["site", "page_rank"]).select(*ITEM)


def windows(pages: DataFrame, card: str, within: int = 600) -> DataFrame:
    """Cards (link, title groups) with the date, venue and category found in the characters behind each."""
    spans = F.regexp_extract_all("html", F.lit(rf"(?is){card}.{{0,{within}}}"), 0)
    rows = settled(pages).select(*PAGE, F.posexplode(spans).alias("place", "span"))
    rest = clean_settled(F.regexp_replace(F.regexp_replace("span", rf"(?is)^{card}", " "), "<[^>]+>", " "))
    day, clock = date_time(rest)
    venue = F.regexp_extract("span", r"""(?is)class=["'][^"']*(?:venue|mekan|location)[^"']*["'][^>]*>(.*?)<""", 1)
    return items(rows, title=strip_settled(F.regexp_extract("span", rf"(?is){card}", 2)), link=absolute(F.regexp_extract("span", rf"(?is){card}", 1), "base_url"), venue=F.coalesce(filled(strip_settled(venue)), F.col("site")), date=day, time=clock, description=F.substring(rest, 1, within))


def dated_links(pages: DataFrame) -> DataFrame:
    """"dd.mm.yyyy hh:mm ... href ... title" entries."""
    p = r"""(?is)(\d{2}\.\d{2}\.\d{4})\s+(\d{2}:\d{2}).*?href=["']([^"']+)["'][^>]*>(.*?)</a>"""
    zipped = F.arrays_zip(*(F.regexp_extract_all("html", F.lit(p), i).alias(n) for i, n in ((1, "day"), (2, "clock"), (3, "href"), (4, "name"))))
    rows = settled(pages).select(*PAGE, F.posexplode(zipped).alias("place", "z"))
    return items(rows, title=strip_settled("z.name"), link=absolute("z.href", "base_url"), date=F.col("z.day"), time=F.col("z.clock"), description=strip_settled("z.name"))


# Where posts keep their dates, times, venues and prices.
DATE_TIME_KEYS = ["event_start_datetime", "event_start_date_time", "event_start", "start_datetime", "start_date_time", "start_at", "event_start_at"]
DATE_KEYS = ["event_start_date", "event_date", "start_date", "startDate", "eventStartDate"]
TIME_KEYS = ["event_start_time", "start_time", "startTime", "eventStartTime", "time"]
VENUE_KEYS = ["venue", "venue_name", "event_venue", "location", "place", "event_place"]
CONTAINERS = ("$", "$.acf", "$.meta", "$.event", "$.event_listing")


def posts(rows: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Items of WordPress-like posts (page columns, place, item as JSON text), whatever shape their fields have.

    Posts without a date field have the first date of their text, or, with as_of (an instant), the
    soonest of all its dates. Each item is parsed once, as a VARIANT, and all fields are read from that.
    """
    groups = {"title": ["$.title"], "name": ["$.name"], "excerpt": ["$.excerpt"], "content": ["$.content"], "link": ["$.link"]}
    groups |= {name: [f"{c}.{k}" for c in CONTAINERS for k in keys] for name, keys in (("moment", DATE_TIME_KEYS), ("day", DATE_KEYS), ("clock", TIME_KEYS), ("venue", VENUE_KEYS))}
    at, paths = {}, []
    for name, own in groups.items():
        at[name] = (len(paths) + 1, len(own))
        paths += own

    def field(name: str, texts: Column | None = None) -> Column:
        texts = F.col("_post.texts") if texts is None else texts
        return F.get(F.filter(F.slice(texts, *at[name]), lambda x: x.isNotNull()), 0)

    parsed = rows.withColumn("_v", F.try_parse_json(settle("item")))
    posted = first_filled(*(F.try_variant_get("_v", f"$.{k}", "string") for k in ("date_gmt", "date")))
    read = F.struct(H.variant_texts("_v", paths).alias("texts"), F.get(H.variant_images("_v"), 0).alias("image"), posted.alias("posted"))
    # exploding one struct, or none, keeps posts with a title without a filter that would be pushed below the parsing
    titled = lambda p: F.coalesce(field("title", p["texts"]), field("name", p["texts"])).isNotNull()
    read = parsed.select(*PAGE, "place", F.explode(F.filter(F.array(read), titled)).alias("_post"))
    title, whole, posted = F.coalesce(field("title"), field("name")), field("content"), F.col("_post.posted")
    body = F.coalesce(field("excerpt"), whole, title)
    day, clock = date_time(F.coalesce(whole, body))
    if as_of is not None:
        chosen = F.from_utc_timestamp(event_date(F.coalesce(whole, body), feed_instant(posted), as_of), ZONE)
        shown = F.get(F.transform(F.array(chosen), lambda c: F.struct(F.date_format(c, "dd.MM.yyyy").alias("day"), F.when(c.cast("date").cast("timestamp") != c, F.date_format(c, "HH:mm")).alias("clock"))), 0)
        day, clock = shown["day"], shown["clock"]
    date = F.coalesce(field("moment"), field("day"), filled(day), posted)
    image = F.when(F.col("_post.image").isNotNull(), absolute("_post.image", "base_url"))
    return items(read, title=title, link=F.coalesce(field("link"), F.col("base_url")), venue=F.coalesce(field("venue"), F.col("site")), date=date, time=F.coalesce(field("clock"), filled(clock)), description=body, image=image)


def posts_or_cards(pages: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Posts of pages that are JSON (a list, or an object with one); other pages are read as cards."""
    body = F.trim("html")
    listed = [F.when(F.get_json_object("html", f"$.{k}").rlike(r"^\s*\["), F.get_json_object("html", f"$.{k}")) for k in ("items", "events", "data", "posts", "results")]
    entries = F.from_json(F.coalesce(F.when(body.startswith("["), F.col("html")), *listed), "array<string>")
    rows = pages.select(*PAGE, F.posexplode(entries).alias("place", "item")).where(F.col("item").rlike(r"^\s*\{"))
    return fallback_union(posts(rows, as_of), cards(pages), keys=["site", "page_rank"]).select(*ITEM)


def nothing(pages: DataFrame) -> DataFrame:
    """Sites that are listed but not read."""
    return items(pages.limit(0).withColumn("place", F.lit(0)))


def plain_windows(pages: DataFrame) -> DataFrame:
    """windows() behind any link that has a title."""
    return windows(pages, r"""<a[^>]+href=["']([^"']+)["'][^>]*>\s*([^<]{4,200}?)\s*</a>""")


def passed_on(pages: DataFrame) -> DataFrame:
    """Pages whose html is already JSON items of the scans' own columns (title, link, venue, date, time, description, image)."""
    rows = settled(pages).select(*PAGE, F.posexplode(F.from_json("html", "array<string>")).alias("place", "item"))
    get = lambda k: F.get_json_object("item", f"$.{k}")
    return items(rows, **{k: get(k) for k in ("title", "link", "venue", "date", "time", "description", "image")})


#: The scans by name, as a site dimension names them.
STRATEGIES = {"cards": cards, "posts": posts_or_cards, "lines": label_lines, "calendar": calendar_tables, "dated_links": dated_links, "windows": plain_windows, "pass": passed_on, "none": nothing}


def scan(pages: DataFrame, most_a_site: int = 20, more: dict[str, Callable[[DataFrame], DataFrame]] | None = None, as_of: Column | str | None = None) -> DataFrame:
    """Items of all pages by their strategy; of a site only its first page with any, and at most so many items.

    `more` adds scans by name, such as link_lists() or blocks() with a site's pattern. A strategy
    that nothing reads is an error rather than pages lost without a word. as_of is for the dates of posts.
    """
    known = {**STRATEGIES, "posts": lambda p: posts_or_cards(p, as_of), **(more or {})}
    lost = [r[0] for r in pages.where(~F.coalesce(F.col("strategy").isin(*known), F.lit(False))).select("strategy").distinct().limit(5).collect()]
    if lost:
        raise ValueError(f"no scan for {lost}; there are {sorted(known)}")
    rows = reduce(DataFrame.unionByName, (read(pages.where(col("strategy") == name)) for name, read in known.items()))
    site = Window.partitionBy("site")
    first = rows.withColumn("_first", F.min("page_rank").over(site)).where(F.col("page_rank") == F.col("_first"))
    return first.withColumn("_n", F.row_number().over(site.orderBy("place"))).where(F.col("_n") <= most_a_site).drop("_first", "_n")
