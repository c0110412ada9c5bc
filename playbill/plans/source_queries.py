"""Sources over landed forms of the test tables: tables are written as feeds have them, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.operators import patterns, provenance
from playbill.plans.queries import query
from playbill.sources import json_split, paged, pages, readers, sinks
from playbill.storage import scratch
from playbill.streaming.keyed_table import KeyedTable


@query(
    """
with listed as (
  select o_orderkey, o_orderdate, o_orderpriority as segment, case when o_custkey % 10 = 0 then 'DE' else 'TR' end as country from orders
  union all select o_orderkey, o_orderdate, 'REST', case when o_custkey % 10 = 0 then 'DE' else 'TR' end from orders where o_orderkey % 10 < 3),
placed as (select *, row_number() over (partition by country, segment order by o_orderdate, o_orderkey) - 1 as n from listed),
wanted as (select *, row_number() over (partition by o_orderkey order by case segment when '1-URGENT' then 0 when '5-LOW' then 1 else 2 end) as seen
           from placed where country = 'TR' and segment in ('1-URGENT', '5-LOW', 'REST') and strftime(o_orderdate, '%Y-%m-%d') between '1995-03-01' and '1996-02-29')
select o_orderkey::varchar as id, segment, (n // 200)::integer as page, (n % 200)::integer as place from wanted where seen = 1
"""
)
def paged_scan(t, spark):
    """Orders landed as a feed's pages of 200 in order of date; of one country, three segments and a year, the first of each id."""
    o = t("orders").withColumn("country", F.when(F.col("o_custkey") % 10 == 0, "DE").otherwise("TR"))
    key = F.col("o_orderkey").cast("string")
    item = F.to_json(F.struct(key.alias("id"), F.struct(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("localDate")).alias("start")).alias("dates")))
    listed = o.withColumn("segment", F.col("o_orderpriority")).union(o.where("o_orderkey % 10 < 3").withColumn("segment", F.lit("REST")))
    path = scratch(spark, "pages")
    paged.land_pages(listed.select("country", "segment", "o_orderdate", "o_orderkey", item.alias("item")), path, 200, "o_orderdate", "o_orderkey")
    year = (F.col("event_date") >= "1995-03-01") & (F.col("event_date") <= "1996-02-29") & (F.col("country") == "TR")
    found = paged.discovery_items(spark, path, year, ["1-URGENT", "5-LOW", "REST"])
    return found.select("id", "segment", "page", "place")


@query("select doc_id, lang, n_chars, md5(text) as text_md5 from documents")
def json_array_scan(t, spark):
    """Documents landed as JSON arrays, a file a task, and read back in parts."""
    path = scratch(spark, "arrays")
    json_split.land_arrays(t("documents").select(F.to_json(F.struct("doc_id", "lang", "n_chars", "text"))), path)
    rows = readers.json_records(spark, path, "doc_id long, lang string, n_chars long, text string", split=True)
    return rows.select("doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query(
    r"""
select doc_id::integer as page_rank, 0 as place, 'T' || doc_id as title, case when doc_id % 4 = 3 then lang else 'Hall ' || doc_id % 4 end as venue,
       case when doc_id % 5 < 4 then '2026-07-0' || (doc_id % 9 + 1) else '2026-05-05T10:00:00' end as date,
       case doc_id % 4 when 0 then 'https://s.example/m/' || doc_id when 1 then 'https://s.example/up/' || doc_id when 2 then 'https://cdn.example/' || doc_id else '' end as image,
       md5(case when trim(regexp_replace(translate(text, '<>&', '   '), '\s+', ' ', 'g')) = '' then 'T' || doc_id else trim(regexp_replace(translate(text, '<>&', '   '), '\s+', ' ', 'g')) end) as text_md5
from documents
"""
)
def post_scan(t, spark):
    """A page of posts of each document: titles, venues, dates, pictures and texts in the shapes that sites use, beside an item without a title."""
    js = lambda x: F.to_json(F.array(x))  # noqa: E731  '["..."]'
    quoted = lambda x: F.regexp_replace(js(x), r"(?s)^\[|\]$", "")
    part = lambda k, *values: F.element_at(F.array(*values), (F.col("doc_id") % k).cast("int") + 1)
    key = F.col("doc_id").cast("string")
    name = quoted(F.concat(F.lit("T"), key))
    title = F.concat(F.lit('"title":'), part(3, name, F.concat(F.lit('{"rendered":'), name, F.lit("}")), F.concat(F.lit('["",{"rendered":"","name":'), name, F.lit("}]"))))
    hall = F.concat(F.lit('"venue":"Hall '), (F.col("doc_id") % 4).cast("string"), F.lit('"'))
    venue = part(4, hall, F.concat(F.lit('"acf":{'), hall, F.lit("}")), F.concat(F.lit('"meta":{'), hall, F.lit("}")), F.lit('"meta":[]'))
    day = F.concat(F.lit('"2026-07-0'), (F.col("doc_id") % 9 + 1).cast("string"), F.lit('"'))
    date = part(5, F.concat(F.lit('"event_date":'), day), F.concat(F.lit('"event":{"start_date":'), day, F.lit("}")), F.concat(F.lit('"event_start":'), day), F.concat(F.lit('"event_listing":{"startDate":'), day, F.lit("}")), F.lit('"date":"2026-05-05T10:00:00"'))
    image = part(4, F.concat(F.lit('"_embedded":{"wp:featuredmedia":[{"source_url":"https://s.example/m/'), key, F.lit('"}]},"image":"x"')), F.concat(F.lit('"image":"/up/'), key, F.lit('"')), F.concat(F.lit('"featured_image":{"sizes":{"medium":{"url":"no"},"large":{"source_url":"https://cdn.example/'), key, F.lit('"}}}')), F.lit('"image":{"sizes":[]}'))
    text = F.concat(F.lit('"excerpt":{"rendered":'), quoted(F.translate("text", "<>&", "   ")), F.lit("}"))
    html = F.concat(F.lit("["), F.concat(F.lit("{"), F.concat_ws(",", title, venue, date, image, text), F.lit("}")), F.lit(',{"title":{"rendered":" "}}, 5]'))
    site = t("documents").select(F.col("lang").alias("site"), F.lit(0).alias("site_rank"), F.col("doc_id").cast("int").alias("page_rank"), F.lit("https://s.example").alias("base_url"), html.alias("html"))
    return pages.posts_or_cards(site).select("page_rank", "place", "title", "venue", "date", "image", F.md5("description").alias("text_md5"))


@query(
    r"""
with items as (select distinct unnest(regexp_extract_all(text, '[a-z]{5,}')) as item from benchmark union select distinct p_name from part),
found as (select doc_id, item from documents join items on contains(text, item))
select doc_id, count(*) as n_items, min(item) as first_item, md5(string_agg(item, ',' order by item)) as items_md5 from found group by doc_id
"""
)
def pattern_search(t, spark):
    """Which of the benchmark's words and the parts' names are in each document, as substrings, by one automaton."""
    words = t("benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{5,}"), 0)).alias("pattern")).union(t("part").select("p_name"))
    found = patterns.find_patterns(t("documents"), "text", ["doc_id"], words)
    listed = F.array_sort(F.collect_list("pattern"))
    return found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.min("pattern").alias("first_item"), F.md5(F.array_join(listed, ",")).alias("items_md5"))


@query(
    """
with first as (select user_id, event_type, max_by(event_id, (ts, event_id)) as event_id from events where ts <= timestamp '2024-01-15' group by all),
second as (select user_id, event_type, max_by(event_id, (ts, event_id)) as event_id from events where ts > timestamp '2024-01-15' group by all)
select user_id, event_type, coalesce(b.event_id, a.event_id) as event_id, b.event_id is not null as is_active, case when b.event_id is not null then 'second' else 'first' end as run_id
from first a full join second b using (user_id, event_type)
"""
)
def keyed_runs(t, spark):
    """Two runs put into a keyed table, then what the second hasn't seen made inactive."""
    e = t("events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    table = KeyedTable(spark, scratch(spark, "keyed"), ["user_id", "event_type"], 16)
    early = F.col("ts") <= F.lit("2024-01-15").cast("timestamp")
    table.upsert(e.where(early), "first", ["ts", "event_id"])
    table.upsert(e.where(~early), "second", ["ts", "event_id"])
    table.sweep(e.where(~early))
    return table.read().select("user_id", "event_type", "event_id", "is_active", "run_id")


@query(
    """
select 'total' as what, 'before' as name, count(*) as n from orders
union all select 'total', 'after', count(distinct o_custkey) from orders
union all select 'total', 'overlap', count(*) - count(distinct o_custkey) from orders
union all select 'total', 'several', count(*) from (select o_custkey from orders group by o_custkey having count(distinct o_orderpriority) > 1)
union all select 'source', o_orderpriority, count(*) from orders group by o_orderpriority
union all select 'combination', names, count(*) from (select o_custkey, string_agg(distinct o_orderpriority, '+' order by o_orderpriority) as names from orders group by o_custkey) group by names
"""
)
def merged_sink(t, spark):
    """Orders before, customers with their priorities after: what the merged sink's files say."""
    before = t("orders").select(F.col("o_orderpriority").alias("source"), "o_custkey")
    after = before.groupBy("o_custkey").agg(F.array_sort(F.collect_set("source")).alias("providers"))
    path = scratch(spark, "merged")
    sinks.write_merged(before, after, path)
    stats = spark.read.schema("total_before long, total_after long, overlap long, multi_provider long").json(f"{path}/stats")
    totals = stats.select(F.stack(F.lit(4), F.lit("before"), "total_before", F.lit("after"), "total_after", F.lit("overlap"), "overlap", F.lit("several"), "multi_provider").alias("name", "n"))
    sources = spark.read.schema("source string, n long").json(f"{path}/sources").select(F.col("source").alias("name"), "n")
    combos = spark.read.schema("combination string, n long").json(f"{path}/combinations").select(F.col("combination").alias("name"), "n")
    return totals.select(F.lit("total").alias("what"), "name", "n").union(sources.select(F.lit("source"), "name", "n")).union(combos.select(F.lit("combination"), "name", "n"))


# Pages made of the parts: the scans find again what was put into them.

SHOP = "https://shop.example"


def _pages(t, html: Column, *columns: Column) -> DataFrame:
    """A page a part."""
    return readers.spread(t("part")).select(F.col("p_brand").alias("site"), F.lit(0).alias("site_rank"), F.col("p_partkey").cast("int").alias("page_rank"), F.lit(SHOP).alias("base_url"), html.alias("html"), *columns)


def _text(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


_MONTHS = ["Ocak", "Temmuz", "A&#287;ustos"]


def _part(name: str) -> Column:
    """Texts of a part: its key, name, brand, a day, month and time."""
    key = F.col("p_partkey")
    made = {
        "key": lambda: key.cast("string"),
        "name": lambda: F.col("p_name"),
        "brand": lambda: F.col("p_brand"),
        "day": lambda: (key % 28 + 1).cast("string"),
        "month": lambda: F.element_at(F.array(*map(F.lit, _MONTHS)), (key % 3).cast("int") + 1),
        "clock": lambda: _text("20:", F.lpad((key % 60).cast("string"), 2, "0")),
    }
    return made[name]()


_DATE_SQL = "(p_partkey % 28 + 1) || ' ' || ['Ocak', 'Temmuz', 'Ağustos'][p_partkey % 3 + 1] || ' 2026'"
_CLOCK_SQL = "'20:' || lpad((p_partkey % 60)::varchar, 2, '0')"


@query(
    f"""
select p_partkey::integer as page_rank, 'https://shop.example/k/' || p_partkey as link, p_name || ' Konseri ' || {_DATE_SQL} || ' ' || replace({_CLOCK_SQL}, ':', '.') as title, {_DATE_SQL} as date, {_CLOCK_SQL} as time from part
union all select p_partkey::integer, 'https://shop.example/s/' || p_partkey, p_brand || ' Sergisi', '', '' from part
"""
)
def page_cards(t, spark):
    """Link cards: a text with entities, a title attribute, the same link again, and a link that is no event."""
    first = _text("<a class='c' href='/k/", _part("key"), "'><h3>", _part("name"), " Konseri</h3>&nbsp;<b>", _part("day"), " ", _part("month"), " 2026 ", F.replace(_part("clock"), F.lit(":"), F.lit(".")), "</b></a>")
    second = _text('<a title="', _part("brand"), ' Sergisi" href="https://shop.example/s/', _part("key"), '">Detay<!-- --></a>')
    again = _text("<a href='/k/", _part("key"), "'>again Konseri</a>")
    got = pages.cards(_pages(t, _text("<p>x</p>", first, "\n", second, again, "<a href='/about'>Kurumsal</a>")))
    return got.select("page_rank", "link", "title", "date", "time")


@query(f"select p_partkey::integer as page_rank, p_name || ' Gecesi' as title, {_DATE_SQL} as date, {_CLOCK_SQL} as time, 'Konser ' || p_name || ' Gecesi' as description from part")
def page_lines(t, spark):
    """Lines with category and date, the title on one of the next three."""
    html = _text("<div>Etkinlikler</div><div>Konser | ", _part("day"), " ", _part("month"), " 2026 ", _part("clock"), "</div><br># TÜM ETKİNLİKLERİMİZ<br/># ", _part("name"), " Gecesi</p>more</p><div>Diğer | 5 Mayıs 2026</div><div>no item</div>")
    return pages.label_lines(_pages(t, html)).select("page_rank", "title", "date", "time", "description")


@query(
    """
select p_partkey::integer as page_rank, p_name || case when d = p_partkey % 7 then ' A' else ' B' end as title, (d + 1) || ' Temmuz 2026' as date
from part, (select unnest([0, 1, 2, 3, 4, 5, 6]) as d) where d in (p_partkey % 7, (p_partkey + 3) % 7)
"""
)
def page_calendar(t, spark):
    """A week's table: two of its days have a link."""
    heads = F.array_join(F.array(*(F.lit(f"<td><b>{d + 1} Temmuz 2026</b></td>") for d in range(7))), "")
    one = lambda d: F.when(F.col("p_partkey") % 7 == d, _text("<td><a href='/r'>Rezervasyon</a><a href='/a'>* ", _part("name"), " A</a></td>")).when((F.col("p_partkey") + 3) % 7 == d, _text("<td><a href='/b'>", _part("name"), "&nbsp;B</a></td>")).otherwise("<td></td>")
    html = _text("<table><tr><th>week</th></tr><tr>", heads, "</tr><tr class='x'>", *(one(d) for d in range(7)), "</tr></table>")
    return pages.calendar_tables(_pages(t, html)).select("page_rank", "title", "date")


@query(f"select p_partkey::integer as page_rank, p_name as title, 'https://shop.example/w/' || p_partkey as link, {_DATE_SQL} as date, {_CLOCK_SQL} as time, case when p_partkey % 2 = 0 then 'Salon ' || p_partkey else p_brand end as venue from part")
def page_windows(t, spark):
    """A link and what stands in the characters behind it."""
    venue = F.when(F.col("p_partkey") % 2 == 0, _text("<span class='event-venue'>Salon ", _part("key"), "</span>")).otherwise("<i></i>")
    html = _text("<a href='/w/", _part("key"), "'>", _part("name"), "</a><p>", _part("day"), " ", _part("month"), " 2026 - ", _part("clock"), "</p>", venue)
    return pages.plain_windows(_pages(t, html)).select("page_rank", "title", "link", "date", "time", "venue")


@query("select p_partkey::integer as page_rank, p_name || ' & Co' as title, 'https://shop.example/d/' || p_partkey as link, lpad((p_partkey % 28 + 1)::varchar, 2, '0') || '.07.2026' as date, '19:30' as time from part")
def page_dated_links(t, spark):
    """Entries of a date, a time and a link."""
    html = _text("<li>", F.lpad(_part("day"), 2, "0"), ".07.2026 19:30 <b>x</b> <a class=k href='/d/", _part("key"), "'><i>", _part("name"), "</i> &amp; Co</a></li>")
    return pages.dated_links(_pages(t, html)).select("page_rank", "title", "link", "date", "time")


@query("select p_partkey::integer as page_rank, place, 'https://shop.example/' || name || p_partkey as link from part, (values (0, 'a'), (1, 'b'), (2, 'c')) v(place, name)")
def page_link_lists(t, spark):
    """Distinct links of a pattern, sorted."""
    html = F.concat(*(_text("<a href='/", x, _part("key"), "'>y</a>") for x in "cabca"), F.lit("<a href='#'>n</a>"))
    return pages.link_lists(_pages(t, html), r"href='(/[a-z]\d+)'").select("page_rank", "place", "link")


@query(
    f"""
select p_partkey::integer as page_rank, case when p_partkey % 3 > 0 then p_name else 'plain' end as title, 'https://shop.example/' || case when p_partkey % 3 > 0 then 'b/' else 'p/' end || p_partkey as link,
       case when p_partkey % 3 > 0 then {_DATE_SQL} else '' end as date
from part
"""
)
def page_blocks(t, spark):
    """Blocks of one pattern; pages without any give their plain links."""
    block = _text("<h3>", _part("name"), "</h3><em>", _part("day"), " ", _part("month"), " 2026</em><a href='/b/", _part("key"), "'>go</a>")
    html = F.when(F.col("p_partkey") % 3 > 0, block).otherwise(_text("<a href='/p/", _part("key"), "'>plain</a>"))
    got = pages.blocks(_pages(t, html), r"(?is)<h3>(.*?)</h3><em>(.*?)</em><a href='([^']+)'", {"title": 1, "date": 2, "link": 3})
    return got.select("page_rank", "title", "link", "date")


@query(
    f"""
select p_partkey::integer as page_rank, case when p_partkey % 2 = 0 then 'known ' || p_partkey else p_name end as title, 'Meydan ' || p_brand as venue, {_DATE_SQL} as date, {_CLOCK_SQL} as time, '75 TL' as price_text
from part where p_partkey % 5 > 0
"""
)
def page_details(t, spark):
    """Items whose blanks their own pages fill; those without a page go."""
    listed = _pages(t, F.lit("")).withColumn("place", F.lit(0))
    title = F.when(F.col("page_rank") % 2 == 0, F.concat(F.lit("known "), F.col("page_rank").cast("string"))).otherwise("")
    found = pages.items(listed, title=title, link=F.concat(F.lit(f"{SHOP}/"), F.col("page_rank").cast("string")), venue=F.lit(""))
    html = _text("<title>no</title><h1>", _part("name"), "</h1><p>Konum : Meydan ", _part("brand"), "</p><ul><li>Tarih: ", _part("day"), " ", _part("month"), " 2026</li><li>Saat: ", _part("clock"), "</li></ul><p>Ücret: 75 TL</p>")
    details = t("part").where("p_partkey % 5 > 0").select(_text(f"{SHOP}/", _part("key")).alias("link"), html.alias("html"))
    return pages.fill_from_details(found, details, required=True).select("page_rank", "title", "venue", "date", "time", "price_text")


@query(
    """
with registry as (select p_brand as label, lower(p_name) as token from part union select 'x' || c_mktsegment, lower(substr(c_mktsegment, 1, 4)) from customer),
texts as (select o_orderkey, 'Halle ' || p_name || ' ' || o_orderpriority || ' ' || coalesce(c_mktsegment, '') as text from orders left join part on p_partkey = o_orderkey % 500 left join customer on c_custkey = o_custkey),
tokens as (select distinct token from registry),
folded as (select o_orderkey, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9_ ]+', '', 'g'), ' +', ' ', 'g')) as text from texts),
found as (select o_orderkey, token from folded join tokens on contains(text, token))
select distinct o_orderkey, label from found join registry using (token)
"""
)
def token_labels(t, spark):
    """Labels of a registry of tokens that are in an order's texts."""
    registry = t("part").select(F.col("p_brand").alias("label"), F.upper("p_name").alias("token")).union(t("customer").select(F.concat(F.lit("x"), "c_mktsegment"), F.substring("c_mktsegment", 1, 4)))
    o = t("orders").join(t("part").select("p_partkey", "p_name"), F.col("p_partkey") == F.col("o_orderkey") % 500, "left").join(t("customer").select("c_custkey", "c_mktsegment"), F.col("c_custkey") == F.col("o_custkey"), "left")
    rows = o.where("p_name is not null").select("o_orderkey", F.array(F.concat(F.lit("HALLE  "), "p_name"), F.col("o_orderpriority"), F.col("c_mktsegment")).alias("texts"))
    return provenance.labels_by_token(readers.spread(rows), ["o_orderkey"], "texts", registry)
