"""Readers, page scans and builders on small inputs of our own."""

import json

import pytest
from pyspark.sql import functions as F

from playbill.plans import trends
from playbill.schema import EVENT, number_rows, schema_of
from playbill.sources import builders, dims, pages, readers, sinks
from playbill.streaming import lifecycle

AS_OF = "2026-06-01 00:00:00"


def landed(tmp_path, name, body):
    path = tmp_path / name
    path.write_text(body if isinstance(body, str) else json.dumps(body), encoding="utf-8")
    return f"file://{path}"


def feed_item(i, title="Oyun", link="https://www.biletinial.com/tr/oyun", city="istanbul-avrupa", date="2026-07-01", cat="tiyatro", sub="", price="250.00", time="20:30", about="Oyun - güzel"):
    return f"<item><title>{title}</title><link>{link}</link><description>{about}</description><g:id>{i}</g:id><g:price>{price}</g:price><g:image_link>https://i/{i}.jpg</g:image_link><g:custom_label_0>{city}</g:custom_label_0><g:custom_label_1>{date}</g:custom_label_1><g:custom_label_2>{sub}</g:custom_label_2><g:custom_label_3>{cat}</g:custom_label_3><g:custom_label_5>{time}</g:custom_label_5><g:custom_label_7>Salon</g:custom_label_7></item>"


def test_product_feed(spark, tmp_path):
    rows = [feed_item("007"), feed_item("2", city="elazig-"), feed_item("3", sub="cocuk-tiyatrosu"), feed_item("4", price="0", time=""), feed_item("5", link="https://evilbiletinial.com/x"), feed_item("6", cat="spor"), feed_item("7", date="2020-01-01"), feed_item("8", city="nowhere"), feed_item("9", title="")]
    path = landed(tmp_path, "feed.xml", '<?xml version="1.0"?><rss xmlns:g="http://base.google.com/ns/1.0"><channel>' + "".join(rows) + "</channel></rss>")
    got = {r.external_id: r for r in builders.from_product_feed(readers.xml_items(spark, path), AS_OF, "biletinial.com", "9").collect()}
    assert set(got) == {"007", "2", "3", "4"}
    assert [got[k].city_name for k in ("007", "2")] == ["İstanbul", "Elazığ"] and got["3"].type == "kids" and got["007"].description == "güzel"
    occ = got["007"].occurrences[0]
    assert (occ.local_date, occ.local_time, occ.sources[0].price.min_value) == ("2026-07-01", "20:30", 250.0)
    assert "utm_source=affiliate" in occ.sources[0].ticket_url and "a_aid=9" in occ.sources[0].ticket_url
    assert got["4"].occurrences[0].local_time == "00:00" and got["4"].occurrences[0].sources[0].price.is_free
    assert readers.xml_items(spark, "file:///nowhere/x.xml").count() == 0


def test_ticketing_api(spark, tmp_path):
    def item(i, **more):
        return {"id": i, "name": f"Show {i}", "url": f"https://t/{i}", "dates": {"start": {"dateTime": "2026-07-01T17:00:00Z"}}, "images": [{"url": "http://s", "width": 10}, {"url": "http://l", "width": 99}, {"url": "ftp://x", "width": 999}], "priceRanges": [{"min": 250, "max": 500, "currency": "TRY"}], "classifications": [{"segment": {"name": "Music"}}], "_embedded": {"venues": [{"name": "Arena", "city": {"name": "Ankara"}}]}} | more

    page = {"_embedded": {"events": [item("a"), item("b", dates={"start": {"localDate": "2026-07-02", "localTime": "20:00"}}), item("a", name="again"), item("c", url="ftp://x"), item("d", _embedded={"venues": [{"city": {"name": "Paris"}}]})]}}
    about = spark.createDataFrame([("https://t/b", "Anlatım")], "url string, about string")
    got = {r.external_id: r for r in builders.from_ticketing_api(readers.paged_items(spark, landed(tmp_path, "p0.json", page)), about).collect()}
    assert set(got) == {"a", "b"} and got["a"].title == "Show a" and got["a"].image_url == "http://l" and got["a"].type == "concert"
    assert got["b"].description == "Anlatım" and got["b"].occurrences[0].local_time == "20:00"
    price = got["a"].occurrences[0].sources[0].price
    assert (price.min_value, price.max_value, price.resolution.confidence) == (250.0, 500.0, 0.98)


def test_activities(spark):
    listing = [(1, json.dumps({"id": 1, "name": "A", "min_price": 5.0})), (2, json.dumps({"id": 2, "name": "B"})), (3, json.dumps({"id": 3}))]
    detail = [(1, json.dumps({"activity": {"name": "Tekne Turu", "slug": "tekne", "categories": ["Aktivite"], "min_price": 0, "url": "https://b/1"}, "options": [{"dates": {"single_date": "2026-07-05"}, "venue": {"name": "İskele", "address": "Merkez, Bodrum", "latitude": "37.0", "longitude": "x"}}, {"dates": {"start_date": "2026-07-05"}}, {"dates": {"single_date": "2020-01-01"}}]})), (2, json.dumps({"activity": {"name": "Müze", "slug": "muze"}, "options": []}))]
    got = {r.external_id: r for r in builders.from_activities(spark.createDataFrame(listing, "id long, item string"), spark.createDataFrame(detail, "id long, item string"), AS_OF).collect()}
    assert set(got) == {"1", "2"}
    assert [(o.local_date, o.local_time) for o in got["1"].occurrences] == [("2026-07-05", "12:00")] and got["1"].city_name == "Muğla" and got["1"].longitude is None
    assert got["1"].occurrences[0].sources[0].price.min_value == 5.0
    always = got["2"].occurrences[0]
    assert (always.local_date, always.start_at_utc, got["2"].city_name) == ("2099-12-31", None, dims.UNKNOWN_CITY)


def test_partner_and_search(spark, tmp_path):
    data = {"error": "success", "data": [{"id": 5, "etkinlik": "Caz &amp;amp; Blues", "baslangic": "2026-07-01 21:00", "kategori": "Konser", "adres": "Alsancak, İzmir", "konum": "Kordon", "fiyat": "150 TL", "detay": "%3Cp%3EA+B%3C/p%3E"}, {"etkinlik": "Eski", "baslangic": "2020-01-01 10:00"}]}
    rows = builders.from_partner_api(readers.envelope_items(spark, landed(tmp_path, "d.json", data)), AS_OF, "https://api").collect()
    assert [(r.title, r.city_name, r.type, r.description) for r in rows] == [("Caz & Blues", "İzmir", "concert", "A+B")]
    assert readers.envelope_items(spark, landed(tmp_path, "e.json", {"error": "no", "data": [{}]})).count() == 0
    raw = json.dumps({"title": "Gece", "link": "http://g", "date": {"start_date": "Jun 8"}, "address": ["Sokak", "Ankara"], "ticket_info": [["Biletci", "200 TL"]]})
    found = spark.createDataFrame([("Ankara", "concert", 0, raw), ("Ankara", "festival", 0, raw)], "city string, category string, place int, item string").withColumn("fetched_at", F.lit(AS_OF).cast("timestamp"))
    (row,) = builders.from_search(found).collect()
    assert row.occurrences[0].local_time == "20:00" and row.ticket_info == "Biletci - 200 TL" and row.occurrences[0].sources[0].price.min_value == 200.0 and row.address == "Sokak, Ankara"


def page(spark, html, strategy="cards", site="Site", rank=0):
    return spark.createDataFrame([(site, rank, 0, "https://s.bel.tr", html, strategy)], "site string, site_rank int, page_rank int, base_url string, html string, strategy string")


def test_page_scans(spark):
    html = '<a href="/e/12-yaz-konseri"><img src="/a.png">Yaz Konseri 5 Temmuz 2026 20:00</a><a href="/e/12-yaz-konseri">again konser</a><a href="/e/33-sergi-gunu">Detay</a><a href="/about">Hakkımızda</a>'
    got = {r.link: r for r in pages.cards(page(spark, html)).collect()}
    assert set(got) == {"https://s.bel.tr/e/12-yaz-konseri", "https://s.bel.tr/e/33-sergi-gunu"}
    assert got["https://s.bel.tr/e/33-sergi-gunu"].title == "sergi gunu" and got["https://s.bel.tr/e/12-yaz-konseri"].date == "5 Temmuz 2026"
    lines = "<div>Konser | 5 Temmuz 2026 20.30</div><div>ETKİNLİKLERİMİZ</div><div># Caz Gecesi</div><div>Diğer | 6 Temmuz 2026</div><div>x</div>"
    assert [(r.title, r.date, r.time) for r in pages.label_lines(page(spark, lines)).collect()] == [("Caz Gecesi", "5 Temmuz 2026", "20:30")]
    week = "<table><tr>" + "".join(f"<td>{d} Temmuz 2026</td>" for d in range(1, 8)) + "</tr><tr><td><a href='/1'>* Film</a></td>" + "<td></td>" * 5 + "<td><a href='/2'>Rezervasyon</a><a href='/3'>Oyun</a></td></tr></table>"
    assert sorted((r.title, r.date) for r in pages.calendar_tables(page(spark, week)).collect()) == [("Film", "1 Temmuz 2026"), ("Oyun", "7 Temmuz 2026")]
    assert [(r.title, r.date, r.time) for r in pages.dated_links(page(spark, "01.07.2026 19:00 <b></b><a href='/k'>Kitap</a>")).collect()] == [("Kitap", "01.07.2026", "19:00")]
    assert [r.link for r in pages.link_lists(page(spark, "<a href='/b'><a href='/a'><a href='/b'>"), "href='([^']+)'").collect()] == ["https://s.bel.tr/a", "https://s.bel.tr/b"]
    block = r"(?is)<h3>(.*?)</h3><em>(.*?)</em><a href=\"([^\"]+)\""
    assert [(r.title, r.date) for r in pages.blocks(page(spark, '<h3>A</h3><em>1 Mayıs 2026</em><a href="/x">x</a>'), block, {"title": 1, "date": 2, "link": 3}).collect()] == [("A", "1 Mayıs 2026")]
    assert [r.link for r in pages.blocks(page(spark, '<a href="/y">y</a>'), block, {"title": 1, "link": 3}).collect()] == ["https://s.bel.tr/y"]
    near = pages.windows(page(spark, '<a href="/w">Ad</a><p>2 Mayıs 2026 18:00</p><span class="venue">Sahne</span>'), r'<a href="([^"]+)">(.*?)</a>').first()
    assert (near.title, near.date, near.venue) == ("Ad", "2 Mayıs 2026", "Sahne")
    posts = json.dumps([{"title": {"rendered": "Gösteri"}, "link": "https://s.bel.tr/g", "acf": {"event_date": "2026-07-09"}, "venue": ["Park"], "excerpt": {"rendered": "<p>özet</p>"}}, {"title": ""}])
    assert [(r.title, r.date, r.venue) for r in pages.posts_or_cards(page(spark, posts)).collect()] == [("Gösteri", "2026-07-09", "Park")]
    told = json.dumps([{"title": "Oyun", "content": "12 Mart 2026 bitti, 5-7 Temmuz 2026 saat 20:30", "date": "2026-03-01T10:00:00"}])
    as_of = F.lit("2026-06-01 00:00:00").cast("timestamp")
    assert [(r.date, r.time) for r in pages.posts_or_cards(page(spark, told)).collect()] == [("12 Mart 2026", "20:30")]
    assert [(r.date, r.time) for r in pages.posts_or_cards(page(spark, told), as_of).collect()] == [("05.07.2026", "20:30")]
    both = page(spark, html).unionByName(page(spark, lines, "lines", "Two", 1)).unionByName(page(spark, html, "none", "Three", 2))
    assert {(r.site, r.title) for r in pages.scan(both, 1).collect()} == {("Site", "Yaz Konseri 5 Temmuz 2026 20:00"), ("Two", "Caz Gecesi")}


def test_details_and_web_events(spark):
    found = pages.link_lists(page(spark, "<a href='/a'>"), "href='([^']+)'")
    detail = spark.createDataFrame([("https://s.bel.tr/a", "<h1>Büyük Konser</h1><p>Yer: Meydan</p><p>Tarih: 5 Temmuz 2026</p><p>Saat: 21:00</p><p>Ücret: 100 TL</p>" + " " * 200)], "link string, html string")
    full = pages.fill_from_details(found, detail, required=True).withColumn("city", F.lit("İstanbul"))
    (row,) = builders.from_web(full, 120, AS_OF).collect()
    occ = row.occurrences[0]
    assert (row.title, row.type, occ.venue_name, occ.local_date, occ.local_time, occ.sources[0].price.min_value) == ("Büyük Konser", "concert", "Meydan", "2026-07-05", "21:00", 100.0)
    assert pages.fill_from_details(found, detail.limit(0), required=True).count() == 0


def test_rss(spark, tmp_path):
    path = landed(tmp_path, "r.xml", "<rss><channel><item><title>Sergi</title><link>https://i/1</link><description>&lt;p&gt;ücretsiz&lt;/p&gt;</description><pubDate>Tue, 07 Jul 2026 14:00:00 +0300</pubDate><category>sanat</category></item><item><title>Uzak</title><link>https://i/2</link><pubDate>2027-07-07</pubDate></item></channel></rss>")
    (row,) = builders.from_rss(readers.xml_items(spark, path, readers.RSS), "İstanbul", 120, AS_OF).collect()
    assert (row.type, row.occurrences[0].local_time, row.occurrences[0].sources[0].price.is_free, row.external_id[:4]) == ("exhibition", "14:00", True, "rss-")


def test_readers_and_sinks(spark, tmp_path):
    assert readers.events(spark, "file:///nowhere").count() == 0
    assert readers.events(spark, landed(tmp_path, "bad.json", "[{")).count() in (0, 1) and readers.events(spark, landed(tmp_path, "obj.json", "{}")).count() == 0
    got = readers.events(spark, landed(tmp_path, "e.json", [{"title": "a", "occurrences": [{"local_date": "2026-01-01", "sources": [{"provider": "p"}]}]}]))
    assert got.first().occurrences[0].sources[0].provider == "p" and set(f.name for f in schema_of(EVENT)) <= set(got.columns)
    assert readers.json_items(spark, landed(tmp_path, "w.json", {"posts": [{"a": 1}, 2]})).count() == 1
    sinks.write_provider(got.drop("path", "place"), f"file://{tmp_path}/out", AS_OF)
    assert spark.read.json(f"file://{tmp_path}/out/stats").first().total_events == 1
    merged = got.withColumn("providers", F.array(F.lit("p"), F.lit("q")))
    sinks.write_merged(merged, merged, f"file://{tmp_path}/merged")
    assert spark.read.json(f"file://{tmp_path}/merged/combinations").first().combination == "p+q"


def test_dims(spark):
    assert dims.queries(spark, ["Ankara", "Bursa"]).count() == 20
    assert [(r.url, r.kind) for r in dims.feed_sources(spark, "https://a/rss, ftp://b,https://kultursanat.x/").collect()] == [("https://a/rss", "rss"), ("https://kultursanat.x/", "windows")]
    row = spark.createDataFrame([("Kadıköy Mah. 5, Kadıköy/İstanbul", "x bursa y", "IZMIR")], "a string, b string, c string").select(dims.city_in_address("a").alias("a"), dims.city_in_address("b").alias("b"), dims.city("c").alias("c")).first()
    assert tuple(row) == ("İstanbul", "Bursa", "İzmir")


def test_numbers(spark):
    df = number_rows(spark.range(1000).repartition(7), "id")
    assert [(r.id, r.ordinal) for r in df.collect() if r.id != r.ordinal] == []


@pytest.mark.parametrize("parts", [8, 200])
def test_numbers_of_wide_rows(spark, parts):
    """Adaptive execution merges partitions by their width; no row is lost or misplaced."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        wide = spark.range(500_000).select(F.xxhash64("id").alias("key"), F.col("id").alias("_part"), F.expr("repeat('x', cast(id % 300 as int))").alias("text"))
        got = number_rows(wide, "key")
        rank = wide.select("key").toPandas().key.sort_values().reset_index(drop=True)
        back = got.select("key", "ordinal", "_part", F.length("text").alias("n")).toPandas().sort_values("ordinal")
        assert got.columns == ["key", "_part", "text", "ordinal"]
        assert (back.ordinal.to_numpy() == range(500_000)).all() and (back.key.to_numpy() == rank.to_numpy()).all()
        assert (back.n == back._part % 300).all()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trends(spark, tmp_path):
    cells = trends.plan(spark, ["Ankara"], ["concert", "food"])
    candidates = spark.createDataFrame([("Ankara", "concert", i, f"e{i}", t, "2026-06-09") for i, t in enumerate(["Rock Gecesi", "Athena Konseri", "Duman Konseri", "Sessiz"])] + [("Ankara", "concert", 9, "late", "Athena", "2026-07-09"), ("Ankara", "food", 0, "f", "Yemek", None)], "city string, category string, ordinal int, id string, title string, next_date string")
    searches = spark.createDataFrame([("Ankara", "concert", 0, "athena konseri bilet"), ("Ankara", "concert", 1, "başka şey")], "city string, category string, position int, title string")
    got = {r.category: r for r in trends.weekly(cells, candidates, searches, F.lit("2026-06-01").cast("date")).collect()}
    assert [e.id for e in got["concert"].events] == ["e1", "e2"] and got["concert"].is_trending and got["concert"].trending_topics == ["athena konseri bilet"]
    assert [e.id for e in got["food"].events] == ["f"] and not got["food"].is_trending
    sinks.write_report(trends.weekly(cells, candidates, searches, F.lit("2026-06-01").cast("date")), f"file://{tmp_path}/t")
    text = "\n".join(r.value for r in spark.read.text(f"file://{tmp_path}/t/markdown").collect())
    assert "## Ankara" in text and "- 9 Haz 2026 Athena Konseri" in text


def test_lifecycle(spark, tmp_path):
    stored = spark.createDataFrame([(1, "a", "2026-06-01"), (2, "a", "2026-05-01"), (3, "b", "2026-06-01")], "k int, provider string, seen string")
    seen = spark.createDataFrame([(1,)], "k int")
    assert {r.k: r.is_active for r in lifecycle.sweep(stored, seen, ["k"], "a").collect()} == {1: True, 2: False, 3: True}
    up = lifecycle.upsert(stored, spark.createDataFrame([(2, "z", "now")], "k int, provider string, seen string"), ["k"], "r1")
    assert {r.k: r.provider for r in up.collect()} == {1: "a", 2: "z", 3: "b"}
    assert {r.k: r.is_active for r in lifecycle.retire(stored.withColumn("is_active", F.lit(True)), "2026-06-02", "seen").collect()} == {1: True, 2: False, 3: True}
    sent = lifecycle.deliver(spark.range(120).select("id"), lambda chunk, rows: chunk != 1 and len(rows) <= 50, ["id"], waits=(0, 0), pause=0)
    assert {r.chunk: (r.n_rows, r.status, r.attempts) for r in sent.collect()} == {0: (50, "success", 1), 1: (50, "failed", 3), 2: (20, "success", 1)}
    assert tuple(lifecycle.run_status(sent).first()) == (120, 70, "partial_failure")


def test_streams_equal_batches(spark, sf, tmp_path):
    src = f"file://{tmp_path}/in"
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(src)
    stream = spark.readStream.schema(events.schema).parquet(src)
    first = lifecycle.dedup_stream(stream, ["user_id", "event_type"], late="365 days")
    lifecycle.run_available(first, f"file://{tmp_path}/out", f"file://{tmp_path}/c1")
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == events.select("user_id", "event_type").distinct().count()
    lifecycle.upsert_stream(stream.select("event_id", "value"), f"file://{tmp_path}/table", f"file://{tmp_path}/c2", ["event_id"], "r")
    assert spark.read.parquet(f"file://{tmp_path}/table").where("is_active").count() == events.count()
    counts = lifecycle.hourly(stream.withWatermark("ts", "1 hour"))
    q = counts.writeStream.format("memory").queryName("hourly").outputMode("complete").option("checkpointLocation", f"file://{tmp_path}/c3").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("hourly").collect())) == sorted(map(tuple, lifecycle.hourly(events).collect()))


@pytest.mark.parametrize("missing", ["playbill.llm", "corpus_pipeline"])
def test_entry_without_corpus(missing):
    import subprocess
    import sys

    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout) >= 40, out.stderr


def test_unread_strategies_are_an_error(spark):
    page = [("s", 0, 0, "Ankara", "https://x.example/", '[{"title": "Konser", "link": "https://x.example/1"}]', "pass"), ("t", 1, 0, "Ankara", "https://y.example/", "<a href='/k'>Bir Konser</a> 05.06.2026 20:00", "windows")]
    rows = spark.createDataFrame(page, "site string, site_rank int, page_rank int, city string, base_url string, html string, strategy string")
    got = pages.scan(rows).select("site", "title", "link").collect()
    assert sorted(map(tuple, got)) == [("s", "Konser", "https://x.example/1"), ("t", "Bir Konser", "https://y.example/k")]
    with pytest.raises(ValueError, match="own"):
        pages.scan(rows.withColumn("strategy", F.lit("own")))
    assert pages.scan(rows.withColumn("strategy", F.lit("own")), more={"own": pages.plain_windows}).count() == 1


def test_replacement_that_breaks_off(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    old, new = spark.range(3), spark.range(10)
    lifecycle.put_in_place(old, path)
    new.write.parquet(f"{path}.next")  # it dies before the move
    assert lifecycle.recover(spark, path) and spark.read.parquet(path).count() == 3
    (tmp_path / "table").rename(tmp_path / "table.old")  # it dies between the moves
    assert lifecycle.recover(spark, path) and spark.read.parquet(path).count() == 10
    lifecycle.put_in_place(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4 and {p.name for p in tmp_path.iterdir()} == {"table"}
    assert not lifecycle.recover(spark, f"file://{tmp_path}/none")


def test_xml_order(spark, tmp_path):
    body = "<rss>" + "".join(f"<item><title>t{i}</title><id>{(i * 7) % 50}</id></item>" for i in range(50)) + "</rss>"
    rows = readers.xml_items(spark, landed(tmp_path, "f.xml", body), ["title", "id"]).orderBy("path", "block", "place").collect()
    assert [r.title for r in rows] == [f"t{i}" for i in range(50)]


def test_entities_in_scans(spark):
    """All entities are resolved in what a user gets from pages, details, posts and builders, however they are written."""
    card = "<a href='/m' title='x'>M&uuml;zik &ccedil;al&#305;&#351;ma&rsquo;s&#x131; &amp;lt; konser 5 A&#287;ustos 2026 20:00</a>"
    want = "Müzik çalışma’sı &lt; konser 5 Ağustos 2026 20:00"
    (row,) = pages.cards(page(spark, card)).collect()
    assert (row.title, row.date, row.time) == (want, "5 Ağustos 2026", "20:00")
    post = json.dumps([{"title": {"rendered": "Caz &quot;&ccedil;&quot; &#8211; &#34;x&#34;"}, "content": "a&#10;b &lt;i&gt; &hellip;", "acf": {"venue": "Salon &Ouml;"}, "date": "2026-07-01"}])
    (row,) = pages.posts_or_cards(page(spark, post)).collect()
    assert (row.title, row.venue, row.description) == ('Caz "ç" – "x"', "Salon Ö", "a b <i> …")
    found = pages.link_lists(page(spark, "<a href='/a'>"), "href='([^']+)'")
    detail = spark.createDataFrame([("https://s.bel.tr/a", "<h1>B&uuml;y&uuml;k Konser</h1><p>Yer: Meydan &Ccedil;</p><p>Tarih: 5 Temmuz 2026</p><p>Saat: 21:00</p>" + " " * 200)], "link string, html string")
    full = pages.fill_from_details(found, detail, required=True).withColumn("city", F.lit("İstanbul"))
    (row,) = builders.from_web(full, 120, AS_OF).collect()
    assert (row.title, row.occurrences[0].venue_name) == ("Büyük Konser", "Meydan Ç")


def test_dates_of_pages_name_a_month(spark):
    from playbill.functions.dates import MONTHS
    from playbill.sources.pages import date_time

    texts = ["29 tothontith 4647", "12 Bilet 2026 14:00, 5 Ağustos 2026 saat 20.30", "3 SUBAT, 2026", "7 Şub 2026", "8 martin 2026 9.10.2026", *(f"1 {m} 2026" for m in MONTHS)]
    day, clock = date_time(F.col("t"))
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(day.alias("d"), clock.alias("c")).collect()
    assert [tuple(r) for r in got[:5]] == [("", ""), ("5 Ağustos 2026", "20:30"), ("3 SUBAT, 2026", ""), ("7 Şub 2026", ""), ("9.10.2026", "")]
    assert [r["d"] for r in got[5:]] == texts[5:]
