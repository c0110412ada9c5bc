"""Vectors for the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playbill.functions import dates, field_prices, html, prices, rules, text, urls
from playbill.operators import filters, provenance


@pytest.fixture(scope="module")
def ev(spark):
    """Evaluate a column function on one row of values."""

    def run(fn, *values, types=None):
        names = [f"c{i}" for i in range(len(values))]
        ddl = ", ".join(f"{n} {t}" for n, t in zip(names, types or ["string"] * len(values)))
        return spark.createDataFrame([tuple(values)], ddl).select(fn(*names).alias("x")).first().x

    return run


@pytest.mark.parametrize("value,want", [("ATHENA  Konseri!", "athena konseri"), ("İstanbul", "istanbul"), ("Iğdır", "igdir"), (None, ""), ("a_b c", "a_b c"), ("ÇĞİÖŞÜ ñ é", "cgiosu n e"), ("GÃ¼n", "gun"), (" \t ", "")])
def test_match_key(ev, value, want):
    assert ev(text.normalize_for_match, value) == want
    assert ev(text.normalize_for_match_exact, value) == want


def test_match_key_modes_agree(spark, sf):
    both = spark.read.parquet(f"{sf}/documents.parquet").select(text.normalize_for_match("text").alias("a"), text.normalize_for_match_exact("text").alias("b"))
    assert both.where("a <> b").count() == 0


def test_cleaning(ev):
    assert ev(text.clean_text, " a &amp; b\n\t&lt;c&gt; ") == "a & b <c>"
    assert ev(text.strip_html, "<p>a<br>b</p>") == "a b"
    assert ev(text.unescape_fixpoint, "&amp;amp;lt;") == "<"
    assert ev(text.strip_blocks, "<p>a</p><p> </p><div>b <b>c</b></div>") == "a\nb c"
    assert ev(text.fix_mojibake, "MÃ¼zik") == "Müzik" and ev(text.fix_mojibake, "Ãzel 中") == "Ãzel 中"
    assert ev(lambda c: text.truncate(c, 5), "abcd efgh") == "abcd..." and ev(lambda c: text.truncate(c, 5), "abcde") == "abcde"
    assert ev(text.slug_title, "https://x/y/123-yaz-konseri/") == "yaz konseri"
    assert ev(lambda a, b: text.strip_title_prefix(a, b), "KONSER - güzel bir gece", "Konser") == "güzel bir gece"
    assert ev(text.trend_fold, "İŞÇĞÖÜ") == "iscgou"
    assert ev(text.tokens, "ab abc abc  abcd") == ["abc", "abcd"]


@pytest.mark.parametrize("title,want", [("Sezen Aksu Konseri", "Sezen Aksu"), ("Duman - Yaz Turnesi (Ek Seans)", "Duman"), ("Açık Hava Festivali", None), ("2024 Gala Konseri", None), ("Oyun", None), ("Ali Veli Stand Up", "Ali Veli")])
def test_performer(ev, title, want):
    assert ev(text.performer, title) == want


@pytest.mark.parametrize("url,want", [("HTTPS://user@www.A.com:80/x/?q=1#f", "a.com/x"), ("a.com", "a.com"), ("http://a.com/", "a.com/"), ("//b.org/p/", "b.org/p"), ("", "")])
def test_url_key(ev, url, want):
    assert ev(urls.url_key, url) == want


def test_urls(ev):
    assert ev(lambda u: urls.host_in(u, "a.com"), "http://x.a.com/") is True and ev(lambda u: urls.host_in(u, "a.com"), "http://xa.com") is False
    join = lambda x: ev(lambda a, b: urls.absolute(a, b), x, "https://h.com/d/p.html?q")
    assert [join(x) for x in ("/r", "s", "//o.com/x", "http://z", "")] == ["https://h.com/r", "https://h.com/d/s", "https://o.com/x", "http://z", "https://h.com/d/p.html?q"]
    assert ev(lambda u: urls.set_params(u, {"a": "9", "b": "x y"}), "http://h/p?a=1&c=2#z") == "http://h/p?c=2&a=9&b=x+y#z"
    assert ev(lambda u: urls.redirect_target(u, "biletix.com"), "https://t.net/c?u=https%3A%2F%2Fwww.biletix.com%2Fperformance%2F3AB%2F001%2FTURKIYE%2Ftr%3Fx%3D1") == "https://www.biletix.com/etkinlik/3AB/TURKIYE/tr"
    assert ev(lambda u: urls.redirect_target(u, "biletix.com"), "https://other.com/x") is None


def at(*x):
    return dt.datetime(*x)


def test_dates(ev):
    assert ev(dates.turkish, "22 Mart 2026, Pazar 14:00") == at(2026, 3, 22, 14) and ev(dates.turkish, "x") is None and ev(dates.turkish, "31 Şubat 2026") is None
    assert ev(dates.dotted, "05.07.2026 09:30") == at(2026, 7, 5, 9, 30)
    feed = lambda x: ev(dates.feed_instant, x)
    assert feed("1767225600") == feed("1767225600000") == at(2026, 1, 1)
    assert feed("2026-01-01") == at(2025, 12, 31, 21) and feed("2026-01-01T10:00:00Z") == at(2026, 1, 1, 10) and feed("2026-01-01T10:00:00+03:00") == at(2026, 1, 1, 7)
    assert feed("Tue, 22 Mar 2026 14:00:00 +0300") == at(2026, 3, 22, 11) and feed("22 Mart 2026") == at(2026, 3, 21, 21) and feed("nonsense") is None
    assert ev(dates.near_time, "Program 5 Mayıs 2026 Salı saat 20.30 salon") == at(2026, 5, 5, 17, 30)
    search = lambda x: ev(lambda a, b: dates.search_instant(a, b), x, at(2026, 6, 1), types=["string", "timestamp"])
    assert search("Jun 8, 7:30 PM") == at(2026, 6, 8, 16, 30) and search("Jan 3") == at(2027, 1, 3, 17) and search("2026-07-01") == at(2026, 7, 1, 17) and search("soon") == at(2026, 6, 1)
    assert ev(dates.day_range, "5-7 mayıs") == [5, 6, 7] and ev(dates.day_range, "5 ve 6 mayıs") == [5, 6] and ev(dates.day_range, "7-5 mayıs") is None
    assert ev(dates.display_date, dt.date(2026, 8, 2), types=["date"]) == "2 Ağu 2026" and ev(dates.display_date, None, types=["date"]) == "?"
    assert ev(dates.date_key, "2026-01-02T03:04:05Z") == "2026-01-02" and ev(dates.date_key, "Her Gün") == "her gun"


@pytest.mark.parametrize(
    "value,want",
    [("1.200,50 TL - 2.450,75 TL", (1200.5, 2450.75)), ("500", (500.0, 500.0)), ("Ücretsiz", (0.0, 0.0)), ("Fiyat bilgisi yok", (None, None)), ("", (None, None)), (None, (None, None)), ("1,234.5", (1234.5, 1234.5)), ("1. Kategori 750 TL", (750.0, 750.0)), ("1.500", (1500.0, 1500.0)), ("12,5", (12.5, 12.5)), ("99999999999", (None, None))],
)
def test_price_range(ev, value, want):
    assert tuple(ev(prices.price_range, value)) == want


def test_prices(ev):
    p = ev(lambda c: prices.text_price(c, "s", 0.8, "m"), "100 - 250 TL")
    assert (p.min_value, p.max_value, p.text, p.is_unknown, p.resolution.strategy, p.resolution.confidence) == (100.0, 250.0, "100.00 - 250.00 TRY", False, "s", 0.8)
    strategies = [ev(lambda c: prices.text_price(c, "s", 0.8, "m"), x).resolution.strategy for x in ("", "tba", "bedava", "yok")]
    assert strategies == ["s_empty", "s_unknown_marker", "s_free_marker", "s_no_numeric"]
    one = ev(lambda a, b: prices.stated_price(a, b, "s", 0.9, "m"), 5.0, None, types=["double", "double"])
    assert (one.min_value, one.max_value) == (5.0, 5.0)
    both = ev(lambda a, b: prices.first_known(prices.text_price(a, "a", 1.0, "m"), prices.text_price(b, "b", 1.0, "m")), "", "tbd")
    assert both.resolution.strategy == "b_unknown_marker_all_candidates_unknown"
    assert tuple(ev(prices.partner_price, "1.250 TL")) == (1.25, False, False) and tuple(ev(prices.partner_price, "Ücretsiz")) == (None, False, True) and tuple(ev(prices.partner_price, "1.250,50")) == (None, False, True)
    assert tuple(ev(prices.feed_price, "-3")) == (None, False, True) and tuple(ev(prices.feed_price, "0 TRY")) == (0.0, True, False)


def test_resolve_prices(spark):
    rows = [("a", "B", 200, "TRY", False), ("a", "a", 200, "TRY", False), ("a", "c", 5, "USD", False), ("b", "x", None, "TRY", False), ("c", "x", 0, "TRY", False), ("d", "x", 1250, "EUR", False), ("e", "x", 3, "TRY", False), ("e", "y", 4, "TRY", False)]
    df = spark.createDataFrame(rows, "k string, provider_name string, min_price int, currency string, is_free boolean").withColumn("min_price", F.col("min_price").cast("decimal(12,2)"))
    got = {r.k: r for r in prices.resolve_prices(df, ["k"]).collect()}
    assert got["a"].all_prices_equal and got["a"].display_price_text == "5 TL'den baslayan" and [o.provider_name for o in got["a"].provider_prices] == ["a", "B", "c"]
    assert got["b"].display_price_text == prices.NO_PRICE_TEXT and not got["b"].all_prices_equal
    assert got["c"].is_free and got["c"].display_price_text == "Ucretsiz"
    assert got["d"].display_price_text == "1,250 €" and not got["e"].all_prices_equal


def test_html(ev):
    page = "<html><head><title>T</title><meta name='description' content='About \"it\"'><meta property=\"event:price\" content=\" 120 TL \"></head><body><h1> </h1><p>Yer: Salon A</p><div>Tarih : 5 Mayıs</div><img src='/i.png'></body></html>"
    assert ev(html.title, page) == "T" and ev(html.meta_description, page) == 'About "it"'
    assert ev(lambda c: html.label_value(c, "Mekan", "Yer"), page) == "Salon A" and ev(lambda c: html.label_value(c, "Tarih"), page) == "5 Mayıs"
    assert ev(lambda a, b: html.first_image(a, b), page, "https://h.com/x") == "https://h.com/i.png"
    assert ev(lambda c: html.meta_price(c, 0), page) == "120 TL" and ev(lambda c: html.meta_price(c, 10_000), page) is None
    ld = lambda *blocks: "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)
    price = lambda x: ev(lambda c: html.jsonld_price(c, 0), x)
    assert tuple(price(ld("{bad", '{"@type":"Event","offers":[{"price":"150,5","priceCurrency":"TRY"},{"lowPrice":90,"highPrice":300},{"highPrice":200}]}'))) == (90.0, 200.0, "TRY")
    assert tuple(price(ld('{"@type":"ItemList","itemListElement":[{"item":{"@type":"Event"}},{"item":{"offers":{"price":7,"currency":"EUR"}}}]}'))) == (7.0, None, "EUR")
    assert price(ld('{"offers":{}}')) is None and price("<p>") is None
    j = '{"a":{"rendered":"<b>x</b> y"},"b":["", {"name":"z"}],"c":"t","meta":{"p":"5"},"acf":{"q":["6"]}}'
    assert [ev(lambda c: html.json_text(c, p), j) for p in ("$.a", "$.b", "$.c", "$.no")] == ["x y", "z", "t", None]
    assert ev(lambda c: html.nested(c, "q", "p"), j) == "5"


def test_rules(ev):
    assert ev(rules.shared_type, "Yaz Konseri") == "concert" and ev(rules.shared_type, "başka") == "experience"
    assert ev(lambda a, b, c: rules.segment_type(a, b, c), "X", "Music", "") == "concert" and ev(lambda a, b, c: rules.segment_type(a, b, c), "Stand-up gecesi", "Sports", "") == "standup"
    assert ev(lambda a, b, c: rules.segment_type(a, b, c), "X", None, "comedy") == "standup" and ev(lambda a, b, c: rules.segment_type(a, b, c), "X", None, "") == "show"
    assert ev(lambda a, b, c: rules.search_type(a, b, c), "Arena gecesi", None, "sports") == "festival" and ev(lambda a, b, c: rules.search_type(a, b, c), "A vs B", None, "x") == "match"
    assert ev(lambda a, b, c: rules.activity_type(a, b, c), ["Müze"], "x", "y", types=["array<string>", "string", "string"]) == "exhibition"
    assert ev(lambda a, b, c: rules.activity_type(a, b, c), [], "Tekne turu", "y", types=["array<string>", "string", "string"]) == "activity"
    assert ev(rules.partner_type, None) == "other" and ev(rules.partner_type, "Yoga") == "yoga" and ev(rules.partner_type, "Konser") == "concert"
    assert ev(lambda a, b: rules.feed_type(a, b), "tiyatro", "cocuk-tiyatrosu") == "kids" and ev(lambda a, b: rules.feed_type(a, b), "spor", "") is None


def test_filters(ev):
    assert ev(lambda a, b: filters.structural_title(a, b), "Kadıköy Kültür Merkezi", "Kadıköy") is True and ev(lambda a, b: filters.structural_title(a, b), "Kadıköy Yaz Şenliği", "Kadıköy") is False
    week = lambda x: ev(lambda c: filters.in_next_week(c, F.lit("2026-06-01").cast("date")), x)
    assert [week(x) for x in ("2026-06-08", "2026-06-14", "2026-06-15", "2026-06-01", None, "?", "2099-12-31")] == [True, True, False, False, True, True, True]


def test_provenance(ev, spark):
    assert ev(provenance.canonical_providers, ["bilet.com", "serpapi_google_events|ticketmaster", "unknown", "Biletinial", None], types=["array<string>"]) == ["Ticketmaster", "SerpAPIEvents", "Biletinial", "bilet.com"]
    assert ev(provenance.distinct_links, ["http://A.com/x?1", "https://www.a.com/x", " ", "b"], types=["array<string>"]) == ["http://A.com/x?1", "b"]
    towns = {"Kadıköy Belediyesi": ("kadikoy.bel.tr", "kadikoy"), "Kartal Belediyesi": ("kartal.bel.tr", "kartal")}
    row = spark.createDataFrame([(["municipal_web", "ticketmaster"], ["http://www.kadikoy.bel.tr/a", "http://sile.bel.tr"], ["Kartal Meydanı", None])], "providers array<string>, source_urls array<string>, candidate_texts array<string>")
    got = provenance.payload(row, towns).first()
    assert got.provider_tags == ["Ticketmaster", "Kadıköy Belediyesi", "Sile", "Kartal Belediyesi"] and got.provider_label == "Ticketmaster, Kadıköy Belediyesi, Sile, Kartal Belediyesi"


def test_soonest(spark):
    row = spark.sql("select array(date'2026-05-01', null, date'2026-07-01', date'2026-06-10') as a, array(date'2026-05-02', date'2026-05-01') as b, cast(array() as array<date>) as c, date'2026-06-01' as now")
    got = row.select(dates.soonest("a", "now"), dates.soonest("b", "now"), dates.soonest("c", "now")).first()
    assert [str(x) for x in got] == ["2026-06-10", "2026-05-01", "None"]


def test_event_date(spark):
    vectors = [
        ("Konser 5-7 Mayıs 2026 saat 20.30'da", None, "2026-05-05 17:30"),
        ("1 Mart 2026, 12 Mart 2026 ve 9 Mart 2026 19:00", None, "2026-03-09 16:00"),
        ("12 Mart", "2026-03-20 10:00", "2027-03-11 21:00"),
        ("5 ve 8 Mart", "2026-03-01 10:00", "2026-03-04 21:00"),
        ("05.05.2025 ile 06/06/2025 18:00", None, "2025-05-05 15:00"),
        ("8 Mayıs 2026 yine 08.05.2026 21:00", None, "2026-05-08 05:05"),  # the first figures with a dot are its time
        ("8 Mayıs 2026" + " -" * 80 + " 08.05.2026 21:00", None, "2026-05-08 18:00"),
        ("30 Şubat 2026", None, None),
        ("saat 20:30", None, None),
        (None, None, None),
    ]
    rows = spark.createDataFrame([(i, *v) for i, v in enumerate(vectors)], "i int, said string, posted string, want string")
    at = dates.event_date("said", F.col("posted").cast("timestamp"), F.lit("2026-03-04 12:00:00").cast("timestamp"))
    assert [r.x for r in rows.select("i", F.date_format(at, "yyyy-MM-dd HH:mm").alias("x")).orderBy("i").collect()] == [v[2] for v in vectors]


def test_post_price(spark):
    scan = "wp_rest_meta_scan"
    unknown = (None, None, "TRY", scan + "_all_candidates_unknown", 0.0)
    vectors = [
        ('{"meta":{"event_price":"150 - 200 TL"}}', (150.0, 200.0, "TRY", scan, 0.65)),
        ('{"acf":{"ticket_price":"1.200,50","currency":"eur"}}', (1200.5, 1200.5, "EUR", scan, 0.65)),
        ('{"is_free":true,"price":"90"}', (0.0, 0.0, "TRY", "wp_rest_free_marker_free_marker", 0.8)),
        ('{"_price":"9","price":"0"}', (0.0, 0.0, "TRY", "wp_rest_free_marker_free_marker", 0.8)),
        ('{"price":"gişede","currency":"USD"}', unknown),
        ('{"price":null,"meta":{"price":"50"}}', unknown),
        ("[1]", unknown),
        (None, unknown),
    ]
    rows = spark.createDataFrame([(i, v[0]) for i, v in enumerate(vectors)], "i int, post string")
    got = [r.p for r in rows.select("i", field_prices.post_price("post", F.lit("a.bel.tr")).alias("p")).orderBy("i").collect()]
    assert [(p.min_value, p.max_value, p.currency, p.resolution.strategy, p.resolution.confidence) for p in got] == [v[1] for v in vectors]
    assert all(p.is_unknown == (p.min_value is None) and p.is_free == (p.min_value == 0.0) and p.resolution.source == "wp_rest:a.bel.tr" for p in got)


def test_calendar_price(spark):
    cost = "tribe_events_cost_field"
    unknown = (None, None, cost + "_all_candidates_unknown", 0.0)
    vectors = [
        ('{"cost":"150 TL"}', (150.0, 150.0, cost, 0.7)),
        ('{"cost":"50","cost_min":"50","cost_max":"120 ₺"}', (50.0, 120.0, cost, 0.7)),
        ('{"cost":"","cost_min":0}', (0.0, 0.0, cost + "_free_marker", 0.75)),
        ('{"cost":"Ücretsiz"}', (0.0, 0.0, cost + "_free_marker", 0.75)),
        ('{"title":"x"}', unknown),
        ('{"cost":"kapıda"}', unknown),
        (None, unknown),
    ]
    rows = spark.createDataFrame([(i, v[0]) for i, v in enumerate(vectors)], "i int, event string")
    got = [r.p for r in rows.select("i", field_prices.calendar_price("event").alias("p")).orderBy("i").collect()]
    assert [(p.min_value, p.max_value, p.resolution.strategy, p.resolution.confidence) for p in got] == [v[1] for v in vectors]
