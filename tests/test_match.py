"""Matching and merging against a model that takes records one after the other."""

import random

import pytest

from playbill.operators import dedup, dto, match, provenance, stats
from playbill.schema import EVENT, schema_of


def model(records):
    """records in order: (ordinal, is_base, ids, links, show, venue) -> {ordinal: leader}."""
    by_id, by_link, by_show, out = {}, {}, {}, {}
    for o, base, ids, links, show, venue in records:
        hit = None
        if not base:
            hit = next((by_id[k] for k in ids if k in by_id), None)
            hit = hit if hit is not None else next((by_link[k] for k in links if k in by_link), None)
            if hit is None and show in by_show:
                hit = next((x for x, v in by_show[show] if venue and v == venue), by_show[show][0][0])
        out[o] = o if hit is None else hit
        if hit is None:
            for k in ids:
                by_id.setdefault(k, o)
            for k in links:
                by_link.setdefault(k, o)
            if show:
                by_show.setdefault(show, []).append((o, venue))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_leaders(spark, seed):
    rng = random.Random(seed)
    records, shift = [], 0
    for case in range(40):
        n, base = rng.randint(2, 25), rng.randint(0, 4)
        for i in range(n):
            pick = lambda p, k: sorted({f"{case}{p}{rng.randrange(8)}" for _ in range(rng.randint(0, k))})
            records.append((i * 1000 + case, i < base, pick("i", 2), pick("u", 2), rng.choice([None, f"{case}t{rng.randrange(3)}"]), rng.choice(["", "v1", "v2"])))
        shift += n
    rng.shuffle(records)
    df = spark.createDataFrame(records, "ordinal long, is_base boolean, id_keys array<string>, url_keys array<string>, show_key string, venue_key string")
    got = {r.ordinal: r.leader for r in match.assign_leaders(df).collect()}
    assert got == model(sorted(records))


    few = {r.ordinal: r.leader for r in match.assign_leaders(df, pass_records=7).collect()}  # by components, large ones piece by piece
    assert few == got


def test_strict_venue(spark):
    rows = [(0, True, [], [], "s", "v1"), (1, False, [], [], "s", "v2"), (2, False, [], [], "s", "v2"), (3, False, [], [], "s", ""), (4, False, [], [], "s", "v1")]
    df = spark.createDataFrame(rows, "ordinal long, is_base boolean, id_keys array<string>, url_keys array<string>, show_key string, venue_key string")
    assert {r.ordinal: r.leader for r in match.assign_leaders(df, strict_venue=True).collect()} == {0: 0, 1: 1, 2: 1, 3: 3, 4: 0}
    assert {r.ordinal: r.leader for r in match.assign_leaders(df).collect()} == dict.fromkeys(range(5), 0)


@pytest.mark.parametrize("most", [100_000, 3000])
def test_leaders_of_a_long_chain(spark, monkeypatch, most):
    """10,000 records each of which shares a key with the next: few steps, whatever the length."""
    steps = []
    for name in ("_settle_at_once", "_settle_in_order"):
        monkeypatch.setattr(match, name, lambda *a, f=getattr(match, name): steps.append(1) or f(*a))
    n = 10_000
    df = spark.range(n).selectExpr("id as ordinal", "false as is_base", "array(cast(id as string), cast(id + 1 as string)) as id_keys", "cast(array() as array<string>) as url_keys", "cast(null as string) as show_key", "'' as venue_key")
    got = {r.ordinal: r.leader for r in match.assign_leaders(df, pass_records=most).collect()}
    assert got == {i: i - i % 2 for i in range(n)}
    assert len(steps) <= 14


def event(title, source, *occurrences, **more):
    occ = [{"local_date": d, "local_time": t, "venue_name": v, "sources": [{"provider": p, "external_id": e, "source_url": u} for p, e, u in s]} for d, t, v, s in occurrences]
    return {"title": title, "city_name": "İstanbul", "source": source, "occurrences": occ} | more


@pytest.fixture(scope="module")
def events(spark):
    schema = schema_of(EVENT)

    def make(*rows, start=0):
        from pyspark.sql import functions as F

        def fill(value, kind):
            if kind.typeName() == "struct":
                return None if value is None else tuple(fill(value.get(f.name), f.dataType) for f in kind.fields)
            if kind.typeName() == "array":
                return None if value is None else [fill(v, kind.elementType) for v in value]
            return value

        data = [(start + i, *fill(r, schema)) for i, r in enumerate(rows)]
        from pyspark.sql.types import LongType, StructField, StructType

        return spark.createDataFrame(data, StructType([StructField("ordinal", LongType()), *schema.fields])).withColumn("providers", F.coalesce("providers", F.array().cast("array<string>")))

    return make


def test_merge(events):
    base = events(event("Athena Konseri", "Ticketmaster", ("2026-07-01", "20:00", "Salon", [("Ticketmaster", "t1", "http://t/1")])))
    probes = events(
        event("ATHENA  Konseri!", "serpapi_google_events", ("2026-07-01", "21:00", "Başka", [("serpapi_events", "s1", "http://s/1"), ("serpapi_events", "s1", "http://s/1b"), ("x", None, "http://x")])),
        event("Athena konseri", "BiletimGO", ("2026-07-01", None, None, [("biletimgo", "s1", "http://b/1"), ("biletimgo", "b2", "http://b/2")]), ("2026-07-02", None, None, [("biletimgo", "b3", "http://b/3")])),
        event("Başka Gece", "BiletimGO", ("2026-07-01", None, None, [("biletimgo", "z", "http://z")])),
        start=1,
    )
    out = match.match_and_merge(base, probes).orderBy("ordinal")
    rows = out.collect()
    assert [r.title for r in rows] == ["Athena Konseri", "Başka Gece"]
    first, second = rows[0].occurrences
    assert [(s.provider, s.external_id) for s in first.sources] == [("Ticketmaster", "t1"), ("serpapi_events", "s1"), ("serpapi_events", "s1"), ("x", None), ("biletimgo", "b2")]
    assert (second.local_date, [s.external_id for s in second.sources]) == ("2026-07-02", ["b3"])
    rebuilt = provenance.rebuild(out)
    assert rebuilt.orderBy("ordinal").first().providers == ["Ticketmaster", "SerpAPIEvents", "BiletimGO", "x"]
    everything = base.unionByName(probes)
    s = stats.merge_stats(everything, rebuilt).first()
    assert (s.total_before, s.total_after, s.overlap, s.multi_provider) == (4, 2, 2, 1)
    assert sum(r.n for r in stats.combination_counts(rebuilt).collect()) == 2
    flat = dto.upload_rows(rebuilt, "run-1")
    assert flat.count() == 7 and {"localDate", "sourceUrls", "source_urls", "syncRunId"} <= set(flat.columns)


def test_labels(spark):
    known = spark.createDataFrame([(1, "f1", "l1"), (2, "f2", "l1")], "ordinal long, fingerprint string, logical_key string")
    probes = spark.createDataFrame([("f2", "l1"), ("f9", "l1"), ("f9", "l9")], "fingerprint string, logical_key string")
    got = {(r.fingerprint, r.logical_key): (r.label, r.matched) for r in match.match_labels(probes, known).collect()}
    assert got == {("f2", "l1"): ("strong", 2), ("f9", "l1"): ("probable", 1), ("f9", "l9"): ("weak", None)}


def test_dedup(events):
    rows = events(event("A!", "x", ("2026-01-01", "10:00", "v", [])), event("a", "x", ("2026-01-01", "10:00", "w", [])), event("a", "x", ("2026-01-01", "11:00", "w", [])), event("b", "x"))
    assert sorted(r.ordinal for r in dedup.dedup_shows(rows).collect()) == [0, 2, 3]


def test_fallback_and_first(spark):
    a, b = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int"), spark.createDataFrame([("x", 3), ("y", 4), (None, 5)], "k string, v int")
    assert sorted(r.v for r in dedup.fallback_union(a, b, keys=["k"]).collect()) == [1, 2, 4]
    rows = spark.createDataFrame([("x", 2, "b"), ("x", 1, "c"), (None, 5, "d"), (None, None, "e")], "k string, o int, v string")
    assert sorted((r.k or "", r.v) for r in dedup.first_by(rows, ["k"], "o").collect()) == [("", "e"), ("x", "c")]
    assert dedup.first_by(rows.select("k"), ["k"], "k").count() == 2
    assert dedup.first_by(rows.limit(0), ["k"], "o").count() == 0
