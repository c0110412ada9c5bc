"""The whole merge, from records to rebuilt events, with SQL that takes the records one after the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.operators import match, provenance
from playbill.plans.queries import query
from playbill.schema import EVENT, OCCURRENCE, SOURCE, conform
from playbill.sources.builders import struct_of

#: Providers of the probes by id, as sources spell them.
SPELLINGS = ["biletimgo", "serpapi_google_events", "zeta", "Alpha"]


def _events(rows: DataFrame, provider: Column) -> DataFrame:
    """Events of rows with ordinal, show, town, code, page, day, hall, own (its source's id) and own_page."""
    source = struct_of(SOURCE, provider=provider, external_id=F.col("own"), source_url=F.col("own_page"))
    occurrence = struct_of(OCCURRENCE, local_date=F.col("day"), venue_name=F.col("hall"), sources=F.array(source))
    made = rows.select("ordinal", F.col("show").alias("title"), F.col("town").alias("city_name"), F.col("code").alias("external_id"), F.col("page").alias("source_url"), provider.alias("source"), F.array(occurrence).alias("occurrences"), F.array().cast("array<string>").alias("providers"))
    return conform(made, EVENT)


def _rows(t: DataFrame, ordinal: Column, key: Column, nation: Column, bal: Column, base: bool) -> DataFrame:
    """Supplier and customer rows as shows; bal is the balance over its least, so no number is negative."""
    wide, narrow = F.floor(bal / 400).cast("long"), F.floor(bal / 50).cast("long")
    return t.select(
        ordinal.alias("ordinal"),
        F.concat(F.lit("Show " if base else "  SHOW  "), (nation % 5).cast("string"), F.lit("" if base else "!")).alias("show"),
        F.concat(F.lit("Town " if base else "town "), nation.cast("string")).alias("town"),
        (F.concat(F.lit("N"), narrow.cast("string")) if base else F.when(key % 3 > 0, F.concat(F.lit("n"), narrow.cast("string")))).alias("code"),
        (F.concat(F.lit("https://www.shows.example/p/"), nation, F.lit("-"), wide) if base else F.when(key % 2 > 0, F.concat(F.lit("http://shows.example/p/"), nation, F.lit("-"), wide, F.lit("/?utm_source=x")))).alias("page"),
        F.concat(F.lit("2024-06-0"), (key % 3 + 1).cast("string")).alias("day"),
        F.concat(F.lit("Hall "), (key % 4).cast("string")).alias("hall"),
        F.concat(F.lit("s" if base else "c"), (key if base else key % 700).cast("string")).alias("own"),
        F.concat(F.lit("https://s.example/" if base else "https://c.example/"), (key if base else key % 400).cast("string")).alias("own_page"),
    )


@query(
    r"""
with recursive suppliers as (
  select s_suppkey as ordinal, true as is_base, s_nationkey as nation, s_suppkey as k, s_acctbal + 1000 as bal from supplier),
customers as (
  select c_custkey + 10000000, false, c_nationkey, c_custkey, c_acctbal + 1000 from customer),
keyed as (
  select ordinal, is_base, k,
         case when is_base or k % 3 > 0 then 'n' || floor(bal / 50)::bigint end as code, case when is_base then 's' || k else 'c' || k % 700 end as own,
         case when is_base or k % 2 > 0 then 'p/' || nation || '-' || floor(bal / 400)::bigint end as page, case when is_base then 's/' || k else 'c/' || k % 400 end as own_page,
         (nation % 5) || '|' || (k % 3 + 1) || '|' || nation as what, k % 4 as hall, k % 3 + 1 as day,
         case when is_base then 'Ticketmaster' else ['BiletimGO', 'SerpAPIEvents', 'zeta', 'Alpha'][k % 4 + 1] end as provider
  from (select * from suppliers union all select * from customers)),
probes as (select row_number() over (order by ordinal) as i, * from keyed where not is_base),
taken(i, ordinal, leader, leaders) as (
  select 0::bigint, null::bigint, null::bigint, (select list({'o': ordinal, 'ids': [code, own], 'pages': [page, own_page], 'what': what, 'hall': hall} order by ordinal) from keyed where is_base)
  union all
  select i, ordinal, coalesce(hit, ordinal), case when hit is null then list_append(leaders, {'o': ordinal, 'ids': [code, own], 'pages': [page, own_page], 'what': what, 'hall': hall}) else leaders end
  from (
    select p.*, t.leaders, coalesce(
      list_filter(t.leaders, lambda x: list_contains(x.ids, p.code))[1].o, list_filter(t.leaders, lambda x: list_contains(x.ids, p.own))[1].o,
      list_filter(t.leaders, lambda x: list_contains(x.pages, p.page))[1].o, list_filter(t.leaders, lambda x: list_contains(x.pages, p.own_page))[1].o,
      list_filter(t.leaders, lambda x: x.what = p.what and x.hall = p.hall)[1].o, list_filter(t.leaders, lambda x: x.what = p.what)[1].o) as hit
    from taken t join probes p on p.i = t.i + 1)),
led as (select ordinal, leader from taken where i > 0 union all select ordinal, ordinal from keyed where is_base),
members as (select l.leader, k.* from led l join keyed k using (ordinal)),
sources as (
  select leader, day, ordinal, own, provider, own_page, min(ordinal) over (partition by leader, day) as head, min(ordinal) over (partition by leader, day, own) = ordinal as first
  from members),
kept as (select * from sources where first),
days as (select leader, day, head, string_agg(provider || ':' || own, ',' order by ordinal) as sources from kept group by all),
shows as (select leader, string_agg('2024-06-0' || day || '=' || sources, ';' order by head) as occurrences from days group by leader),
names as (
  select leader, provider, coalesce(list_position(['Ticketmaster', 'SerpAPIEvents', 'BiletimGO'], provider), 9) as place
  from (select leader, provider from kept union select ordinal, provider from members where ordinal = leader)),
links as (select leader, count(distinct link) as n_links from (select leader, own_page as link from kept union all select leader, page from members where ordinal = leader and page is not null) group by leader)
select s.leader, occurrences, (select string_agg(provider, ',' order by place, provider) from names n where n.leader = s.leader) as providers, n_links
from shows s join links using (leader)
"""
)
def merge_flow(t, spark):
    """Suppliers' and customers' shows: keys, leaders by id, link and show, occurrences merged, providers and links rebuilt."""
    s, c = t("supplier"), t("customer")
    base = _events(_rows(s, F.col("s_suppkey"), F.col("s_suppkey"), F.col("s_nationkey"), F.col("s_acctbal") + 1000, True), F.lit("Ticketmaster"))
    spelling = F.element_at(F.array(*map(F.lit, SPELLINGS)), (F.col("ordinal") % 4).cast("int") + 1)
    probes = _events(_rows(c, F.col("c_custkey") + 10_000_000, F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal") + 1000, False), spelling)
    merged = provenance.rebuild(match.match_and_merge(base, probes))
    texts = F.transform("occurrences", lambda o: F.concat(o["local_date"], F.lit("="), F.array_join(F.transform(o["sources"], lambda s: F.concat(provenance.canonical_provider(s["provider"]), F.lit(":"), s["external_id"])), ",")))
    return merged.select(F.col("ordinal").alias("leader"), F.array_join(texts, ";").alias("occurrences"), F.array_join("providers", ",").alias("providers"), F.size("source_urls").cast("long").alias("n_links"))
