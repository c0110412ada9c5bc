"""Matching records across sources, and merging them: greedy leader clustering by rounds, components and passes in order."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions.columns import filled, ordered_distinct
from playbill.functions.dates import date_key
from playbill.functions.text import normalize_for_match
from playbill.functions.urls import url_key
from playbill.operators.components import connected_components
from playbill.storage import discard, materialize


def _keys(values: Column, make) -> Column:
    """Ordered distinct non-empty keys of an array of texts."""
    made = F.filter(F.transform(values, make), lambda k: F.coalesce(k, F.lit("")) != "")
    return ordered_distinct(made, lambda k: k)


def record_keys(events: DataFrame, namespaced: bool = False) -> DataFrame:
    """events with id_keys, url_keys, show_key and venue_key.

    Ids and links come from the record, then from the sources of its first occurrence; ids of
    different providers can meet unless namespaced. show_key is title, date and city, null unless
    all three are there.
    """
    first = F.get(F.col("occurrences"), 0)
    sources = F.coalesce(first["sources"], F.array().cast(events.schema["occurrences"].dataType.elementType["sources"].dataType))
    prefix = F.concat(F.coalesce(F.col("source"), F.lit("")), F.lit(":")) if namespaced else F.lit("")
    ids = F.concat(F.array(F.col("external_id")), F.transform(sources, lambda s: s["external_id"]))
    links = F.concat(F.array("source_url", "link"), F.flatten(F.transform(sources, lambda s: F.array(s["source_url"], s["deep_link_url"]))))
    title, city, day = normalize_for_match("title"), normalize_for_match("city_name"), date_key(F.coalesce(first["local_date"], F.date_format(first["start_at_utc"], "yyyy-MM-dd")))
    return (
        events.withColumn("id_keys", F.transform(_keys(ids, normalize_for_match), lambda k: F.concat(prefix, k)))
        .withColumn("url_keys", _keys(links, lambda x: url_key(filled(x))))
        .withColumn("show_key", F.when((title != "") & (city != "") & (F.coalesce(day, F.lit("")) != ""), F.concat_ws("|", title, day, city)))
        .withColumn("venue_key", normalize_for_match(F.coalesce(filled(first["venue_name"]), filled("venue"))))
    )


#: Open records that one task may settle in order: about 100 MB with their keys.
PASS_RECORDS = 100_000


def _edges(records: DataFrame, strict_venue: bool) -> DataFrame:
    """ordinal, kind (0 id, 1 link, 2 show), place, key: a row per key of each record."""
    arrays = [("id_keys", 0), ("url_keys", 1)]
    parts = [records.select("ordinal", "is_base", F.lit(kind).alias("kind"), F.posexplode(name).alias("place", "key")) for name, kind in arrays]
    shows = records.where("show_key is not null and venue_key <> ''" if strict_venue else "show_key is not null")
    show = F.concat_ws("\n", "show_key", "venue_key") if strict_venue else F.col("show_key")
    return parts[0].union(parts[1]).union(shows.select("ordinal", "is_base", F.lit(2).alias("kind"), F.lit(0).alias("place"), show.alias("key")))


def _of_keys(edges: DataFrame, state: DataFrame) -> DataFrame:
    """Open records' keys with the least leader and the least open record of each: ordinal, kind, key, leader, open."""
    known = edges.select("ordinal", "kind", "key").join(state, "ordinal")
    least = known.groupBy("kind", "key").agg(F.min(F.when(F.col("state") == "leader", F.col("ordinal"))).alias("leader"), F.min(F.when(F.col("state") == "open", F.col("ordinal"))).alias("open"))
    return known.where("state = 'open'").drop("state").join(least, ["kind", "key"])


def _settle_at_once(edges: DataFrame, state: DataFrame) -> DataFrame:
    """Settle all that have an earlier leader among their keys (members) or no earlier open record (leaders)."""
    seen = _of_keys(edges, state).groupBy("ordinal").agg(F.max(F.coalesce(F.col("leader") < F.col("ordinal"), F.lit(False))).alias("led"), F.min("open").alias("first_open"))
    settled = F.when(F.col("state") != "open", F.col("state")).when(F.coalesce("led", F.lit(False)), "member").when(F.coalesce(F.col("first_open") >= F.col("ordinal"), F.lit(True)), "leader").otherwise("open")
    return state.join(seen, "ordinal", "left").select("ordinal", settled.alias("state"))


def _one_by_one(pdf):
    """Settle the open records of one component, or the first ones of it, in order; led marks keys of earlier leaders."""
    import pandas as pd

    pdf = pdf.sort_values("ordinal", kind="stable")
    taken: set[tuple[int, str]] = set()
    out = []
    for ordinal, rows in groupby(zip(pdf["ordinal"], pdf["kind"], pdf["key"], pdf["led"], strict=True), key=lambda r: r[0]):
        keys, led = [], False
        for _, kind, key, by in rows:
            keys.append((kind, key))
            led |= bool(by)
        if led or not taken.isdisjoint(keys):
            out.append((ordinal, "member"))
        else:
            taken.update(keys)
            out.append((ordinal, "leader"))
    return pd.DataFrame(out, columns=["ordinal", "state"])


def _settle_in_order(edges: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Settle the open records of each component of keys by one pass in order; of components over `most` records the first `most`.

    Open records that share no chain of keys don't touch each other, so components are settled
    side by side. The first records of the large components depend on nothing that is
    still open, so they are settled too, in one task of bounded size.
    """
    rows = _of_keys(edges, state).select("ordinal", "kind", "key", "open", F.coalesce(F.col("leader") < F.col("ordinal"), F.lit(False)).alias("led"))
    rows = materialize(rows, "open")
    columns = ["part", "ordinal", "kind", "key", "led"]
    if state.where("state = 'open'").limit(most + 1).count() <= most:
        work = rows.withColumn("part", F.lit(0).cast("long")).select(*columns)
    else:
        groups = connected_components(rows.select(F.col("ordinal").alias("a"), F.col("open").alias("b")))
        groups = materialize(groups.select(F.col("node").alias("ordinal"), F.col("component").alias("part")), "components")
        large = groups.groupBy("part").count().where(F.col("count") > most).select("part")
        small = rows.join(groups.join(large, "part", "left_anti"), "ordinal").select(*columns)
        alone = rows.join(groups, "ordinal", "left_anti").withColumn("part", F.col("ordinal")).select(*columns)
        first = groups.join(large, "part", "left_semi").orderBy("ordinal").limit(most).select("ordinal")
        work = small.union(alone).union(rows.join(first, "ordinal").withColumn("part", F.lit(-1).cast("long")).select(*columns))
    done = work.groupBy("part").applyInPandas(_one_by_one, "ordinal long, state string")
    return state.join(done.withColumnRenamed("state", "now"), "ordinal", "left").select("ordinal", F.coalesce("now", "state").alias("state"))


def assign_leaders(records: DataFrame, strict_venue: bool = False, pass_records: int = PASS_RECORDS) -> DataFrame:
    """ordinal, leader and kind of each record, as matching one after the other would give.

    records: ordinal (distinct longs), is_base, id_keys, url_keys, show_key, venue_key. Base records
    always lead. Any other record, in order, joins a leader before it that shares a key: the one of its
    first id key that any has, else of its first link, else one of equal show key, of equal venue
    if there is one (strict_venue: only such); without any it leads itself (kind null). Only leaders' own keys attract,
    so this is no transitive closure.

    Two rounds of joins settle most records at once: those that have an earlier leader among
    their keys (members) and those without an earlier open record (leaders). What is left hangs
    in chains of keys. It is cut into connected components (rounds in the logarithm of
    their width), each of which is settled by one pass in order within a task; of a component of
    over pass_records records the first so many are, then rounds go on. So the number of rounds doesn't
    follow the length of a chain. Every step is written to the shared folder.
    """
    edges = materialize(_edges(records, strict_venue), "keys")
    state = materialize(records.select("ordinal", F.when(F.col("is_base"), F.lit("leader")).otherwise("open").alias("state")), "state")
    turn = 0
    while state.where("state = 'open'").limit(1).count():
        turn += 1
        after = materialize(_settle_in_order(edges, state, pass_records) if turn % 3 == 0 else _settle_at_once(edges, state), "state")
        discard(state)
        state = after
    leaders = edges.join(state.where("state = 'leader'").select("ordinal"), "ordinal")
    members = edges.join(state.where("state = 'member'").select("ordinal"), "ordinal")
    first = leaders.groupBy("kind", "key").agg(F.min("ordinal").alias("leader"))
    plain = members.join(first, ["kind", "key"]).select("ordinal", "kind", "place", F.lit(1).alias("other_venue"), "leader")
    hits = plain
    if not strict_venue:
        venues = records.where("venue_key <> ''").select("ordinal", "venue_key")
        at_venue = leaders.where("kind = 2").join(venues, "ordinal").groupBy("key", "venue_key").agg(F.min("ordinal").alias("leader"))
        same = members.where("kind = 2").join(venues, "ordinal").join(at_venue, ["key", "venue_key"]).select("ordinal", "kind", "place", F.lit(0).alias("other_venue"), "leader")
        hits = same.union(plain)
    chosen = hits.where("leader < ordinal").groupBy("ordinal").agg(F.min(F.struct("kind", "place", "other_venue", "leader")).alias("hit"))
    return state.join(chosen, "ordinal", "left").select("ordinal", F.coalesce("hit.leader", "ordinal").alias("leader"), F.col("hit.kind").alias("kind"))


def leaders_by_one_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The special case of one key a record and no base: the smallest ordinal of the key leads."""
    least = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ordinal).alias("leader"))
    return df.join(least, key, "left").withColumn("leader", F.coalesce("leader", ordinal))


def match_labels(probes: DataFrame, known: DataFrame, fingerprint: str = "fingerprint", logical: str = "logical_key") -> DataFrame:
    """probes with matched (the known ordinal) and label: strong by fingerprint, else probable by logical key, else weak."""
    by_print = known.groupBy(fingerprint).agg(F.min("ordinal").alias("strong"))
    by_key = known.groupBy(logical).agg(F.min("ordinal").alias("probable"))
    return (
        probes.join(by_print, fingerprint, "left")
        .join(by_key, logical, "left")
        .withColumn("matched", F.coalesce("strong", "probable"))
        .withColumn("label", F.when(F.col("strong").isNotNull(), "strong").when(F.col("probable").isNotNull(), "probable").otherwise("weak"))
        .drop("strong", "probable")
    )


def merge_occurrences(records: DataFrame, leaders: DataFrame) -> DataFrame:
    """The leaders' records with their members' occurrences folded in.

    A member's occurrence goes into the leader's first occurrence of its local date, or, if there
    is none, becomes one. Into an occurrence go those sources whose external id no occurrence
    before had there; sources without an id always. Leaders' other fields stay. Records are taken
    in ordinal order. An event's occurrences are gathered by leader; nothing else is.
    """
    rows = records.join(leaders.select("ordinal", "leader"), "ordinal")
    occ = rows.select("leader", "ordinal", F.posexplode("occurrences").alias("at", "occ"))
    occ = occ.withColumn("own", F.col("ordinal") == F.col("leader")).withColumn("day", F.col("occ.local_date"))
    order = F.struct(~F.col("own"), F.col("ordinal"), F.col("at"))
    by_day = Window.partitionBy("leader", "day")
    occ = occ.withColumn("order", order).withColumn("target", F.min("order").over(by_day))
    # a leader's own further occurrences of a day stay as they are
    occ = occ.withColumn("target", F.when(F.col("own"), F.col("order")).otherwise(F.col("target")))
    src = occ.select("leader", "target", "order", F.posexplode_outer("occ.sources").alias("nth", "src"))
    src = src.withColumn("eid", F.when(F.coalesce(F.col("src.external_id"), F.lit("")) != "", F.col("src.external_id")))
    first_here = F.min("order").over(Window.partitionBy("leader", "target", "eid"))
    kept = src.where("src is not null").withColumn("first_here", first_here).where(F.col("eid").isNull() | (F.col("order") == F.col("first_here")))
    sources = kept.groupBy("leader", "target").agg(F.transform(F.array_sort(F.collect_list(F.struct("order", "nth", "src"))), lambda s: s["src"]).alias("sources"))
    heads = occ.where(F.col("order") == F.col("target")).select("leader", "target", "occ")
    whole = heads.join(sources, ["leader", "target"], "left")
    empty = F.array().cast(records.schema["occurrences"].dataType.elementType["sources"].dataType)
    made = F.col("occ").withField("sources", F.coalesce("sources", empty))
    merged = whole.groupBy("leader").agg(F.transform(F.array_sort(F.collect_list(F.struct("target", made.alias("occ")))), lambda s: s["occ"]).alias("_occurrences"))
    head = records.join(leaders.where("ordinal = leader").select("ordinal"), "ordinal")
    return head.join(merged, F.col("ordinal") == F.col("leader"), "left").withColumn("occurrences", F.coalesce("_occurrences", "occurrences")).select(*records.columns)


def match_and_merge(base: DataFrame, probes: DataFrame, **options) -> DataFrame:
    """Events of base and probes (both with ordinal, base's first), merged into their leaders."""
    records = base.withColumn("is_base", F.lit(True)).unionByName(probes.withColumn("is_base", F.lit(False)))
    return merge_occurrences(records, assign_leaders(record_keys(records, options.pop("namespaced", False)), **options)).drop("is_base")
