"""Where an event comes from: providers, links, tags and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.functions.columns import cases, col, filled, lookup, ordered_distinct
from playbill.functions.text import normalize_for_match
from playbill.functions.urls import host_of, url_key
from playbill.operators.patterns import find_patterns

# The providers in their order, their spellings (letters and digits only), and the tags they are shown by.
PROVIDERS = ["Ticketmaster", "MunicipalRSS", "MunicipalWeb", "SerpAPIEvents", "SerpAPILocal", "BiletimGO"]
ALIASES = {
    "ticketmaster": "Ticketmaster", "municipalrss": "MunicipalRSS", "municipalweb": "MunicipalWeb", "serpapievents": "SerpAPIEvents",
    "serpapigoogleevents": "SerpAPIEvents", "serpapilocal": "SerpAPILocal", "serpapigooglelocal": "SerpAPILocal", "biletimgo": "BiletimGO",
    "biletimgopartner": "BiletimGO",
}
TAGS = {"Ticketmaster": "Ticketmaster", "MunicipalRSS": "İBB", "SerpAPIEvents": "Google", "SerpAPILocal": "Google", "BiletimGO": "biletimGO"}
NO_NAMES = ["unknown", "none", "null", "na"]


def canonical_provider(name: Column | str) -> Column:
    """The provider's one spelling; unknown ones stay; names that say nothing are null."""
    x = F.trim(col(name))
    key = F.regexp_replace(F.lower(x), "[^a-z0-9]", "")
    return F.when((key == "") | key.isin(NO_NAMES), F.lit(None)).otherwise(lookup(key, ALIASES, x))


def provider_rank(name: Column | str) -> Column:
    return cases([(col(name) == p, i) for i, p in enumerate(PROVIDERS)], 999)


def canonical_providers(names: Column | str) -> Column:
    """Distinct canonical providers of an array of names (each may hold several, by bars), in the providers' order, others by name."""
    each = F.flatten(F.transform(F.filter(col(names), lambda n: n.isNotNull()), lambda n: F.split(n, r"\|")))
    known = F.array_distinct(F.filter(F.transform(each, canonical_provider), lambda p: p.isNotNull()))
    return F.transform(F.array_sort(F.transform(known, lambda p: F.struct(provider_rank(p).alias("rank"), p.alias("name")))), lambda s: s["name"])


def distinct_links(links: Column | str) -> Column:
    """Links with different comparison keys, each in its first spelling."""
    clean = F.filter(F.transform(col(links), filled), lambda x: x.isNotNull())
    return ordered_distinct(clean, lambda x: F.coalesce(F.nullif(url_key(x), F.lit("")), F.lower(x)))


def municipal_labels(links: Column | str, texts: Column | str, municipalities: dict[str, tuple[str, str]]) -> Column:
    """Labels of an array of links and one of texts.

    municipalities: label -> (domain, token). A host's label is that of the longest domain it is in,
    else the name before .bel.tr; a text has the labels of the tokens in it, and any "X Belediyesi"
    it names.
    """
    longest = sorted(municipalities.items(), key=lambda m: -len(m[1][0]))
    by_host = F.transform(
        F.transform(col(links), host_of),
        lambda h: F.coalesce(cases([((h == d) | F.endswith(h, F.lit("." + d)), label) for label, (d, _) in longest]), F.initcap(F.nullif(F.regexp_extract(h, r"([a-z0-9-]+)\.bel\.tr$", 1), F.lit("")))),
    )
    folded = F.array_join(F.transform(col(texts), normalize_for_match), " ")
    by_token = F.array(*(F.when(F.contains(folded, F.lit(token)), F.lit(label)) for label, (_, token) in municipalities.items()))
    named = F.flatten(F.transform(col(texts), lambda t: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(r"(?u)(\p{Lu}[\p{L}]+(?: \p{Lu}[\p{L}]+)? Belediyesi)"), 1)))
    return F.array_distinct(F.filter(F.concat(by_host, by_token, named), lambda x: F.coalesce(x, F.lit("")) != ""))


def labels_by_token(rows: DataFrame, keys: list[str], texts: str, registry: DataFrame) -> DataFrame:
    """keys and label: labels of a registry (label, token) of any size whose token is in a row's texts, folded for matching.

    What municipal_labels() does for a small dictionary, by one automaton of all tokens.
    """
    folded = rows.select(*keys, F.array_join(F.transform(col(texts), normalize_for_match), " ").alias("_folded"))
    tokens = registry.select("label", normalize_for_match("token").alias("pattern")).where("pattern <> ''").distinct()
    return find_patterns(folded, "_folded", keys, tokens).join(tokens, "pattern").select(*keys, "label").distinct()


def payload(events: DataFrame, municipalities: dict[str, tuple[str, str]] | None = None, providers: str = "providers", links: str = "source_urls", texts: str = "candidate_texts") -> DataFrame:
    """events with providers, source_urls, provider_tags, provider_label and provider from arrays of names, links and texts."""
    labels = municipal_labels(links, texts, municipalities) if municipalities else F.array().cast("array<string>")
    found = events.withColumn("_names", canonical_providers(providers)).withColumn("_links", distinct_links(links)).withColumn("_labels", labels)

    def tags(p: Column) -> Column:
        own = F.when(F.size("_labels") > 0, F.col("_labels")).otherwise(F.array(F.lit("MunicipalWeb")))
        return F.when(p == "MunicipalWeb", own).otherwise(F.array(lookup(p, TAGS, p)))

    tagged = found.withColumn("provider_tags", F.array_distinct(F.flatten(F.transform("_names", tags))))
    label = F.when(F.size("provider_tags") > 0, F.array_join("provider_tags", ", "))
    return (
        tagged.withColumn("provider_label", label)
        .withColumn("provider", F.coalesce(label, F.get("_names", 0)))
        .drop(*{providers, links} & set(events.columns))
        .withColumnRenamed("_names", "providers")
        .withColumnRenamed("_links", "source_urls")
        .drop("_labels")
    )


def rebuild(events: DataFrame, municipalities: dict[str, tuple[str, str]] | None = None, upload: bool = False) -> DataFrame:
    """Payload from the record and all its occurrences' sources; for an upload also by address, title and description."""
    occ, src = F.col("occurrences"), F.flatten(F.transform("occurrences", lambda o: o["sources"]))
    names = F.concat(F.array(F.col("source")), F.coalesce(F.col("providers"), F.array().cast("array<string>")), F.transform(src, lambda s: s["provider"]))
    links = F.concat(F.array("source_url", "link"), F.coalesce(F.col("source_urls"), F.array().cast("array<string>")), F.flatten(F.transform(src, lambda s: F.array(s["source_url"], s["deep_link_url"]))))
    texts = F.flatten(F.transform(occ, lambda o: F.array(o["venue_name"], o["district"])))
    if upload:
        texts = F.concat(texts, F.array("address", "title", "description"))
    some = lambda a: F.filter(a, lambda x: x.isNotNull())
    ready = events.withColumn("_n", some(names)).withColumn("_u", some(links)).withColumn("_t", some(texts)).drop("providers", "source_urls")
    ready = ready.withColumnsRenamed({"_n": "providers", "_u": "source_urls"})
    return payload(ready, municipalities, texts="_t").select(*events.columns)
