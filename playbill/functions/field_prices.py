"""Prices out of the fields of posts and calendar events (JSON texts), where sites keep them in many places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playbill.functions.columns import col
from playbill.functions.prices import text_price

# Fields with a price, fields that say an event is free, what they say then, and the currencies a field may name.
PRICE_FIELDS = ["event_price", "_event_price", "price", "_price", "bilet_fiyat", "bilet_fiyati", "ucret", "_ucret", "event_cost", "_event_cost", "event_fee", "ticket_price"]
FREE_FIELDS = ["event_free", "_event_free", "is_free", "event_is_free", "ucretsiz"]
FREE_SAID = ["1", "true", "yes", "ucretsiz", "ücretsiz", "free", "bedava"]
FREE_PRICES = ["free", "ücretsiz", "ucretsiz", "bedava", "0", "0.00"]
CURRENCY_FIELDS = ["currency", "event_currency", "price_currency"]
CURRENCIES = ["TRY", "USD", "EUR"]
COST_FIELDS = ["cost", "cost_min", "cost_max"]
FREE_COSTS = ["", "0", "free", "ucretsiz", "ücretsiz", "bedava", "0.00", "0,00"]

FIELDS = "map<string,string>"


def _once(value: Column, read) -> Column:
    """read(value) with value worked out once."""
    return F.get(F.transform(F.array(value), read), 0)


def _resolved(text: Column, unit: Column, legal_mode: str, strategy: Column, confidence: Column, source: Column, found: Column, notes: tuple[str, str]) -> Column:
    """The price of a text, with one name for all ways to be unknown; notes: when there was a field, and without."""

    def told(price: Column) -> Column:
        unknown = price["is_unknown"]
        how = price["resolution"].withField("strategy", F.concat(strategy, F.when(unknown, "_all_candidates_unknown").otherwise(price["resolution"]["strategy"])))
        how = how.withField("confidence", F.when(unknown, 0.0).otherwise(confidence)).withField("source", source).withField("is_derived", found)
        how = how.withField("requires_terms_review", found).withField("note", F.when(found, notes[0]).otherwise(notes[1]))
        return price.withField("currency", F.when(unknown, "TRY").otherwise(price["currency"])).withField("resolution", how)

    return _once(text_price(text, "", 1.0, legal_mode, unit), told)


def post_price(post: Column | str, domain: Column | str) -> Column:
    """The price struct of a post (JSON text) from its own, its meta and its acf fields.

    A field that says so makes it free (confidence 0.8), else the first filled price field is read
    (0.65). A field that the post has itself hides the same of its meta, even if it is null. Texts
    that are no object are unknown.
    """
    parsed = F.from_json(col(post), FIELDS)
    inner = lambda fields, name: F.from_json(F.try_element_at(fields, F.lit(name)), FIELDS)
    held = _once(parsed, lambda top: F.struct(top.alias("top"), inner(top, "meta").alias("meta"), inner(top, "acf").alias("acf")))
    source = F.concat(F.lit("wp_rest:"), F.coalesce(col(domain), F.lit("")))

    def field(at: Column, name: str) -> Column:
        has = lambda fields: F.coalesce(F.map_contains_key(fields, F.lit(name)), F.lit(False))
        get = lambda fields: F.trim(F.try_element_at(fields, F.lit(name)))
        return F.when(has(at["top"]), get(at["top"])).when(has(at["meta"]), get(at["meta"])).otherwise(get(at["acf"]))

    def facts(at: Column) -> Column:
        price = F.coalesce(*(F.nullif(field(at, n), F.lit("")) for n in PRICE_FIELDS))
        said = F.exists(F.array(*(F.lower(field(at, n)) for n in FREE_FIELDS)), lambda v: F.coalesce(v.isin(FREE_SAID), F.lit(False)))
        unit = F.coalesce(*(F.when(F.upper(field(at, n)).isin(CURRENCIES), F.upper(field(at, n))) for n in CURRENCY_FIELDS), F.lit("TRY"))
        return F.struct(price.alias("price"), (said | F.coalesce(F.lower(price).isin(FREE_PRICES), F.lit(False))).alias("free"), unit.alias("unit"))

    def made(f: Column) -> Column:
        said = F.when(f["free"], "ucretsiz").otherwise(f["price"])
        unit = F.when(f["free"], "TRY").otherwise(f["unit"])
        strategy, confidence = F.when(f["free"], "wp_rest_free_marker").otherwise("wp_rest_meta_scan"), F.when(f["free"], 0.80).otherwise(0.65)
        return _resolved(said, unit, "public_web_text", strategy, confidence, source, said.isNotNull(), ("Read from the post's fields.", "No price field."))

    return _once(_once(held, facts), made)


def calendar_price(event: Column | str) -> Column:
    """The price struct of a calendar event (JSON text) from cost, cost_min and cost_max.

    Free if all that are there are empty, zero or say so (confidence 0.75); different first and last
    ones are a range (0.7).
    """
    source = F.lit("tribe_events_api")
    parsed = F.from_json(col(event), FIELDS)
    costs = _once(parsed, lambda top: F.filter(F.array(*(F.trim(F.try_element_at(top, F.lit(n))) for n in COST_FIELDS)), lambda v: v.isNotNull()))

    def made(found: Column) -> Column:
        first, last = (F.regexp_replace(F.get(found, i), r"[₺$€,\s]", "") for i in (F.lit(0), F.size(found) - 1))
        shown = F.when((first != "") & (last != "") & (first != last), F.concat(first, F.lit("-"), last, F.lit(" ₺"))).otherwise(F.get(found, 0))
        some = F.size(found) > 0
        free = some & F.forall(found, lambda v: F.lower(v).isin(FREE_COSTS))
        return _resolved(F.when(free, "ucretsiz").otherwise(shown), F.lit("TRY"), "public_api", F.lit("tribe_events_cost_field"), F.when(free, 0.75).otherwise(0.70), source, some, ("Read from the cost fields.", "No cost field."))

    return _once(F.coalesce(costs, F.array().cast("array<string>")), made)
