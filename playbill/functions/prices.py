"""Prices: numbers out of text, price structs, and one view of a show's prices across providers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playbill.functions.columns import cases, col, lookup, once
from playbill.functions.text import normalize_for_match
from playbill.schema import PRICE

# Texts of prices, and what marks a price as free or unknown within a match key without spaces.
UNKNOWN_TEXT, FREE_TEXT, NO_PRICE_TEXT = "Fiyat bilgisi yok", "Ucretsiz", "Fiyat bilgisi mevcut degil"
FREE_MARKERS = ["ucretsiz", "free", "bedava", "withoutcharge", "nocost", "cretsiz"]
UNKNOWN_MARKERS = ["fiyatbilgisiyok", "fiyatyok", "priceunavailable", "pricenotavailable", "priceunknown", "unknown", "belirtilmedi", "tba", "tbd"]
SYMBOLS = {"TRY": "TL", "USD": "$", "EUR": "€"}
MOST_AMOUNT = 10_000_000


def amount(token: Column | str) -> Column:
    """The number a token stands for, in cents' precision; null if it is none, or out of range.

    With both separators the last is the decimal one. A single one is decimal if it is the only one
    and has at most two digits behind it; else separators group thousands.
    """
    x = F.regexp_replace(F.trim(col(token)), r"^[.,]+|[.,]+$", "")
    comma_last = F.length(F.substring_index(x, ",", -1)) < F.length(F.substring_index(x, ".", -1))
    both = x.rlike(",") & x.rlike(r"\.")
    plain = (
        F.when(both & comma_last, F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(both, F.replace(x, F.lit(","), F.lit("")))
        .when(x.rlike(r"^\d+[.,]\d{1,2}$"), F.replace(x, F.lit(","), F.lit(".")))
        .otherwise(F.regexp_replace(x, "[.,]", ""))
    )
    value = plain.try_cast("double")
    return F.when((value >= 0) & (value <= MOST_AMOUNT), F.round(value, 2))


def amounts(text: Column | str) -> Column:
    """Array of the amounts in a text; ordinals of categories, phases and the like are no amounts."""
    x = F.regexp_replace(F.coalesce(col(text), F.lit("")), r"(?iu)\b\d+\s*[.,]?\s*(?:kategori|kat|faz|d[oö]nem|bilet|ad[iı]m|avantaj)\b", " ")
    x = F.regexp_replace(x, r"\b\d+\s*\.\s*[A-ZÇĞİÖŞÜ]", " ")
    return F.filter(F.transform(F.regexp_extract_all(x, F.lit(r"(\d[\d.,]*)"), 1), amount), lambda v: v.isNotNull())


def _marked(text: Column, markers: list[str]) -> Column:
    return F.replace(normalize_for_match(text), F.lit(" "), F.lit("")).rlike("|".join(markers))


def is_unknown(text: Column | str) -> Column:
    return _marked(col(text), UNKNOWN_MARKERS)


def is_free(text: Column | str) -> Column:
    return _marked(col(text), FREE_MARKERS)


def price_range(text: Column | str) -> Column:
    """struct(min, max) of a text: nulls if unknown or without amounts, zeros if free."""
    x = col(text)

    def read(s: Column) -> Column:  # the key and the amounts are worked out once
        unknown, free = s["key"].rlike("|".join(UNKNOWN_MARKERS)), s["key"].rlike("|".join(FREE_MARKERS))
        low, high = (F.when(~unknown, F.when(free, F.lit(0.0)).otherwise(v)) for v in (F.array_min(s["found"]), F.array_max(s["found"])))
        return F.struct(low.alias("min"), high.alias("max"))

    parts = F.struct(F.replace(normalize_for_match(x), F.lit(" "), F.lit("")).alias("key"), amounts(x).alias("found"))
    return F.get(F.transform(F.array(parts), read), 0)


def price_text(low: Column, high: Column, currency: Column) -> Column:
    """Free, one amount, or a range, with the currency."""
    one = F.format_string("%.2f %s", low, currency)
    return F.when((low == 0) & (high == 0), F.lit(FREE_TEXT)).when(low == high, one).when(low.isNotNull(), F.format_string("%.2f - %.2f %s", low, high, currency)).otherwise(UNKNOWN_TEXT)


def _price(low: Column, high: Column, currency: Column, strategy: Column, confidence: Column, legal_mode: str, source: Column) -> Column:
    resolution = F.struct(
        strategy.alias("strategy"), F.greatest(F.lit(0.0), F.least(confidence, F.lit(1.0))).alias("confidence"), F.lit(legal_mode).alias("legal_mode"), source.alias("source"),
        F.lit(False).alias("is_authoritative"), F.lit(True).alias("is_derived"), F.lit(False).alias("requires_terms_review"), F.lit(None).cast("string").alias("note"),
    )
    return F.struct(
        low.alias("min_value"), high.alias("max_value"), price_text(low, high, currency).alias("text"), currency.alias("currency"),
        F.coalesce((low == 0) & (high == 0), F.lit(False)).alias("is_free"), low.isNull().alias("is_unknown"), resolution.alias("resolution"),
    ).cast(PRICE)


def text_price(text: Column | str, strategy: str, confidence: float, legal_mode: str, currency: Column | str = "TRY") -> Column:
    """The price struct of a text (a currency that is a text is meant itself); the strategy says how it came out (_empty, _unknown_marker, _free_marker, _no_numeric)."""
    x = col(text)

    def read(s: Column) -> Column:  # the key and the range are worked out once
        low, high = s["range"]["min"], s["range"]["max"]
        name = cases([(s["empty"], strategy + "_empty"), (s["key"].rlike("|".join(UNKNOWN_MARKERS)), strategy + "_unknown_marker"), (s["key"].rlike("|".join(FREE_MARKERS)), strategy + "_free_marker"), (low.isNull(), strategy + "_no_numeric")], strategy)
        return _price(low, high, F.lit(currency), name, F.when(low.isNull(), 0.0).otherwise(confidence), legal_mode, s["text"])

    empty = F.coalesce(F.trim(x), F.lit("")) == ""
    parts = F.struct(x.alias("text"), empty.alias("empty"), F.replace(normalize_for_match(x), F.lit(" "), F.lit("")).alias("key"), price_range(x).alias("range"))
    return F.get(F.transform(F.array(parts), read), 0)


def stated_price(low: Column | str, high: Column | str, strategy: str, confidence: float, legal_mode: str, currency: Column | str | None = None) -> Column:
    """The price struct of two numbers: one missing is the other, the smaller is the minimum; none is _missing."""
    a, b = (F.when((v >= 0) & (v <= MOST_AMOUNT), F.round(v, 2)) for v in (col(low).cast("double"), col(high).cast("double")))
    first, second = F.coalesce(a, b), F.coalesce(b, a)
    unit = F.upper(F.coalesce(col(currency), F.lit("TRY"))) if currency is not None else F.lit("TRY")

    def read(s: Column) -> Column:  # the numbers are worked out once
        name = F.when(s["low"].isNull(), strategy + "_missing").otherwise(strategy)
        return _price(s["low"], s["high"], unit, name, F.when(s["low"].isNull(), 0.0).otherwise(confidence), legal_mode, F.lit(None).cast("string"))

    return once(F.struct(F.least(first, second).alias("low"), F.greatest(first, second).alias("high")), read)


def first_known(*prices: Column) -> Column:
    """The first price that is not unknown, else the last with strategy _all_candidates_unknown."""
    last = prices[-1]
    named = last.withField("resolution", last["resolution"].withField("strategy", F.concat(last["resolution"]["strategy"], F.lit("_all_candidates_unknown"))))
    return F.coalesce(*(F.when(~p["is_unknown"], p) for p in prices), named)


def partner_price(text: Column | str) -> Column:
    """struct(min, is_free, is_unknown) by the partner feed's own rule: no digit is unknown, a dot is decimal, two separators are unknown."""
    x = F.trim(col(text))
    digits = F.regexp_replace(F.regexp_extract(x, r"(\d[\d.,]*)", 1), ",", ".")
    value = digits.try_cast("double")
    return F.struct(value.alias("min"), F.coalesce(value == 0, F.lit(False)).alias("is_free"), value.isNull().alias("is_unknown"))


def feed_price(text: Column | str) -> Column:
    """struct(min, is_free, is_unknown) of a product feed's number: negative or no number is unknown, zero is free."""
    value = F.regexp_extract(F.trim(col(text)), r"^(-?\d+(?:\.\d+)?)", 1).try_cast("double")
    kept = F.when(value >= 0, value)
    return F.struct(kept.alias("min"), F.coalesce(kept == 0, F.lit(False)).alias("is_free"), kept.isNull().alias("is_unknown"))


def currency_rank(currency: Column | str) -> Column:
    c = F.upper(col(currency))
    return cases([(c == "TRY", 0), (c == "USD", 1), (c == "EUR", 2)], 99)


def resolve_prices(offers: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key from rows of provider_name, min_price (decimal), currency, is_free.

    is_free: any offer is free or costs nothing; best_min_price: least known price whatever its
    currency; best_by_currency: least of each; all_prices_equal: in each currency all known prices
    are one, false if none is known; provider_prices: offers by currency rank, price, name;
    display_price_text. Partial sums run before the shuffle but for the list of offers, which a
    key has few of.
    """
    c = F.upper("currency")
    per = offers.withColumn("currency", c).groupBy(*keys, "currency").agg(
        F.max(F.coalesce("is_free", F.lit(False)) | F.coalesce(F.col("min_price") == 0, F.lit(False))).alias("free"),
        F.min("min_price").alias("low"), F.max("min_price").alias("high"), F.count("*").alias("n"),
        F.collect_list(F.struct(currency_rank("currency").alias("rank"), F.col("min_price").isNull().alias("open"), "min_price", F.lower("provider_name").alias("name"), "provider_name", "currency")).alias("offers"),
    )
    whole = per.groupBy(*keys).agg(
        F.max("free").alias("is_free"), F.min("low").alias("best_min_price"), (F.sum("n") > 1).alias("has_multiple_providers"),
        (F.coalesce(F.max(F.col("low") != F.col("high")), F.lit(True)) == F.lit(False)).alias("all_prices_equal"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("low").isNotNull(), F.struct("currency", "low"))))).alias("best_by_currency"),
        F.array_sort(F.flatten(F.collect_list("offers"))).alias("sorted"),
    )
    priced = F.filter("sorted", lambda o: ~o["open"])
    symbol = lookup(F.coalesce(F.get(priced, 0)["currency"], F.lit("TRY")), SYMBOLS, F.coalesce(F.get(priced, 0)["currency"], F.lit("TRY")))
    shown = F.concat(F.format_number("best_min_price", 0), F.lit(" "), symbol, F.when(F.col("has_multiple_providers"), F.lit("'den baslayan")).otherwise(""))
    text = F.when(F.col("is_free"), FREE_TEXT).when(F.col("best_min_price").isNotNull(), shown).otherwise(NO_PRICE_TEXT)
    ordered = F.transform("sorted", lambda o: F.struct(o["provider_name"].alias("provider_name"), o["min_price"].alias("min_price"), o["currency"].alias("currency")))
    return whole.select(*keys, "is_free", "best_min_price", "best_by_currency", "has_multiple_providers", "all_prices_equal", ordered.alias("provider_prices"), text.alias("display_price_text"))


def offers_fold(offers: Column | str) -> Column:
    """struct(min, max, currency) of an array of (price, low, high, currency): least of price and low, last high, first currency."""

    def fold(arr: Column) -> Column:  # the offers are read once
        lows = F.flatten(F.transform(arr, lambda o: F.array(o["price"], o["low"])))
        highs = F.filter(F.transform(arr, lambda o: o["high"]), lambda x: x.isNotNull())
        units = F.filter(F.transform(arr, lambda o: o["currency"]), lambda x: x.isNotNull())
        return F.struct(F.array_min(F.filter(lows, lambda x: x.isNotNull())).alias("min"), F.try_element_at(highs, F.lit(-1)).alias("max"), F.coalesce(F.get(units, 0), F.lit("TRY")).alias("currency"))

    return once(col(offers), fold)


def rank_offers(offers: DataFrame, keys: list[str]) -> DataFrame:
    """Offers with their place among a key's: currency rank, price (open ones last), name."""
    w = Window.partitionBy(*keys).orderBy(currency_rank("currency"), F.col("min_price").asc_nulls_last(), F.lower("provider_name"))
    return offers.withColumn("place", F.row_number().over(w))
