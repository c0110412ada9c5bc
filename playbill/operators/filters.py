"""Row filters. "Now" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.functions.columns import col
from playbill.functions.dates import next_week
from playbill.functions.text import normalize_for_match
from playbill.functions.urls import is_link

# Words that a place's name is made of, and words that make a card an event's.
GENERIC_TITLE_WORDS = ["belediyesi", "kültür", "kultur", "sanat", "merkezi", "merkez", "salonu", "salon", "binası", "bina", "konser", "tiyatro", "etkinlik", "alan", "alanı", "tesisi"]
EVENT_KEYWORDS = ["konser", "tiyatro", "sergi", "festival", "gosteri", "gösteri", "sinema", "söyleşi", "soylesi", "etkinlik", "kültür", "kultur", "sanat", "çocuk", "cocuk"]


def look_ahead(start: Column | str, as_of: Column | str, days: int) -> Column:
    """From now to so many days ahead; 0 or less has no end."""
    s, now = col(start), col(as_of)
    return (s >= now) & (F.lit(True) if days <= 0 else s <= now + F.expr(f"interval {days} days"))


def not_past(start: Column | str, as_of: Column | str) -> Column:
    return col(start) >= col(as_of)


def future(start: Column | str, as_of: Column | str) -> Column:
    return col(start) > col(as_of)


def required(*texts: Column | str) -> Column:
    """None of the texts is null or blank."""
    out = F.lit(True)
    for t in texts:
        out = out & (F.coalesce(F.trim(col(t)), F.lit("")) != "")
    return out


def with_link(df: DataFrame, link: str) -> DataFrame:
    return df.where(is_link(link))


def structural_title(title: Column | str, *places: Column | str) -> Column:
    """The title is a place's name, or one with only generic words besides."""
    t = normalize_for_match(title)
    generic = F.array(*map(F.lit, sorted({*GENERIC_TITLE_WORDS, *(w.translate(str.maketrans("çğıöşü", "cgiosu")) for w in GENERIC_TITLE_WORDS)})))
    out = F.lit(False)
    for p in map(normalize_for_match, places):
        rest = F.filter(F.split(F.replace(t, p, F.lit(" ")), " "), lambda w: w != "")
        out = out | ((p != "") & ((t == p) | (F.contains(t, p) & (F.size(F.array_except(rest, generic)) == 0))))
    return out


def event_like(text: Column | str) -> Column:
    """The lower-cased text has one of the event keywords."""
    return F.lower(col(text)).rlike("|".join(EVENT_KEYWORDS))


def in_next_week(day: Column | str, as_of: Column | str, ongoing_year: int = 2050) -> Column:
    """Next Monday to Sunday; unknown, unreadable and far-future days count as in it."""
    d = F.to_date(F.try_to_timestamp(col(day).cast("string")))
    a, b = next_week(as_of)
    return F.coalesce((F.year(d) >= ongoing_year) | d.between(a, b), F.lit(True))


def enabled(df: DataFrame, name_col: str, *names: str) -> DataFrame:
    """Rows of the named providers, in any case; all without names."""
    return df.where(F.lower(name_col).isin([n.lower() for n in names])) if names else df
