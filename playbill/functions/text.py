"""Text functions over columns: cleaning, folding, match keys, tokens, titles."""

from __future__ import annotations

import html as _html
import unicodedata
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from playbill.functions.columns import col


def _entity_pairs() -> list[tuple[str, str]]:
    return [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&amp;", "&")]


def unescape(text: Column | str) -> Column:
    """Resolve the named entities every feed has (in one pass, ampersand last); native."""
    out = col(text)
    for entity, char in _entity_pairs():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


#: Names of entities with their closing semicolon, and those that browsers also take without one, longest first.
_NAMED = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
_OPEN = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)


def _entity_table(names) -> Column:
    """A map literal of names to characters: text that the optimizer folds once, not an expression per entry."""
    return F.str_to_map(F.lit("\x01".join(f"{n}\x02{html5[n]}" for n in names)), F.lit("\x01"), F.lit("\x02"))


def _code_point(number: Column) -> Column:
    """The character of a number, as HTML reads it: C1 controls as Windows-1252, no control or non-character, � if out of range."""
    c1 = F.lit("".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)))
    none = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127) | number.between(0xFDD0, 0xFDEF) | (number % 0x10000 >= 0xFFFE)
    return (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), "\ufffd")
        .when(number.between(0x80, 0x9F), F.substr(c1, (number - 0x7F).cast("int"), F.lit(1)))
        .when(none, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def unescape_all(text: Column | str, closed: bool = False) -> Column:
    """Every named and numeric entity resolved once, as HTML does it; native. Null stays null.

    The text is cut at ampersands, and what begins a piece is looked up; names without a semicolon
    count where HTML knows them so, the longest first, but with closed none counts without one, as
    in XML. What is no entity stays as it is.
    """
    return _entities(text, lambda char: char, closed)


def settle(text: Column | str) -> Column:
    """Every entity as its character, but those of markup as the usual entities: what unescape() then resolves is what unescape_all() would.

    For pages and feeds, whose texts are cut out and cleaned in many places: all entities are resolved
    in one place, before tags are read, and the plan stays small. Characters that would end or
    change a JSON text are kept as well: quotes as entities, control characters as spaces.
    """
    kept = {"<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#39;", "&": "&amp;", **{chr(c): " " for c in range(32)}}
    found = _entities(text, lambda char: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in kept.items() for x in pair)), char), char))
    return F.when(F.contains(col(text), F.lit("&")), found).otherwise(col(text))


def _entities(text: Column | str, write, closed_only: bool = False) -> Column:
    closed, opened = _entity_table(n + ";" for n in _NAMED), _entity_table(_OPEN)

    def piece(x: Column, i: Column) -> Column:
        number = F.regexp_extract(x, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);" + ("" if closed_only else "?"), 0)
        digits = F.regexp_extract(number, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
        value = F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(F.conv(F.concat(F.lit("0"), digits), 10, 10).cast("long"))
        value = F.when(number.rlike("^#[xX]") & (F.length(digits) <= 8), F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("long")).otherwise(value)
        name = F.regexp_extract(x, "^[A-Za-z][A-Za-z0-9]{1,31};", 0)
        short = F.lit("") if closed_only else F.regexp_extract(x, "^(?:" + "|".join(_OPEN) + ")", 0)
        found = F.when(name != "", F.try_element_at(closed, name))
        rest = lambda head: F.substr(x, F.length(head) + 1)
        return (
            F.when(i == 0, x)
            .when(number != "", F.concat(write(_code_point(value)), rest(number)))
            .when(found.isNotNull(), F.concat(write(found), rest(name)))
            .when(short != "", F.concat(write(F.try_element_at(opened, short)), rest(short)))
            .otherwise(F.concat(F.lit("&"), x))
        )

    return F.array_join(F.transform(F.split(col(text), "&"), piece), "")


@F.pandas_udf(StringType())
def unescape_fixpoint(text: pd.Series) -> pd.Series:
    """Resolve entities until nothing changes, for text that was escaped several times."""

    def settle(x: str) -> str:
        while (y := _html.unescape(x)) != x:
            x = y
        return x

    return text.map(settle, na_action="ignore")


def collapse(text: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(text), r"(?U)\s+", " "))


def clean_text(text: Column | str, closed: bool = False) -> Column:
    """Entities resolved once (closed: see unescape_all) and white space collapsed. Null stays null."""
    return collapse(unescape_all(text, closed))


def strip_html(text: Column | str, closed: bool = False) -> Column:
    """Tags become spaces, then clean_text."""
    return clean_text(F.regexp_replace(col(text), "<[^>]+>", " "), closed)


def clean_settled(text: Column | str) -> Column:
    """clean_text of a text that settle() has been over, or that has the usual entities only."""
    return collapse(unescape(text))


def strip_settled(text: Column | str) -> Column:
    """strip_html of a text that settle() has been over."""
    return clean_settled(F.regexp_replace(col(text), "<[^>]+>", " "))


def strip_blocks(text: Column | str, closed: bool = False) -> Column:
    """HTML to lines: block tags end a line, other tags go, blank lines go."""
    broken = F.regexp_replace(col(text), r"(?i)<\s*(br|/p|/div|/li|/h[1-6]|/tr|p|div|li|ul|ol)\b[^>]*>", "\n")
    plain = unescape_all(F.regexp_replace(broken, "<[^>]+>", ""), closed)
    lines = F.transform(F.split(plain, "\n"), lambda x: collapse(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def strip_blocks_url(text: Column | str) -> Column:
    """strip_blocks of URL-quoted text (plus signs are kept), bullets on lines of their own."""
    plain = F.coalesce(F.try_url_decode(F.replace(col(text), F.lit("+"), F.lit("%2B"))), col(text))
    return strip_blocks(F.regexp_replace(plain, "•", "\n• "))


def fix_mojibake(text: Column | str) -> Column:
    """UTF-8 that was read as Latin-1 is read again; text where that fails stays as it is."""
    x = col(text)
    again = F.try_validate_utf8(F.encode(x, "ISO-8859-1").cast("string"))
    fits = ~x.rlike("[^\\x00-\\xFF]")
    return F.when(x.rlike("[ÃÄÅ]") & fits, F.coalesce(again, x)).otherwise(x)


def _plain_letters() -> tuple[str, str]:
    """Letters of the Latin blocks and what is left of them without marks, by decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in [*range(0xC0, 0x180), *range(0x1E00, 0x1F00)]]
    pairs = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, UNMARKED = _plain_letters()


def drop_marks(text: Column | str) -> Column:
    """Latin letters without their marks; separate combining marks go."""
    return F.regexp_replace(F.translate(col(text), MARKED, UNMARKED), r"\p{Mn}+", "")


def normalize_for_match(text: Column | str) -> Column:
    """The key that titles, cities and venues are compared by. Null becomes empty.

    Repaired, lower-cased, dotless i as i, no marks, no punctuation (underscores stay), white
    space collapsed.
    """
    lower = F.trim(F.lower(fix_mojibake(F.coalesce(col(text), F.lit("")))))
    plain = drop_marks(F.translate(lower, "ı", "i"))
    return collapse(F.regexp_replace(plain, r"[^\p{L}\p{N}_\s]+", ""))  # no ampersand is left to resolve


@F.pandas_udf(StringType())
def normalize_for_match_exact(text: pd.Series) -> pd.Series:
    """normalize_for_match with full Unicode decomposition, for text beyond the Latin blocks."""
    import re

    def one(x: str | None) -> str:
        x = x or ""
        if any(c in x for c in "ÃÄÅ"):
            try:
                x = x.encode("latin-1").decode("utf-8")
            except UnicodeError:
                pass
        x = unicodedata.normalize("NFD", x.lower().strip().replace("ı", "i"))
        x = "".join(c for c in x if unicodedata.category(c) != "Mn")
        return " ".join(_html.unescape(re.sub(r"[^\w\s]", "", x)).split())

    return text.map(one)


def ascii_fold(text: Column | str, dotless: bool = True) -> Column:
    """Lower-cased without marks; dotless i becomes i unless told not to."""
    lower = F.lower(col(text))
    return drop_marks(F.translate(lower, "ı", "i") if dotless else lower)


def trend_fold(text: Column | str) -> Column:
    """Lower-cased with the Turkish letters as plain ones."""
    return F.regexp_replace(F.translate(F.lower(col(text)), "çğıöşü", "cgiosu"), "̇", "")


def logical_key(title: Column | str, city: Column | str) -> Column:
    """Match keys of title and city, joined and spaced by hyphens."""
    return F.replace(F.concat_ws("-", normalize_for_match(title), normalize_for_match(city)), F.lit(" "), F.lit("-"))


def fingerprint(title: Column | str, venue: Column | str, date: Column | str, time: Column | str) -> Column:
    """title|venue|date|time with match keys; a missing date or time reads None."""
    return F.concat_ws("|", normalize_for_match(title), normalize_for_match(venue), F.coalesce(col(date), F.lit("None")), F.coalesce(col(time), F.lit("None")))


def tokens(text: Column | str, longer_than: int = 2) -> Column:
    """Distinct white-space tokens of more than so many characters."""
    return F.array_distinct(F.filter(F.split(F.trim(col(text)), r"\s+"), lambda t: F.length(t) > longer_than))


def truncate(text: Column | str, most: int) -> Column:
    """At most so many characters; a cut text loses trailing space and gains three dots."""
    x = col(text)
    return F.when(F.length(x) > most, F.concat(F.rtrim(F.substring(x, 1, most)), F.lit("..."))).otherwise(x)


def truncate_hard(text: Column | str, most: int) -> Column:
    return F.substring(col(text), 1, most)


def with_suffix(text: Column | str, suffix: str, most: int) -> Column:
    """text and suffix in at most so many characters, the text cut for it."""
    return F.concat(F.substring(col(text), 1, max(0, most - len(suffix))), F.lit(suffix))


def resolve_description(own: Column | str, about: Column | str, suffix: str, most: int = 2000) -> Column:
    """The own text cut to `most`; without one the about text, cut to leave room for the suffix."""
    mine = clean_text(own)
    other = clean_text(about)
    return F.when(mine != "", truncate_hard(mine, most)).when(other != "", with_suffix(other, suffix, most))


def strip_title_prefix(text: Column | str, title: Column | str, most: int = 2000) -> Column:
    """text without the title it begins with (in any case) and the space and dashes behind it."""
    x, t = col(text), col(title)
    rest = F.regexp_replace(F.substr(x, F.length(t) + 1), r"^[ \t\-–—:.]+", "")
    begins = (F.length(t) > 0) & F.startswith(F.lower(x), F.lower(t))
    return F.substring(F.when(begins, rest).otherwise(x), 1, most)


def slug_title(link: Column | str) -> Column:
    """A title from a link's last path segment: leading digits go, hyphens become spaces."""
    path = F.regexp_replace(F.regexp_replace(col(link), r"[?#].*$", ""), "/+$", "")
    last = F.element_at(F.split(path, "/"), -1)
    return collapse(F.regexp_replace(F.regexp_replace(last, r"^[0-9]+[-_]?", ""), "[-_]+", " "))


def surrogate_id(prefix: str, key: Column | str, size: int = 16) -> Column:
    """prefix and the first hex digits of the key's SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(col(key), 256), 1, size))


def search_id(title: Column | str, link: Column | str, city: Column | str) -> Column:
    """A search result's id: SHA-1 of its lower-cased title, link and city."""
    joined = F.concat_ws("|", *(F.coalesce(col(x), F.lit("")) for x in (title, link, city)))
    return F.concat(F.lit("serpapi-event-"), F.substring(F.sha1(F.lower(joined)), 1, 20))


def ticket_info(offers: Column | str) -> Column:
    """One line for an array of (source, price, type): price after a dash, else the type in brackets."""

    def one(o: Column) -> Column:
        return F.when(o["price"].isNotNull(), F.concat_ws(" - ", o["source"], o["price"])).when(o["type"].isNotNull(), F.concat(o["source"], F.lit(" ("), o["type"], F.lit(")"))).otherwise(o["source"])

    return F.array_join(F.filter(F.transform(col(offers), one), lambda x: x.isNotNull()), " | ")


# Endings that follow a performer's name, tried in this order, and words no performer's name has.
PERFORMER_ENDINGS = [
    " stand up", " stand-up", " standup", " komedi gösterisi", " komedi show", " one man show",
    " gala konseri", " özel gala", " gala", " konseri", " concert", " canlı performans", " canli performans", " akustik",
    " turnesi", " tour", " live",
    " tiyatrosu", " müzikali", " müzikal", " operası", " balesi", " gösterisi", " performansı", " resitali",
    " sergisi", " retrospektifi", " atölyesi", " workshopu", " masterclassı", " çocuk tiyatrosu",
]
GENERIC_WORDS = [
    "açık", "hava", "outdoor", "kış", "yaz", "bahar", "sonbahar", "gece", "festival", "special", "özel", "istanbul", "ankara",
    "izmir", "türkiye", "anatolian", "yıllık", "geleneksel", "uluslararası", "international", "ulusal", "national",
    "anı", "anısına", "şeref", "onur", "büyük", "grand",
]


def plausible_performer(name: Column | str) -> Column:
    """3 to 60 characters, no year or anniversary, no generic word (accented ones, as listed, match no folded word)."""
    x = col(name)
    words = F.split(ascii_fold(x, dotless=False), r"\s+")
    return (F.length(x).between(3, 60)) & ~x.rlike(r"(?iu)\b\d{4}\b|\b\d+\.\s*y[iı]l\b") & ~F.arrays_overlap(words, F.array(*map(F.lit, GENERIC_WORDS)))


def performer(title: Column | str) -> Column:
    """The performer a title names: left of " - " if that is plausible, else before the first known ending, else null."""
    bare = F.trim(F.regexp_replace(col(title), r"\s*\([^)]*\)\s*$", ""))
    left = F.trim(F.substring_index(bare, " - ", 1))
    out = F.when(F.contains(bare, F.lit(" - ")) & plausible_performer(left), left)
    for ending in PERFORMER_ENDINGS:
        name = F.regexp_replace(F.trim(F.substr(bare, F.lit(1), F.length(bare) - len(ending))), r"[,\-–|]+$", "")
        out = out.when(F.endswith(F.lower(bare), F.lit(ending)), F.when(plausible_performer(name), name))
    return out
