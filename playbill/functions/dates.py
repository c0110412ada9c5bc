"""Date and time functions. Instants are UTC; "now" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playbill.functions.columns import cases, col, once
from playbill.functions.text import ascii_fold, clean_settled, trend_fold

ZONE = "Europe/Istanbul"
# Turkish month names, and their first three letters, without marks.
MONTHS = ["ocak", "subat", "mart", "nisan", "mayis", "haziran", "temmuz", "agustos", "eylul", "ekim", "kasim", "aralik"]
MONTH_SHORT = ["Oca", "Şub", "Mar", "Nis", "May", "Haz", "Tem", "Ağu", "Eyl", "Eki", "Kas", "Ara"]
ENGLISH_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
LONG_DATE = r"(\d{1,2})\s+([A-Za-zÇĞİÖŞÜçğıöşü]+),?\s+(\d{4})"
# The same, only with the names that month_number() knows.
_FORMS = {"c": "cçÇ", "g": "gğĞ", "i": "iıİ", "o": "oöÖ", "s": "sşŞ", "u": "uüÜ"}
_NAMES = ["".join(f"[{_FORMS.get(c, c)}{c.upper()}]" + ("(?:" if i == 2 and len(m) > 3 else "") for i, c in enumerate(m)) + (")?" if len(m) > 3 else "") for m in MONTHS]
NAMED_DATE = rf"(\d{{1,2}})\s+({'|'.join(_NAMES)}),?\s+(\d{{4}})"


def month_number(name: Column | str) -> Column:
    """1..12 of a Turkish month name or its three letters, with or without marks; else null."""
    folded = F.regexp_replace(ascii_fold(name), r"[^a-z]", "")
    return cases([((folded == m) | (folded == m[:3]), i) for i, m in enumerate(MONTHS, 1)])


def _made(year: Column, month: Column, day: Column, time: Column) -> Column:
    """A local timestamp of its parts; null where they name none."""
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(day.cast("string"), 2, "0"), F.lit(" "), time)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))


def local_to_utc(local: Column | str, zone: str = ZONE) -> Column:
    return F.to_utc_timestamp(col(local), zone)


def local_date(instant: Column | str, zone: str = ZONE) -> Column:
    """yyyy-MM-dd at the zone's clock."""
    return F.date_format(F.from_utc_timestamp(col(instant), zone), "yyyy-MM-dd")


def local_time(instant: Column | str, zone: str = ZONE) -> Column:
    return F.date_format(F.from_utc_timestamp(col(instant), zone), "HH:mm")


def iso(text: Column | str) -> Column:
    """An ISO instant; without an offset it is UTC; null if it is none."""
    x = F.trim(col(text))
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(x))


def turkish(text: Column | str) -> Column:
    """Local time of "22 Mart 2026, Pazar 14:00"; without a time midnight; other text is null."""
    x = clean_settled(text)
    year, month, day = F.regexp_extract(x, LONG_DATE, 3), month_number(F.regexp_extract(x, LONG_DATE, 2)), F.regexp_extract(x, LONG_DATE, 1)
    time = F.regexp_extract(x, LONG_DATE + r"\D*(\d{1,2}[:.]\d{2})", 4)
    time = F.when(time == "", F.lit("00:00")).otherwise(F.lpad(F.replace(time, F.lit("."), F.lit(":")), 5, "0"))
    return F.when(month.isNotNull(), _made(year, month, day, time))


def dotted(text: Column | str) -> Column:
    """Local time of "22.03.2026 14:00" or with slashes; without a time midnight."""
    pattern = r"(\d{1,2})[./](\d{1,2})[./](\d{4})(?:\s+(\d{2}:\d{2}))?"
    x = col(text)
    time = F.regexp_extract(x, pattern, 4)
    return F.when(x.rlike(pattern), _made(F.regexp_extract(x, pattern, 3), F.regexp_extract(x, pattern, 2), F.regexp_extract(x, pattern, 1), F.when(time == "", "00:00").otherwise(time)))


def epoch(text: Column | str) -> Column:
    """Seconds, or milliseconds above 1e11."""
    n = F.try_to_number(F.regexp_extract(F.trim(col(text)), r"^(\d{9,14})$", 1), F.lit("99999999999999"))
    return F.timestamp_millis(F.when(n > 100_000_000_000, n).otherwise(n * 1000).cast("long"))


def rfc2822(text: Column | str) -> Column:
    """"Tue, 22 Mar 2026 14:00:00 +0300"."""
    p = r"(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})\s+(\d{2}:\d{2})(?::(\d{2}))?\s*([+-]\d{4}|GMT|UTC|Z)?"
    x = col(text)
    month = cases([(F.lower(F.regexp_extract(x, p, 2)) == m, f"{i:02d}") for i, m in enumerate(ENGLISH_MONTHS, 1)])
    seconds, zone = F.regexp_extract(x, p, 5), F.regexp_extract(x, p, 6)
    offset = F.when(zone.rlike(r"^[+-]"), F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2))).otherwise("+00:00")
    stamp = F.concat(F.regexp_extract(x, p, 3), F.lit("-"), month, F.lit("-"), F.lpad(F.regexp_extract(x, p, 1), 2, "0"), F.lit("T"), F.regexp_extract(x, p, 4), F.lit(":"), F.when(seconds == "", "00").otherwise(seconds), offset)
    return F.when(x.rlike(p), F.try_to_timestamp(stamp))


def feed_instant(text: Column | str, zone: str = ZONE) -> Column:
    """The first reading that works: epoch, ISO (a bare date is local midnight), Turkish, dotted, RFC 2822."""
    x = F.trim(col(text))
    bare = F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), local_to_utc(F.try_to_timestamp(x, F.lit("yyyy-MM-dd")), zone))
    return F.coalesce(epoch(x), bare, iso(x), local_to_utc(turkish(x), zone), local_to_utc(dotted(x), zone), rfc2822(x))


def near_time(text: Column | str, within: int = 150, zone: str = ZONE) -> Column:
    """The first long, else dotted, date in a text, with a time at most `within` characters behind it (else midnight)."""
    x = clean_settled(text)

    def read(pattern: str, month: Column, groups: tuple[int, int, int]) -> Column:
        time = F.regexp_extract(x, pattern + r".{0," + str(within) + r"}?\b([01]?\d|2[0-3])[:.]([0-5]\d)\b", 4)
        minute = F.regexp_extract(x, pattern + r".{0," + str(within) + r"}?\b([01]?\d|2[0-3])[:.]([0-5]\d)\b", 5)
        clock = F.when(time == "", F.lit("00:00")).otherwise(F.concat(F.lpad(time, 2, "0"), F.lit(":"), minute))
        return F.when(month.isNotNull() & x.rlike(pattern), _made(F.regexp_extract(x, pattern, groups[0]), month, F.regexp_extract(x, pattern, groups[2]), clock))

    dots = r"\b(\d{1,2})[./](\d{1,2})[./](\d{4})\b"
    found = F.coalesce(read(LONG_DATE, month_number(F.regexp_extract(x, LONG_DATE, 2)), (3, 2, 1)), read(dots, F.nullif(F.regexp_extract(x, dots, 2), F.lit("")), (3, 2, 1)))
    return local_to_utc(found, zone)


def search_instant(text: Column | str, as_of: Column | str, zone: str = ZONE) -> Column:
    """"Mar 22", "Mar 22, 7:30 PM" or ISO; no time is 20:00; the year is as_of's, or the next if over 30 days past; else as_of."""
    x, now = F.trim(col(text)), F.from_utc_timestamp(col(as_of), zone)
    p = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+(\d{1,2})(?:,?\s+(\d{1,2})(?::(\d{2}))?\s*([AP]M))?"
    month = cases([(F.lower(F.regexp_extract(x, p, 1)) == m, i) for i, m in enumerate(ENGLISH_MONTHS, 1)])
    hour, minute, half = F.try_to_number(F.nullif(F.regexp_extract(x, p, 3), F.lit("")), F.lit("99")), F.regexp_extract(x, p, 4), F.upper(F.regexp_extract(x, p, 5))
    clock = F.when(hour.isNull(), F.lit("20:00")).otherwise(F.concat(F.lpad(((hour % 12) + F.when(half == "PM", 12).otherwise(0)).cast("int").cast("string"), 2, "0"), F.lit(":"), F.when(minute == "", "00").otherwise(minute)))
    this = _made(F.year(now), month, F.regexp_extract(x, p, 2), clock)
    rolled = F.when(this < now - F.expr("interval 30 days"), this + F.expr("interval 1 year")).otherwise(this)
    bare = F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), local_to_utc(F.try_to_timestamp(F.concat(x, F.lit(" 20:00")), F.lit("yyyy-MM-dd HH:mm")), zone))
    return F.coalesce(bare, iso(x), F.when(x.rlike(p), local_to_utc(rolled, zone)), col(as_of))


def day_range(text: Column | str, most: int = 31) -> Column:
    """Days of "5-7 mayıs" or "5 ve 6 mayıs" as an array; over `most` days, or other text: null."""
    p = r"(\d{1,2})\s*(?:-|–|ve)\s*(\d{1,2})\s+[A-Za-zÇĞİÖŞÜçğıöşü]+"
    a, b = (F.try_to_number(F.nullif(F.regexp_extract(col(text), p, i), F.lit("")), F.lit("99")).cast("int") for i in (1, 2))
    return F.when((b >= a) & (b - a < most), F.sequence(a, b))


def roll_forward(month: Column, day: Column, posted: Column | str) -> Column:
    """The date of a day without a year: in the posting's year, or the next if that is before the posting."""
    p = F.to_date(col(posted))
    this = F.try_to_timestamp(F.concat_ws("-", F.year(p), month, day), F.lit("yyyy-M-d")).cast("date")
    return F.when(this < p, F.add_months(this, 12)).otherwise(this)


def soonest(days: Column | str, as_of: Column | str) -> Column:
    """Of an array of dates or instants the first from as_of on, else the first of all; null without any."""
    x, now = F.filter(col(days), lambda d: d.isNotNull()), col(as_of)
    return F.coalesce(F.array_min(F.filter(x, lambda d: d >= now)), F.array_min(x))


def event_date(text: Column | str, posted: Column | str, as_of: Column | str, within: int = 120, zone: str = ZONE) -> Column:
    """The instant of the soonest date a post's text names, among all of them; null without any.

    Dates are "5 mayıs 2026", "5-7 mayıs", "5 ve 6 mayıs" (every day of a range), "05.05.2026" and
    "05/05/2026"; those without a year are in the posting's, or the next if that is past. The first time at most
    `within` characters behind a date is its own; of readings of one day one with a time is taken. The
    soonest from the later of posting and as_of on counts, else the first of all.
    """
    now = F.from_utc_timestamp(col(as_of), zone)
    parts = F.struct(trend_fold(clean_settled(text)).alias("text"), now.alias("now"), F.coalesce(F.from_utc_timestamp(col(posted), zone), now).alias("post"))

    def pick(s: Column) -> Column:  # the text is worked out once
        x, now, post = s["text"], s["now"], s["post"]

        def each(pattern: str, *groups: str) -> Column:
            """The groups of each match and what stands behind it: the text is searched once, its matches are taken apart."""
            found = F.regexp_extract_all(x, F.lit(rf"(?=((?:{pattern})(?s:.{{0,{within}}})))(?:{pattern})"), 1)
            parts = lambda m: [F.regexp_extract(m, "^" + pattern, i).alias(g) for i, g in enumerate(groups, 1)]
            return F.transform(found, lambda m: F.struct(*parts(m), F.regexp_replace(m, "^" + pattern, "").alias("rest")))

        def number(t: Column) -> Column:
            return F.nullif(t, F.lit("")).cast("int")  # digits or nothing: a failing cast would cost more than all else

        def read(year: Column, month: Column, day: Column, rest: Column) -> Column:
            clock = F.split(F.regexp_extract(rest, r"\d{1,2}[:.]\d{2}", 0), "[:.]")
            parts = F.struct(year.alias("stated"), F.coalesce(year, F.year(post)).alias("year"), month.alias("month"), day.alias("day"), clock.alias("clock"))
            return once(once(parts, dated), timed)

        def dated(d: Column) -> Column:
            first = F.when((d["year"] > 0) & d["month"].between(1, 12), F.make_date(d["year"], d["month"], F.lit(1)))
            own = once(first, lambda f: F.when(d["day"].between(1, F.day(F.last_day(f))), F.date_add(f, d["day"] - 1)))
            rolled = once(own, lambda o: F.when(d["stated"].isNull() & (o < post.cast("date")), F.add_months(o, 12)).otherwise(o))
            hour, minute = (number(F.get(d["clock"], i)) for i in (0, 1))
            return F.struct(rolled.alias("day"), hour.alias("hour"), minute.alias("minute"))

        def timed(d: Column) -> Column:
            fits = F.coalesce((d["hour"] <= 23) & (d["minute"] <= 59), F.lit(False))
            minutes = F.when(fits, d["hour"] * 60 + d["minute"]).otherwise(0)
            at = F.make_timestamp(F.year(d["day"]), F.month(d["day"]), F.day(d["day"]), F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int"), F.lit(0))
            return F.struct(d["day"].alias("day"), (minutes == 0).alias("midnight"), at.alias("at"))

        def days(z: Column) -> Column:
            a, b = number(z["a"]), F.coalesce(number(z["b"]), number(z["c"]))
            return F.when(b.isNull(), F.array(a)).when((b > a) & (b - a < 31), F.sequence(a, F.greatest(a, b))).otherwise(F.array(a, b))

        named = each(r"(\d{1,2})\s*(?:[-–—/]\s*(\d{1,2})|\s+ve\s+(\d{1,2}))?\s+([a-z]+)(?:\s+(\d{4}))?", "a", "b", "c", "month", "year")
        named = F.filter(named, lambda z: z["month"].isin(MONTHS))
        spelled = F.flatten(F.transform(named, lambda z: F.transform(days(z), lambda d: read(number(z["year"]), F.array_position(F.array(*map(F.lit, MONTHS)), z["month"]).cast("int"), d, z["rest"]))))
        figures = [F.transform(each(p, "day", "month", "year"), lambda z: read(number(z["year"]), number(z["month"]), number(z["day"]), z["rest"])) for p in (r"(\d{2})\.(\d{2})\.(\d{4})", r"(\d{2})/(\d{2})/(\d{4})")]
        since = F.greatest(post, now).cast("date")
        ranked = F.transform(F.filter(F.concat(spelled, *figures), lambda c: c["day"].isNotNull()), lambda c, i: F.struct((c["day"] < since).alias("past"), c["day"].alias("day"), c["midnight"].alias("midnight"), i.alias("i"), c["at"].alias("at")))
        return local_to_utc(F.array_min(ranked)["at"], zone)

    return once(parts, pick)


def date_key(text: Column | str) -> Column:
    """yyyy-MM-dd of an ISO date or instant, else the text's match key."""
    from playbill.functions.text import normalize_for_match

    x = F.trim(col(text))
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(x, 1, 10)).otherwise(normalize_for_match(x))


def next_week(as_of: Column | str) -> tuple[Column, Column]:
    """Next Monday (a week ahead on a Monday) and the Sunday after it."""
    monday = F.next_day(col(as_of), "MO")
    return monday, F.date_add(monday, 6)


def display_date(day: Column | str) -> Column:
    """22 Mar 2026 with Turkish month letters; null is a question mark."""
    d = col(day)
    shown = F.concat_ws(" ", F.day(d).cast("string"), F.element_at(F.array(*map(F.lit, MONTH_SHORT)), F.month(d)), F.year(d).cast("string"))
    return F.when(d.isNotNull(), shown).otherwise("?")
