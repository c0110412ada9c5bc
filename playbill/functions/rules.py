"""Classification rules: ordered tables, the first that matches wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playbill.functions.columns import cases, col, lookup
from playbill.functions.text import ascii_fold, drop_marks

# Keywords and categories with the event type they stand for, in the order they are tried.
SHARED_KEYWORDS = {
    "konser": "concert", "muzik": "concert", "müzik": "concert", "tiyatro": "theatre", "stand up": "standup", "stand-up": "standup",
    "komedi": "standup", "festival": "festival", "sinema": "cinema", "film": "cinema", "sergi": "exhibition", "atolye": "experience",
    "atölye": "experience", "workshop": "experience", "etkinlik": "experience", "söyleşi": "show", "panel": "show", "konferans": "show",
}
SEGMENTS = {
    "music": "concert", "muzik": "concert", "müzik": "concert", "sports": "match", "spor": "match", "arts": "theatre", "theatre": "theatre",
    "theater": "theatre", "sahne": "theatre", "tiyatro": "theatre", "family": "kids", "aile": "kids", "education": "workshop",
    "egitim": "workshop", "eğitim": "workshop", "eğitim & fazlası": "workshop", "egitim & fazlasi": "workshop", "miscellaneous": "social",
}
SEGMENT_KEYWORDS = {
    "standup": "standup", "stand-up": "standup", "stand up": "standup", "comedy": "standup", "music": "concert", "concert": "concert",
    "theatre": "theatre", "theater": "theatre", "arts": "theatre", "arts & theatre": "theatre", "performing arts": "theatre",
    "family": "kids", "sports": "match", "film": "cinema", "festival": "festival", "exhibition": "exhibition", "workshop": "workshop",
    "muzik": "concert", "müzik": "concert", "spor": "match", "sahne": "theatre", "aile": "kids", "egitim": "workshop", "eğitim": "workshop",
    "eğitim & fazlası": "workshop", "egitim & fazlasi": "workshop", "sergi": "exhibition", "tiyatro": "theatre", "miscellaneous": "social",
}
SEARCH_SIGNALS = {
    "standup": ["stand up", "stand-up", "standup", "komedi show"],
    "concert": ["konser", "concert", " tour", "canlı müzik", "canli muzik", "gig", "live müzik", "live performance", "tickets for"],
    "theatre": ["tiyatro", "müzikal", "opera ", "opera'", "bale "],
    "cinema": ["sinema", "film göster", "belgesel göster", "özel gösterim"],
    "exhibition": ["sergi ", "sergisin", "sanat galerisi", "fotoğraf sergisi"],
    "festival": ["festival", " fest "],
    "workshop": ["workshop", "atölye", "masterclass", "bootcamp"],
    "kids": ["çocuk etkinlik", "aile etkinlik", "çocuklar için"],
    "match": ["maç", "futbol maç", "basketbol maç", "voleybol maç", "lig maçı", "deplasman", " vs ", "karşılaşması", "playoff", "derbi maç"],
}
SPORT_TITLES = ["maç", "futbol", "basketbol", "voleybol", "tenis", "formula", "mma", "boks", " lig", "derbi", "esport", "maraton", "marathon", "kupa", "turnuva", "playoff", "championship", " vs "]
QUERY_TYPES = {
    "concert": "concert", "theater": "theatre", "cinema": "cinema", "art": "exhibition", "standup": "standup", "festival": "festival",
    "sports": "match", "workshop": "workshop", "experience": "festival", "family": "kids",
}
ACTIVITY_CATEGORIES = {
    "aktivite": "activity", "aktiviteler": "activity", "eglence": "activity", "egitim": "workshop", "atolye": "workshop", "konser": "concert",
    "muzik": "concert", "tiyatro": "theatre", "sahne": "theatre", "dans": "theatre", "opera": "theatre", "muzikal": "theatre",
    "gosteri": "theatre", "stand-up": "standup", "standup": "standup", "stand up": "standup", "festival": "festival", "spor": "match",
    "sinema": "cinema", "sergi": "exhibition", "muze": "exhibition",
}
ACTIVITY_TITLES = [
    ("konser|konserl|concert|fest|festival|live", "concert"), ("tiyatro|sahne|opera|bale|dans|musical|müzikal", "theatre"),
    ("stand.?up|standup|komedi", "standup"), ("maç|mac|futbol|basketbol|spor|voleybol", "match"), ("akvaryum|aquarium|hayvanat|zoo", "activity"),
    ("teleferik|zipline|macera|park|tematik|tema", "activity"), ("müze|muze|museum|sergi|galeri", "exhibition"),
    ("tur|tour|gezi|tekne|bogaz|boğaz|ada", "activity"), ("havuz|yüzme|yuzme", "activity"), ("seyir|kule|terrace|skyview|sky view", "activity"),
    ("workshop|atolye|atölye|egitim|eğitim|seminer", "workshop"), ("sinema|film|cinema|movie", "cinema"),
]
PARTNER_CATEGORIES = {
    "konser": "concert", "festival": "festival", "sahne": "theatre", "tiyatro": "theatre", "stand-up": "standup", "workshop": "workshop",
    "eğitim": "workshop", "egitim": "workshop", "topluluklar": "social", "kamp": "workshop", "parti": "social",
    "çocuk etkinlikleri": "kids", "cocuk etkinlikleri": "kids", "diğer": "social", "diger": "social",
}
FEED_CATEGORIES = {"tiyatro": "theatre", "muzik": "concert"}
FEED_SUBCATEGORIES = {"cocuk-tiyatrosu": "kids"}
TREND_CATEGORIES = ["concert", "theatre", "cinema", "activity", "exhibition", "standup", "festival", "sports", "workshop", "food", "kids", "social"]
SEARCHED_TREND_CATEGORIES = ["concert", "theatre", "standup", "festival"]


def keyword(text: Column | str, table: dict[str, str], default: str | None) -> Column:
    """The type of the first keyword that the lower-cased text contains."""
    lower = F.lower(F.coalesce(col(text), F.lit("")))
    return cases([(F.contains(lower, F.lit(k)), v) for k, v in table.items()], default)


def _any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def shared_type(text: Column | str) -> Column:
    return keyword(text, SHARED_KEYWORDS, "experience")


def segment_type(title: Column | str, segment: Column | str, classification_text: Column | str) -> Column:
    """Title overrides, then the primary segment, then keywords of all classifications, else show."""
    t, s = F.lower(F.coalesce(col(title), F.lit(""))), F.lower(F.trim(col(segment)))
    by_title = cases([(_any(t, ["stand up", "stand-up", "standup"]), "standup"), (_any(t, ["konser", "concert", " tour"]), "concert")])
    return F.coalesce(by_title, lookup(s, SEGMENTS), keyword(classification_text, SEGMENT_KEYWORDS | {k: v for k, v in SHARED_KEYWORDS.items() if k not in SEGMENT_KEYWORDS}, "show"))


def search_type(title: Column | str, description: Column | str, query_category: Column | str) -> Column:
    """Signals in title and description, else the query's category; match only with a sport in the title, else festival."""
    t = F.lower(F.coalesce(col(title), F.lit("")))
    content = F.concat_ws(" ", t, F.lower(F.coalesce(col(description), F.lit(""))))
    mapped = lookup(query_category, QUERY_TYPES, F.lit("festival"))
    asked = F.when((mapped == "match") & ~_any(t, SPORT_TITLES), F.lit("festival")).otherwise(mapped)
    return cases([(_any(content, words), kind) for kind, words in SEARCH_SIGNALS.items()], asked)


def activity_type(categories: Column | str, title: Column | str, slug: Column | str) -> Column:
    """The first known category of an array, else the first word rule on the folded title and slug, else activity."""
    known = F.filter(F.transform(col(categories), lambda c: lookup(ascii_fold(F.trim(c), dotless=False), ACTIVITY_CATEGORIES)), lambda c: c.isNotNull())
    text = drop_marks(F.lower(F.concat_ws(" ", col(title), col(slug))))
    return F.coalesce(F.get(known, 0), cases([(text.rlike(rf"(?u)\b(?:{p})\b"), v) for p, v in ACTIVITY_TITLES], "activity"))


def partner_type(category: Column | str) -> Column:
    c = F.lower(F.trim(col(category)))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("other")).otherwise(lookup(c, PARTNER_CATEGORIES, c))


def feed_type(category: Column | str, subcategory: Column | str) -> Column:
    """Null for categories that aren't known: such rows are dropped."""
    return F.coalesce(lookup(F.lower(F.trim(col(subcategory))), FEED_SUBCATEGORIES), lookup(F.lower(F.trim(col(category))), FEED_CATEGORIES))
