"""HTML and JSON functions over columns: titles, labels, images, prices in pages, fields of mixed JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playbill.functions.columns import col, filled, first_filled, once
from playbill.functions.prices import offers_fold
from playbill.functions.text import clean_settled, clean_text, strip_html, strip_settled, truncate
from playbill.functions.urls import absolute


def _strip(settled: bool, closed: bool):
    return strip_settled if settled else lambda x: strip_html(x, closed)


def title(html: Column | str, settled: bool = False, closed: bool = False) -> Column:
    """Text of the first h1, else of the title element; null if both are blank. settled: text.settle() has been over the page; closed: see text.unescape_all()."""
    x, strip = col(html), _strip(settled, closed)
    return F.coalesce(*(filled(strip(F.regexp_extract(x, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1))) for tag in ("h1", "title")))


def lines(html: Column | str, settled: bool = False) -> Column:
    """The text's lines: block ends and breaks end one."""
    x = F.regexp_replace(col(html), r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6]|/td|/dd|/dt)[^>]*>", "\n")
    x = F.regexp_replace(x, "<[^>]+>", " ")
    clean = clean_settled if settled else clean_text
    return F.filter(F.transform(F.split(x, "\n"), lambda s: clean(s)), lambda s: s != "")


def label_value(html: Column | str, *labels: str, settled: bool = False) -> Column:
    """What stands behind the first of the labels (in their order) that begins a line, after a colon."""
    text = F.array_join(lines(html, settled), "\n")
    return F.coalesce(*(filled(F.regexp_extract(text, rf"(?imu)^\s*{label}\s*:\s*(.+)$", 1)) for label in labels))


def body_text(html: Column | str, most: int = 250, settled: bool = False, closed: bool = False) -> Column:
    bare = F.regexp_replace(col(html), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    return truncate(_strip(settled, closed)(bare), most)


def first_image(html: Column | str, base: Column | str) -> Column:
    src = F.regexp_extract(col(html), r"""(?i)<img[^>]+src\s*=\s*["']([^"']+)""", 1)
    return F.when(src != "", absolute(src, base))


def meta_description(html: Column | str) -> Column:
    """The description meta element, its quotes matching."""
    x = col(html)
    a = F.regexp_extract(x, r"""(?is)<meta[^>]+name=["']description["'][^>]+content=(["'])(.*?)\1""", 2)
    b = F.regexp_extract(x, r"""(?is)<meta[^>]+content=(["'])(.*?)\1[^>]+name=["']description["']""", 2)
    return F.coalesce(filled(clean_text(a)), filled(clean_text(b)))


def _meta(x: Column, attribute: str, name: str) -> list[Column]:
    q = "[\"']"
    return [
        F.regexp_extract(x, rf"(?i)<meta[^>]+{attribute}={q}{name}{q}[^>]+content={q}([^\"']+)", 1),
        F.regexp_extract(x, rf"(?i)<meta[^>]+content={q}([^\"']+){q}[^>]+{attribute}={q}{name}", 1),
    ]


def meta_price(html: Column | str, min_length: int = 200) -> Column:
    """The price text of event:price, price or itemprop meta elements; null for pages shorter than min_length."""
    x = col(html)
    found = [m for a, n in (("property", "event:price"), ("name", "price"), ("itemprop", "price")) for m in _meta(x, a, n)]
    return F.when(F.length(x) >= min_length, F.coalesce(*(filled(clean_text(m)) for m in found)))


OFFER = "struct<price:string,lowPrice:string,highPrice:string,minPrice:string,maxPrice:string,priceCurrency:string,currency:string>"


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def _offers_of(node: Column) -> Column:
    """Offers of a JSON-LD node (a JSON text): an object or a list of them."""
    raw = F.when(_may_hold(node, "offers"), F.get_json_object(node, "$.offers"))
    return once(raw, lambda x: F.when(x.isNotNull(), F.coalesce(F.from_json(x, f"array<{OFFER}>"), F.array(F.from_json(x, OFFER)))))


def _may_hold(node: Column, word: str) -> Column:
    """Whether a JSON text can have the word in a key or text, in any case: it is there, or something is escaped."""
    return F.contains(F.lower(node), F.lit(word)) | F.contains(node, F.lit("\\u"))


def _nodes(block: Column) -> Column:
    """The nodes of a JSON-LD block: itself, a list's elements, an item list's items."""
    listed = F.coalesce(F.when(block.rlike(r"^\s*\["), F.from_json(block, "array<string>")), F.array(block))
    return once(listed, _with_items)


def _with_items(listed: Column) -> Column:
    items = F.transform(listed, lambda n: F.when(_may_hold(n, "list") & F.lower(F.get_json_object(n, "$['@type']")).isin("itemlist", "list"), F.from_json(F.get_json_object(n, "$.itemListElement"), "array<string>")))
    inner = F.flatten(F.transform(F.filter(items, lambda i: i.isNotNull()), lambda i: F.transform(i, lambda e: F.coalesce(F.get_json_object(e, "$.item"), e))))
    return F.concat(inner, listed)


def jsonld_price(html: Column | str, min_length: int = 200) -> Column:
    """struct(min, max, currency) of the first JSON-LD node with a priced offer; null if none.

    Broken blocks are skipped. Of a node's offers the least price counts, the last high price and
    the first currency.
    """
    x = col(html)
    blocks = F.regexp_extract_all(x, F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), 1)
    nodes = F.flatten(F.transform(blocks, _nodes))
    read = F.transform(
        nodes,
        lambda n: offers_fold(
            F.transform(
                F.coalesce(_offers_of(n), F.array().cast(f"array<{OFFER}>")),
                lambda o: F.struct(
                    _number(o["price"]).alias("price"),
                    F.least(_number(o["lowPrice"]), _number(o["minPrice"])).alias("low"),
                    F.coalesce(_number(o["maxPrice"]), _number(o["highPrice"])).alias("high"),
                    F.coalesce(o["priceCurrency"], o["currency"]).alias("currency"),
                ),
            )
        ),
    )
    priced = F.filter(read, lambda p: p["min"].isNotNull() | p["max"].isNotNull())
    return F.when(F.length(x) >= min_length, F.get(priced, 0))


# Mixed JSON: a field may be text, an object or a list.


def json_text(payload: Column | str, path: str) -> Column:
    """Cleaned text at a path: an object's rendered, text, name or title; a list's first such; else the scalar."""

    def scalar(x: Column) -> Column:
        held = F.coalesce(*(F.get_json_object(x, f"$.{k}") for k in ("rendered", "text", "name", "title")))
        return F.when(x.rlike(r"^\s*\{"), held).when(~x.rlike(r"^\s*\["), x)

    def read(raw: Column) -> Column:
        first = F.get(F.filter(F.transform(F.from_json(raw, "array<string>"), scalar), lambda s: F.coalesce(F.trim(s), F.lit("")) != ""), 0)
        return F.when(raw.rlike(r"^\s*\["), first).otherwise(scalar(raw))

    return once(once(F.get_json_object(col(payload), path), read), lambda x: filled(strip_html(x)))


def variant_text(value: Column) -> Column:
    """Cleaned text of a VARIANT made of settled JSON: an object's first filled rendered, text, name or title; a list's first such; else the scalar."""

    def scalar(x: Column) -> Column:
        whole = F.try_variant_get(x, "$", "string")
        return F.coalesce(*(filled(F.try_variant_get(x, f"$.{k}", "string")) for k in ("rendered", "text", "name", "title")), F.when(~whole.rlike(r"^\s*[\[{]"), whole))

    listed = F.try_variant_get(value, "$", "array<variant>")
    first = F.get(F.filter(F.transform(listed, scalar), lambda s: F.coalesce(F.trim(s), F.lit("")) != ""), 0)
    return filled(strip_settled(F.when(listed.isNotNull(), first).otherwise(scalar(value))))


def variant_texts(payload: Column | str, paths: list[str]) -> Column:
    """The cleaned text at each path of a VARIANT; how texts are cleaned is in the plan once, however many paths there are."""
    return F.transform(F.array(*(F.try_variant_get(col(payload), p, "variant") for p in paths)), variant_text)


def variant_images(payload: Column | str) -> Column:
    """Where a post's picture may be, in order: embedded media, then fields that are a link, or an object with one or with sizes."""
    media = [f"$._embedded['wp:featuredmedia'][0].{k}" for k in ("source_url", "guid", "url")]
    inside = ["", ".url", ".src", ".link", *(f".sizes.{size}.{k}" for size in ("full", "large", "medium", "thumbnail") for k in ("url", "source_url"))]
    fields = [f"$.{f}{k}" for f in ("jetpack_featured_media_url", "featured_image", "image", "thumbnail") for k in inside]
    return F.filter(F.array(*(F.try_variant_get(col(payload), p, "string") for p in [*media, *fields])), lambda x: ~x.rlike(r"^\s*([\[{]|$)"))


def nested(payload: Column | str, *names: str, containers: tuple[str, ...] = ("$", "$.meta", "$.acf")) -> Column:
    """The first filled field of the names, looked for in each container in turn."""
    return F.coalesce(*(json_text(payload, f"{c}.{n}") for c in containers for n in names))


def first_json(payload: Column | str, *paths: str) -> Column:
    """The first filled scalar of the paths."""
    return first_filled(*(F.get_json_object(col(payload), p) for p in paths))


def widest_image(images: Column | str) -> Column:
    """URL of the widest image of an array of (url, width); the first of equals, no width is 0, only http links."""
    arr = F.transform(col(images), lambda x, i: F.struct(F.coalesce(x["width"].cast("long"), F.lit(0)).alias("w"), (-i).alias("place"), x["url"].alias("url")))
    return F.array_max(F.filter(arr, lambda x: x["url"].rlike("^https?://")))["url"]
