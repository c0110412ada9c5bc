"""URL functions: comparison keys, hosts, absolute links, query parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playbill.functions.columns import col


def _with_scheme(url: Column) -> Column:
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), url).when(F.startswith(url, F.lit("//")), F.concat(F.lit("http:"), url)).otherwise(F.concat(F.lit("http://"), url))


def _authority(url: Column | str) -> Column:
    return F.regexp_extract(_with_scheme(F.trim(col(url))), r"^[^:]+://([^/?#]*)", 1)


def host_of(url: Column | str) -> Column:
    """Lower-cased host without user, port and www.; a missing scheme is allowed; empty if there is none."""
    bare = F.regexp_replace(F.regexp_replace(_authority(url), r"^.*@", ""), r":\d*$", "")
    return F.regexp_replace(F.lower(bare), r"^www\.", "")


def path_of(url: Column | str) -> Column:
    """The path without query and fragment."""
    return F.regexp_extract(_with_scheme(F.trim(col(url))), r"^[^:]+://[^/?#]*([^?#]*)", 1)


def url_key(url: Column | str) -> Column:
    """host and path by which links are compared: no scheme, query, fragment, trailing slash; a lone slash stays."""
    path = path_of(url)
    return F.concat(host_of(url), F.when(path == "/", path).otherwise(F.regexp_replace(path, "/+$", "")))


def host_in(url: Column | str, domain: str) -> Column:
    """The host is the domain or one under it; look-alikes aren't."""
    host = host_of(url)
    return (host == domain) | F.endswith(host, F.lit("." + domain))


def is_link(url: Column | str) -> Column:
    return F.coalesce(col(url).rlike(r"^https?://[^/\s]+"), F.lit(False))


def absolute(link: Column | str, base: Column | str) -> Column:
    """link as seen from the page base."""
    x, b = F.trim(col(link)), F.trim(col(base))
    origin = F.regexp_extract(b, r"^[^:]+://[^/?#]*", 0)
    folder = F.regexp_extract(F.regexp_replace(b, r"[?#].*$", ""), r"^[^:]+://[^/]*(?:/.*/|/)?", 0)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), x)
        .when(F.startswith(x, F.lit("//")), F.concat(F.substring_index(b, "://", 1), F.lit(":"), x))
        .when(F.startswith(x, F.lit("/")), F.concat(origin, x))
        .when(x == "", b)
        .otherwise(F.concat(folder, x))
    )


def set_params(url: Column | str, params: dict[str, str]) -> Column:
    """url with the given query parameters; others, and the fragment, stay."""
    x = col(url)
    fragment = F.regexp_extract(x, r"(#.*)$", 1)
    bare = F.regexp_replace(x, r"#.*$", "")
    base, query = F.substring_index(bare, "?", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    names = F.array(*map(F.lit, params))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.array_contains(names, F.substring_index(p, "=", 1)))
    added = F.array(*(F.concat(F.lit(k + "="), F.url_encode(F.lit(v))) for k, v in params.items()))
    return F.concat(base, F.lit("?"), F.array_join(F.concat(kept, added), "&"), fragment)


def redirect_target(url: Column | str, domain: str) -> Column:
    """The page on domain that a link, or the decoded u parameter of a redirect link, leads to; else null.

    A performance path becomes the event page's; query and fragment go.
    """
    x = col(url)
    inner = F.regexp_extract(x, r"[?&]u=([^&#]*)", 1)
    target = F.when(F.contains(host_of(x), F.lit(domain)), x).when(inner != "", F.try_url_decode(inner))
    bare = F.regexp_replace(target, r"[?#].*$", "")
    page = F.regexp_replace(bare, r"^([^:]+://[^/]+)/performance/([A-Za-z0-9]+)/\d+/([A-Za-z]+)/(\w+)/?$", "$1/etkinlik/$2/$3/$4")
    return F.when(F.contains(host_of(target), F.lit(domain)), page)


def provider_link(name: str, url: Column | str) -> Column:
    """Name|url, or null without a link."""
    return F.when(is_link(url), F.concat(F.lit(name + "|"), col(url)))
