"""URLs and hosts as columns; only http and https, and never an exception for a malformed one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Paths that hold no page.
NON_CONTENT = r"(?i)(?:^|/)(?:sitemap(?:[_-][^/]*)?\.xml(?:\.gz)?|robots\.txt)\z|\.(?:css|js|mjs|map|json|xml|pdf|jpe?g|png|gif|webp|svg|ico|woff2?|ttf|eot|zip|gz|mp[34]|webm|avi|mov)\z"
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]+)?([^?#]*)(\?[^#]*)?(#.*)?\z"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, PARTS, group)


def host_of(url: Column) -> Column:
    return F.lower(_part(url, 2))


def site_key(url: Column) -> Column:
    """Lower-case host without one leading ``www.``."""
    return F.regexp_replace(host_of(url), r"^www\.", "")


def path_of(url: Column) -> Column:
    return F.when(_part(url, 4) == "", F.lit("/")).otherwise(_part(url, 4))


def is_http(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(?i:https?)://[^/?#\s]+"), F.lit(False))


def without_fragment(url: Column) -> Column:
    """Scheme and host lower-cased, a path at least, no fragment."""
    port = F.regexp_replace(_part(url, 3), r"^:(?:80|443)\z", "")
    return F.concat(F.lower(_part(url, 1)), F.lit("://"), host_of(url), port, path_of(url), _part(url, 5))


def origin(url: Column) -> Column:
    return F.concat(F.lower(_part(url, 1)), F.lit("://"), host_of(url), _part(url, 3), F.lit("/"))


def dedupe_key(url: Column) -> Column:
    """Host, path without closing slashes, and query."""
    bare = F.regexp_replace(path_of(url), r"/+\z", "")
    return F.concat(site_key(url), F.when(bare == "", F.lit("/")).otherwise(bare), _part(url, 5))


def normalize_website(raw: Column) -> Column:
    """(key, original, origin) of a site given by URL or host; null if it can be none."""
    given = F.trim(raw)
    url = F.when(given.rlike(r"^(?i:https?)://"), given).otherwise(F.concat(F.lit("https://"), given))
    usable = (F.coalesce(given, F.lit("")) != "") & is_http(url) & host_of(url).contains(".") & ~host_of(url).rlike(r"\s")
    whole = F.concat(without_fragment(url), _part(url, 6))
    return F.when(usable, F.struct(site_key(url).alias("key"), whole.alias("original"), origin(url).alias("origin")))


def normalize_domain(raw: Column) -> Column:
    """Anything like a URL to a bare host name; null if it can be none."""
    s = F.lower(F.trim(raw))
    for pattern in (r"^[a-z]+://", r"(?s)[/?#].*\z", r":[0-9]+\z", r"^www[0-9]?\.", r"\.\z"):
        s = F.regexp_replace(s, pattern, "")
    return F.when(s.contains(".") & ~s.rlike(r"\s"), s)


def resolve(link: Column, base: Column) -> Column:
    """A link as an absolute URL without fragment: full, scheme-relative, root-relative or relative to the page; else null."""
    link = F.regexp_replace(F.trim(link), "#.*", "")
    folder = F.concat(F.lower(_part(base, 1)), F.lit("://"), host_of(base), _part(base, 3), F.regexp_replace(path_of(base), r"[^/]*\z", ""))
    full = (
        F.when(is_http(link), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(F.startswith(link, F.lit("//")), F.concat(F.lower(_part(base, 1)), F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(F.regexp_replace(origin(base), r"/\z", ""), link))
        .when(F.startswith(link, F.lit("?")), F.concat(F.lower(_part(base, 1)), F.lit("://"), host_of(base), _part(base, 3), path_of(base), link))
        .otherwise(F.concat(folder, link))
    )
    return without_dots(without_fragment(full))


def without_dots(url: Column) -> Column:
    """A URL whose path has no "." and ".." steps, however many there were; a step above the root stays there."""
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)/([^?#]*)(.*)\z"
    steps = F.split(F.regexp_extract(url, parts, 2), "/")
    back, stay = (lambda s: F.lower(s).isin("..", ".%2e", "%2e.", "%2e%2e")), (lambda s: F.lower(s).isin(".", "%2e"))
    walk = lambda done, s: F.when(back(s), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(stay(s), done).otherwise(F.array_append(done, s))
    kept = F.aggregate(steps, F.array().cast("array<string>"), walk)
    last = F.element_at(steps, -1)
    # A path that ends in such a step is a folder.
    ended = F.when(back(last) | stay(last), F.array_append(kept, F.lit(""))).otherwise(kept)
    plain = F.concat(F.regexp_extract(url, parts, 1), F.lit("/"), F.array_join(ended, "/"), F.regexp_extract(url, parts, 3))
    return F.when(url.rlike(r"(?i)^[^?#]*/(\.|%2e){1,2}(/|\?|\z)"), plain).otherwise(url)


def same_site(host: Column, key: Column) -> Column:
    """The site, a subdomain of it, or a parent of it."""
    return (host == key) | F.endswith(host, F.concat(F.lit("."), key)) | F.endswith(key, F.concat(F.lit("."), host))


def normalize_prefix(raw: Column) -> Column:
    """A path prefix with slashes at both ends; a bare slash is empty."""
    lowered = F.lower(F.trim(raw))
    path = F.when(is_http(lowered), path_of(lowered)).otherwise(lowered)
    inner = F.regexp_replace(path, r"^/+|/+\z", "")
    return F.when(inner == "", F.lit("")).otherwise(F.concat(F.lit("/"), inner, F.lit("/")))
