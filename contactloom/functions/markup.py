"""Markup and text: entities, plain text, links, data URLs, load-more controls, chunks, sniffs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls
from .let import let
from .names import SPACE, trimmed

# References that are decoded, in this order.
ENTITIES = (("(?i)&nbsp;", " "), ("(?i)&amp;", "&"), ("(?i)&quot;", '"'), ("(?i)&#0?39;|&apos;", "'"), ("(?i)&lt;", "<"), ("(?i)&gt;", ">"))
ASSET_PATH = r"(?i)\.(?:css|js|json|xml|pdf|jpe?g|png|gif|webp|svg|ico|woff2?|zip|mp4)\z"
MARKUP = r"(?i)<(?:!doctype|html|head|body|div|main|section)\b"
# Patterns of visible text, links, data addresses and controls.
SILENT = ("script", "style", "noscript")
COMMENT, BREAK, TAG = r"(?s)<!--.*?-->", r"(?i)<(?:br|hr)[^>]*>|</(?:p|div|li|tr|h[1-6]|section|article|header|footer)>", r"<[^>]+>"
ANCHOR = r"(?is)<a\b[^>]*href=[\"'][^\"'#]+[\"'][^>]*>.*?</a>"
DATA_URLS = (r"(?i)(?:src|href)=[\"']([^\"']+\.m?js(?:\?[^\"']*)?)[\"']", r"(?i)[\"'`]((?:https?://[^\"'`\s]+|/[^\"'`\s]+)\.(?:json|csv)(?:\?[^\"'`\s]*)?)[\"'`]", r"(?i)[\"'`](/(?:api|data)/[^\"'`\s]{2,100})[\"'`]")
CONTROL = r"(?is)<(button|a|div|span)\b[^>]*>.{0,160}?</\1>"
LOAD_MORE = r"(?i)(?<![A-Za-z0-9_])(?:(?:load|show|view|see)\s+(?:more|all)|more\s+(?:results|doctors|people|team))(?![A-Za-z0-9_])"


def _character(code: Column) -> Column:
    """The character of a decimal code point, by its UTF-8 bytes."""
    n = code.cast("int")
    tail = lambda shift: F.shiftright(n, shift).bitwiseAND(63).bitwiseOR(128)
    byte = lambda b: F.lpad(F.hex(b), 2, "0")
    hexes = (
        F.when(n < 0x80, byte(n))
        .when(n < 0x800, F.concat(byte(F.shiftright(n, 6).bitwiseOR(0xC0)), byte(tail(0))))
        .when(n < 0x10000, F.concat(byte(F.shiftright(n, 12).bitwiseOR(0xE0)), byte(tail(6)), byte(tail(0))))
        .otherwise(F.concat(byte(F.shiftright(n, 18).bitwiseOR(0xF0)), byte(tail(12)), byte(tail(6)), byte(tail(0))))
    )
    return F.decode(F.unhex(hexes), "UTF-8")


def decode_entities(text: Column) -> Column:
    """The six named references and decimal ones, each in its turn; others stay as they are.  A text without an ampersand is left alone."""
    return F.when(F.contains(text, F.lit("&")), let(text, _decoded)).otherwise(text)


def _decoded(text: Column) -> Column:
    for pattern, to in ENTITIES:
        text = F.regexp_replace(text, pattern, to)
    return let(text, _numbered)


def _numbered(text: Column) -> Column:
    parts = F.split(text, r"&#(?=[0-9]{1,7};)")
    decoded = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(_character(F.regexp_extract(p, r"^([0-9]+);", 1)), F.regexp_replace(p, r"^[0-9]+;", ""))))
    return F.when(text.rlike(r"&#[0-9]{1,7};"), F.array_join(decoded, "")).otherwise(text)


def html_to_text(source: Column) -> Column:
    """Visible text: code and comments gone, ends of blocks as line feeds, other tags as spaces, blanks squeezed."""
    for element in SILENT:
        source = F.regexp_replace(source, rf"(?is)<{element}.*?</{element}>", " ")
    source = F.regexp_replace(F.regexp_replace(source, COMMENT, " "), BREAK, "\n")
    text = decode_entities(F.regexp_replace(source, TAG, " "))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r" ?\n ?", "\n")
    return trimmed(F.regexp_replace(text, r"\n{2,}", "\n"))


def anchor_text(markup: Column) -> Column:
    return F.substring(trimmed(F.regexp_replace(decode_entities(F.regexp_replace(markup, r"<[^>]+>", " ")), SPACE, " ")), 1, 80)


def extract_links(source: Column, page_url: Column, cap: int = 150) -> Column:
    """Array of (url, text): links to the page's host and its subdomains, the first of each host, path and query."""
    anchors = F.regexp_extract_all(source, F.lit(ANCHOR), F.lit(0))
    site = urls.site_key(page_url)

    def link(a: Column) -> Column:
        url = urls.resolve(F.regexp_extract(a, r"(?is)^<a\b[^>]*href=[\"']([^\"'#]+)[\"']", 1), page_url)
        return F.struct(url.alias("url"), anchor_text(F.regexp_extract(a, r"(?is)^<a\b[^>]*>(.*?)</a>\z", 1)).alias("text"))

    def inside(l: Column) -> Column:
        host = urls.site_key(l["url"])
        return l["url"].isNotNull() & ((host == site) | F.endswith(host, F.concat(F.lit("."), site))) & ~urls.path_of(l["url"]).rlike(ASSET_PATH)

    kept = F.filter(F.transform(anchors, link), inside)
    return F.slice(first_of_each(kept, lambda l: urls.dedupe_key(l["url"])), 1, cap)


def first_of_each(items: Column, key) -> Column:
    """The first item of every key, in order; sorts by key, so a page with very many items takes no square of them."""
    def within(a: Column) -> Column:
        return let(F.array_sort(F.transform(a, lambda x, i: F.struct(key(x).alias("k"), i.alias("i")))), lambda order: firsts(a, order))

    def firsts(a: Column, order: Column) -> Column:
        new = F.filter(order, lambda o, i: (i == 0) | (o["k"] != F.get(order, i - 1)["k"]))
        return F.transform(F.array_sort(F.transform(new, lambda o: o["i"])), lambda i: F.get(a, i))

    return let(items, within)


def data_urls(source: Column, page_url: Column, cap: int = 20) -> Column:
    """Same-site scripts, quoted .json and .csv paths, and /api/ or /data/ paths, in that order."""
    found = F.concat(*[
        F.regexp_extract_all(source, F.lit(p), F.lit(1))
        for p in DATA_URLS
    ])
    site = urls.site_key(page_url)
    full = F.transform(found, lambda u: urls.resolve(u, page_url))
    inside = F.filter(full, lambda u: u.isNotNull() & ((urls.site_key(u) == site) | F.endswith(urls.site_key(u), F.concat(F.lit("."), site))))
    return F.slice(F.array_distinct(inside), 1, cap)


def load_more(source: Column, cap: int = 5) -> Column:
    """Array of (selector, text) of controls that promise more entries, the first of each selector."""
    controls = F.regexp_extract_all(source, F.lit(CONTROL), F.lit(0))

    def control(c: Column) -> Column:
        tag, attributes = F.lower(F.regexp_extract(c, r"^<([A-Za-z]+)", 1)), F.regexp_extract(c, r"(?is)^<[a-z]+\b([^>]*)>", 1)
        text = trimmed(F.regexp_replace(decode_entities(F.regexp_replace(F.regexp_extract(c, r"(?is)^<[^>]*>(.*)</[a-z]+>\z", 1), r"<[^>]+>", " ")), SPACE, " "))
        own_id = F.regexp_extract(attributes, r"(?i)\bid=[\"']([^\"']+)[\"']", 1)
        classes = F.filter(F.split(F.regexp_extract(attributes, r"(?i)\bclass=[\"']([^\"']+)[\"']", 1), SPACE), lambda k: k.rlike(r"^[A-Za-z][A-Za-z0-9_-]*\z"))
        selector = F.when(own_id.rlike(r"^[A-Za-z][A-Za-z0-9_-]*\z"), F.concat(F.lit("#"), own_id)).when(F.size(classes) > 0, F.concat(tag, F.lit("."), F.get(classes, F.lit(0))))
        return F.struct(selector.alias("selector"), text.alias("text"))

    kept = F.filter(F.transform(controls, control), lambda c: c["selector"].isNotNull() & (F.length(c["text"]) <= 60) & c["text"].rlike(LOAD_MORE))
    return F.slice(first_of_each(kept, lambda c: c["selector"]), 1, cap)


def is_json(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[\[{]") & F.try_parse_json(text).isNotNull(), F.lit(False))


def is_csv(text: Column) -> Column:
    """Three lines or more, the first two with two commas or tabs each."""
    lines = F.split(text, "\n")
    marks = lambda i: F.length(F.get(lines, F.lit(i))) - F.length(F.translate(F.get(lines, F.lit(i)), ",\t", ""))
    return F.coalesce((F.size(lines) >= 3) & (marks(0) >= 2) & (marks(1) >= 2), F.lit(False))


def is_markup(text: Column) -> Column:
    return F.coalesce(F.substring(text, 1, 4000).rlike(MARKUP), F.lit(False))


def chunks(text: Column, size: int = 50_000, most: int | None = 24) -> Column:
    """Chunks of whole lines of about ``size`` characters, at most ``most`` (None for all); those of CSV repeat its header."""
    def packed(lines: Column, header: Column) -> Column:
        start = F.length(header)
        empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"), start.cast("int").alias("size"), F.lit(0).alias("n"))

        def add(s: Column, line: Column) -> Column:
            full = (s["size"] + F.length(line) > size) & (s["n"] > 0)
            return F.struct(
                F.when(full, F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]).alias("done"),
                F.when(full | (s["n"] == 0), line).otherwise(F.concat(s["now"], F.lit("\n"), line)).alias("now"),
                (F.when(full, start).otherwise(s["size"]) + F.length(line) + 1).cast("int").alias("size"),
                F.when(full, 1).otherwise(s["n"] + 1).alias("n"))

        bodies = F.aggregate(lines, empty, add, lambda s: F.when(s["n"] > 0, F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]))
        whole = F.transform(bodies, lambda b: F.when(header != "", F.concat(header, F.lit("\n"), b)).otherwise(b))
        return whole if most is None else F.slice(whole, 1, most)

    lines = F.split(text, "\n")
    with_header = F.when(is_csv(text), packed(F.slice(lines, 2, 1 << 30), F.get(lines, F.lit(0)))).otherwise(packed(lines, F.lit("")))
    return F.when(F.length(text) <= size, F.array(text)).otherwise(with_header)
