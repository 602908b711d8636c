"""Names to address parts: tokens, display names, keys, patterns, templates, candidates."""

from __future__ import annotations

import re
import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let

# Honorifics, and local-part patterns in rank order.
HONORIFICS = ("dr", "mr", "mrs", "ms", "miss", "mx", "prof", "professor", "sir", "madam", "rev", "hon")
PATTERNS = (
    "first.last", "firstlast", "first", "filast", "fi.last", "first.li", "firstli", "last.first", "lastfirst",
    "last", "last.fi", "lastfi", "fi.li", "fili", "li.fi", "lifi", "lifirst", "li.first",
)
# White space beyond ASCII, by code point.
WIDE_SPACE = "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
SPACE = rf"[\s{WIDE_SPACE}]+"
PART = re.compile("first|last|fi|li")


@cache
def _folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters whose compatibility decomposition is one ASCII letter, those letters, and Latin ligatures."""
    one, to, more = [], [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        letters = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if c.isascii() and c.isalpha())
        if len(letters) == 1:
            one.append(chr(code))
            to.append(letters)
        elif letters and (code < 0x250 or 0xFB00 <= code <= 0xFB06):
            more.append((chr(code), letters))
    return "".join(one), "".join(to), tuple(more)


def fold(name: Column) -> Column:
    """ASCII letters of a name's compatibility decomposition; other characters stay for later steps to drop.

    Only texts beyond ASCII are translated, and ligatures looked for only where there are any.
    """
    one, to, more = _folds()
    ligatures = "[" + "".join(c for c, _ in more) + "]"
    spelt = lambda plain: F.when(plain.rlike(ligatures), reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), more, plain)).otherwise(plain)
    return F.when(name.rlike(r"[^\x00-\x7F]"), let(F.translate(name, one, to), spelt)).otherwise(name)


def name_tokens(name: Column, ascii_only: bool = False) -> Column:
    """Lower-case a-z tokens in order, honorifics and empty ones dropped; null gives no tokens.

    ``ascii_only`` leaves out the accent table where a column is known not to need it.
    """
    given = F.coalesce(name, F.lit(""))
    letters = F.regexp_replace(F.lower(given if ascii_only else fold(given)), rf"[^a-z\s{WIDE_SPACE}]+", "")
    return F.filter(F.split(letters, SPACE), lambda t: (t != "") & ~t.isin(*HONORIFICS))


def first_last(tokens: Column) -> Column:
    """(first, last) of two tokens or more, else null."""
    return F.when(F.size(tokens) >= 2, F.struct(F.element_at(tokens, 1).alias("first"), F.element_at(tokens, -1).alias("last")))


def display_name(name: Column) -> Column:
    """(first, last) for people to read: case and particles stay, honorifics go, last is all that remains."""
    words = F.filter(F.split(F.coalesce(name, F.lit("")), SPACE), lambda t: (t != "") & ~F.regexp_replace(F.lower(t), "[^a-z]", "").isin(*HONORIFICS))
    return F.struct(F.coalesce(F.get(words, F.lit(0)), F.lit("")).alias("first"), F.array_join(F.filter(words, lambda _, i: i > 0), " ").alias("last"))


def person_key(name: Column) -> Column:
    """Merge key for extraction: punctuation is deleted."""
    kept = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}\s" + WIDE_SPACE + "]", "")
    return trimmed(F.regexp_replace(kept, SPACE, " "))


def master_key(domain: Column, name: Column) -> Column:
    """Row key of the master: the domain, then the name with punctuation runs as a space."""
    return F.concat(domain, F.lit("::"), trimmed(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " ")))


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}|{SPACE}\z", "")


def local_part(pattern: str, first: Column, last: Column) -> Column:
    """The local part that a pattern, a formula over first, last, fi and li, makes of a name."""
    if not re.fullmatch(r"(?:first|last|fi|li)(?:\.?(?:first|last|fi|li))*", pattern):
        raise ValueError(f"{pattern!r} is not a formula over first, last, fi and li")
    value = {"first": first, "last": last, "fi": F.substring(first, 1, 1), "li": F.substring(last, 1, 1)}
    pieces = [value[p] if p in value else F.lit(p) for p in re.findall(r"first|last|fi|li|\.", pattern)]
    return F.concat(*pieces)


def local_parts(first: Column, last: Column, limit: int = len(PATTERNS)) -> Column:
    """Array of the distinct local parts that the patterns make, in rank order; null where a part is missing."""
    return F.when(first.isNotNull() & last.isNotNull(), F.slice(F.array_distinct(F.array(*[local_part(p, first, last) for p in PATTERNS])), 1, limit))


def candidates(first: Column, last: Column, limit: int = len(PATTERNS)) -> Column:
    """Array of (local, pattern) in rank order; of patterns that agree on a local part the first stays."""
    made, patterns = F.array(*[local_part(p, first, last) for p in PATTERNS]), F.array(*map(F.lit, PATTERNS))
    pair = lambda every: F.transform(F.slice(F.array_distinct(every), 1, limit), lambda x: F.struct(x.alias("local"), F.element_at(patterns, F.array_position(every, x).cast("int")).alias("pattern")))
    return F.when(first.isNotNull() & last.isNotNull(), let(made, pair))


def template_of(pattern: Column) -> Column:
    """A canonical pattern as a template: its parts in braces."""
    return F.regexp_replace(pattern, "first|last|fi|li", "{$0}")


def is_template(template: Column) -> Column:
    """At most 60 characters of placeholders and short literal runs, one placeholder at least."""
    shape = template.rlike(r"^(?:\{(?:first|last|fi|li)\}|[a-z0-9._-]{1,20})+\z") & template.rlike(r"\{(?:first|last|fi|li)\}")
    return F.coalesce((F.length(template) <= 60) & shape, F.lit(False))


def fill_template(template: Column, tokens: Column, domain: Column) -> Column:
    """The address a template gives for name tokens; null if a part it needs is missing."""
    first, last = F.get(tokens, F.lit(0)), F.when(F.size(tokens) >= 2, F.element_at(tokens, -1))
    needs_last = template.contains("{last}") | template.contains("{li}")
    local = template
    for mark, value in (("{first}", first), ("{last}", F.coalesce(last, F.lit(""))), ("{fi}", F.substring(first, 1, 1)), ("{li}", F.coalesce(F.substring(last, 1, 1), F.lit("")))):
        local = F.replace(local, F.lit(mark), value)
    usable = is_template(template) & (F.coalesce(domain, F.lit("")) != "") & (F.size(tokens) > 0) & (~needs_last | last.isNotNull())
    return F.when(usable, F.concat(local, F.lit("@"), domain))


def build_email(pattern: Column, tokens: Column, domain: Column) -> Column:
    """Address from a template, or from a canonical pattern by its template; null for anything else."""
    template = F.when(pattern.contains("{"), pattern).when(pattern.isin(*PATTERNS), template_of(pattern))
    return fill_template(template, tokens, domain)
