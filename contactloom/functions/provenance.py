"""What an address rests on, and text that must not carry credentials."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let

# Wording of the deliverables.
READY, VERIFY = "Ready to send", "Needs verification"
KEY_SHAPED = r"(?i)(?<![A-Za-z0-9_])(?:sk|fc|xai|gsk)-[A-Za-z0-9_*-]{4,}"
URL_TOKEN = r"(?<=https?://[^\s\"'<>]{0,400}/)[A-Za-z0-9_-]{16,}(?=/|[\s\"'<>]|\z)"


def parse_basis(basis: Column) -> Column:
    """(stem, ai, unverified): the two flags may stand in either order."""
    def peeled(b: Column) -> Column:
        stem = F.substring(b["given"], F.lit(1), F.length(b["given"]) - F.length(b["flags"]))
        return F.struct(stem.alias("stem"), b["flags"].contains("(ai)").alias("ai"), b["flags"].contains("(unverified-domain)").alias("unverified"))

    flags = lambda g: F.regexp_extract(g, r"((?:\(ai\)|\(unverified-domain\))*)\z", 1)
    return let(let(F.trim(F.coalesce(basis, F.lit(""))), lambda g: F.struct(g.alias("given"), flags(g).alias("flags"))), peeled)


def basis_status(basis: Column) -> Column:
    """(status, source, sendable).  Only a published or a found address can be sent; what isn't known never is."""
    return let(F.struct(basis.alias("given"), parse_basis(basis).alias("parsed")), lambda b: _meaning(b["given"], b["parsed"]))


def _meaning(basis: Column, parsed: Column) -> Column:
    stem, ai, unverified = parsed["stem"], parsed["ai"], parsed["unverified"]
    meaning = lambda status, source, ok: F.struct(F.lit(status).alias("status"), source.alias("source"), F.lit(ok).alias("sendable"))
    confidence = F.when(stem == "web-found:", F.lit("low")).otherwise(F.substring(stem, F.lit(11), F.length(stem)))
    return (
        F.when(stem == "known", meaning(READY, F.lit("Published on their website"), True))
        .when(F.startswith(stem, F.lit("web-found:")), meaning(READY, F.concat(F.lit("Found on the web ("), confidence, F.lit(" confidence)")), True))
        .when(F.startswith(stem, F.lit("learned:")), meaning(VERIFY, F.concat(F.lit("Matches this company's email format"), F.when(ai, " (AI-judged)").otherwise(""), F.when(unverified, " — mail domain not confirmed").otherwise("")), False))
        .when(F.startswith(stem, F.lit("default:")), meaning(VERIFY, F.when(unverified, F.lit("Predicted — mail domain not confirmed")).otherwise("Predicted — mail domain confirmed"), False))
        .when(stem == "no-domain", meaning("", F.lit("No mail domain — nothing to send to"), False))
        .when(stem == "no-name", meaning("", F.lit("No usable name — could not predict an address"), False))
        .otherwise(meaning(VERIFY, F.when(F.coalesce(basis, F.lit("")) == "", F.lit("Unknown")).otherwise(basis), False))
    )


def redact(text: Column, secrets: tuple[str, ...] = (), url_tokens: bool = True) -> Column:
    """Given secrets, key-shaped words, then opaque URL path segments, each as ``<redacted>``."""
    for s in secrets:
        text = F.replace(text, F.lit(s), F.lit("<redacted>"))
    text = F.regexp_replace(text, KEY_SHAPED, "<redacted>")
    return F.regexp_replace(text, URL_TOKEN, "<redacted>") if url_tokens else text


def brief(text: Column, most: int = 200, **options) -> Column:
    """One redacted line of at most ``most`` characters."""
    return F.substring(F.trim(F.regexp_replace(redact(text, **options), r"\s+", " ")), 1, most)


def status_of(status: Column, message: Column) -> Column:
    """A structured HTTP status, else the first 4xx or 5xx that stands alone in the message."""
    found = F.regexp_extract(message, r"(?:^|[^0-9A-Za-z_])([45][0-9]{2})(?:[^0-9A-Za-z_]|\z)", 1)
    return F.coalesce(status.cast("int"), F.when(found != "", found.cast("int")))
