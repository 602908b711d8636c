"""Addresses: extraction, de-obfuscation, classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .markup import decode_entities

# The address shapes by which mailboxes are told apart.
ADDRESS = r"[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
ROLE = r"^(?:info|reception\d*|admin|contact|enquir(?:y|ies)|office|hello|mail|practice|booking(?:s)?|appointment(?:s)?|referral(?:s)?|account(?:s)?|hr|careers?|frontdesk|desk|clinic|rooms|secretary|pa|welcome|team|support|general)@"
ROLE_LOCAL = r"^(?:info|reception|admin|contact|enquir|office|hello|mail|practice|booking|appointment|referral|account|hr|careers?|frontdesk|desk|clinic|rooms|secretary|welcome|team|support|general|no-?reply|feedback|sales|marketing|patients?|appts|webmaster|manager|education|doctor|nurse)"
VENDOR = r"@(?:.*\.)?(?:myhealth1st|healthengine|hotdoc|automedsystems|cliniko|marketingsweet|wixpress|sentry|squarespace|godaddy|wordpress|shopify|mailchimp|hubspot|constantcontact|example|schema|w3|sentry-next|mhtml|blink)(?:[^a-zA-Z0-9_]|\z)"
PLACEHOLDER = r"^(?:user|test|name|email|yourname|firstname|your)@|@(?:domain|email|yourdomain|company|website)\.(?:com|net)\z"
FREEMAIL = r"@(?:gmail|outlook|hotmail|yahoo|bigpond|live|icloud|me|optusnet|iinet|internode)\.[a-z.]+\z"
OPAQUE = r"^[0-9a-f]{16,}@"
ASSET = r"\.(?:png|jpe?g|gif|webp|svg|css|js)\z"
THEME_HOST = r"@(?:example|sentry|schema|w3|domain|yourdomain|email|yourcompany|company|website|test)\.(?:com|net|org)"
THEME_LOCAL = r"^(?:your|youremail|name|firstname|lastname|email|username|user)@"


def _is(address: Column, pattern: str) -> Column:
    return address.rlike("(?i)" + pattern)


def is_role(address: Column) -> Column:
    return _is(address, ROLE)


def is_junk(address: Column) -> Column:
    """Vendors, placeholders and opaque local parts."""
    return _is(address, VENDOR) | _is(address, PLACEHOLDER) | address.rlike(OPAQUE)


def is_published(address: Column) -> Column:
    """False for file names, theme hosts, placeholder and opaque local parts that only look like addresses."""
    return ~(address.rlike(ASSET) | address.rlike(THEME_HOST) | address.rlike(THEME_LOCAL) | address.rlike(OPAQUE))


def host_of(address: Column) -> Column:
    return F.get(F.split(address, "@"), F.lit(1))


def decode_hidden(blob: Column) -> Column:
    """An address hidden as hex, each byte combined with the first; null if it is none."""
    byte = lambda at: F.conv(F.substring(blob, at, 2), 16, 10).cast("int")
    shape = blob.rlike(r"^[0-9a-fA-F]{6,}\z") & (F.length(blob) % 2 == 0)
    key = byte(F.lit(1))
    text = F.array_join(F.transform(F.sequence(F.lit(3), F.greatest(F.length(blob) - 1, F.lit(3)), F.lit(2)), lambda at: F.char(byte(at).bitwiseXOR(key))), "")
    decoded = F.when(shape, text)
    return F.when(decoded.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+\z"), decoded)


def encode_hidden(address: Column, key: int = 0x6B) -> Column:
    """The inverse of ``decode_hidden`` for ASCII addresses."""
    hexes = F.transform(F.sequence(F.lit(1), F.length(address)), lambda at: F.lpad(F.lower(F.hex(F.ascii(F.substring(address, at, F.lit(1))).bitwiseXOR(key))), 2, "0"))
    return F.concat(F.lit(f"{key:02x}"), F.array_join(hexes, ""))


def extract_addresses(source: Column) -> Column:
    """Lower-case addresses in order: mailto links, plain text, then the two hidden forms; junk left out."""
    all_of = lambda pattern, group=0: F.regexp_extract_all(source, F.lit("(?i)" + pattern), F.lit(group))
    mailto = F.transform(all_of(r"mailto:([^\"'?\s<>]+)", 1), lambda m: F.regexp_extract(F.regexp_replace(decode_entities(m), "(?i)%20", " "), "(?i)" + ADDRESS, 0))
    hidden = [F.transform(all_of(p, 1), decode_hidden) for p in (r"data-cfemail=[\"']([0-9a-f]+)[\"']", "/cdn-cgi/l/email-protection#([0-9a-f]+)")]
    found = F.transform(F.concat(mailto, all_of(ADDRESS), *hidden), F.lower)
    return F.filter(F.array_distinct(found), lambda e: e.isNotNull() & (e != "") & is_published(e))


def role_first(addresses: Column) -> Column:
    """Role inboxes before others; the order is kept within both."""
    return F.concat(F.filter(addresses, is_role), F.filter(addresses, lambda a: ~is_role(a)))


def classify(addresses: Column, site: Column, dot_boundary: bool = True) -> Column:
    """(business, other): addresses on the site's domain, role first, and role inboxes at free mail hosts.

    Without ``dot_boundary`` the looser test holds that lets a host pass as a mere suffix.
    """
    bare = F.regexp_replace(site, r"^www\.", "")
    root = F.array_join(F.slice(F.reverse(F.slice(F.reverse(F.split(bare, r"\.")), 1, 3)), 1, 3), ".")

    def own(e: Column) -> Column:
        at = F.coalesce(host_of(e), F.lit(""))
        if dot_boundary:
            return (at == bare) | F.endswith(at, F.concat(F.lit("."), bare)) | F.endswith(bare, F.concat(F.lit("."), at)) | (at == root) | F.endswith(at, F.concat(F.lit("."), root))
        return (at == bare) | F.endswith(at, F.concat(F.lit("."), bare)) | F.endswith(bare, at) | F.endswith(at, root)

    usable = F.filter(F.array_distinct(F.transform(addresses, F.lower)), lambda e: ~is_junk(e))
    business = role_first(F.filter(usable, own))
    other = F.filter(usable, lambda e: ~own(e) & is_role(e) & _is(e, FREEMAIL))
    return F.struct(business.alias("business"), other.alias("other"))


def stem(host: Column) -> Column:
    return F.get(F.split(F.regexp_replace(host, r"^www\.", ""), r"\."), F.lit(0))


def same_stem(a: Column, b: Column, stem_min: int = 6) -> Column:
    """Equal first labels, or both of ``stem_min`` characters and one the start of the other."""
    return (a == b) | (F.length(a) >= stem_min) & (F.length(b) >= stem_min) & (F.startswith(a, b) | F.startswith(b, a))


def tier(addresses: Column, site: Column, stem_min: int = 6) -> Column:
    """(own, related): addresses of the site's domain, subdomains and brand, and the others; role first in both."""
    bare = F.regexp_replace(site, r"^www\.", "")
    usable = F.filter(F.array_distinct(F.transform(addresses, lambda e: F.trim(F.lower(e)))), lambda e: e.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+\z") & ~is_junk(e))
    own = lambda e: (host_of(e) == bare) | F.endswith(host_of(e), F.concat(F.lit("."), bare)) | same_stem(stem(host_of(e)), stem(bare), stem_min)
    return F.struct(role_first(F.filter(usable, own)).alias("own"), role_first(F.filter(usable, lambda e: ~own(e))).alias("related"))


def evidence(addresses: Column, mail_domain: Column, site: Column) -> Column:
    """(own, personal): addresses that can prove a format; personal leaves role words out."""
    ours = F.filter(F.array_distinct(F.transform(addresses, F.lower)), lambda e: (host_of(e) == mail_domain) | (host_of(e) == site) | (stem(host_of(e)) == stem(site)))
    return F.struct(ours.alias("own"), F.filter(ours, lambda e: ~_is(e, ROLE_LOCAL)).alias("personal"))
