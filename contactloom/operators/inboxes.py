"""Company inboxes from ledgers, and their merge into the master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import has_any


def _filled(c):
    return F.when(F.coalesce(c, F.lit("")) != "", c)


def build_inboxes(business: DataFrame, render: DataFrame, related: DataFrame) -> DataFrame:
    """(domain, company, website, business, related, sources) from the three ledgers.

    Records that failed or hold no address are passed over.  The last business record replaces; render
    and related records add what is missing, in order; company and website are the first there are; a
    later source of an address wins.
    """
    usable = lambda df, test: df.where("error is null and domain is not null").where(test)
    kinds = [
        usable(business, "size(business_emails) > 0").select("domain", "company", "website", F.lit(0).alias("kind"), F.col("_seq").alias("seq"), F.col("business_emails").alias("own"), F.array().cast("array<string>").alias("rel"), _first_source("business_emails", "business_email_source_url")),
        usable(render, "size(business_emails) > 0").select("domain", "company", "website", F.lit(1).alias("kind"), F.col("_seq").alias("seq"), F.col("business_emails").alias("own"), F.array().cast("array<string>").alias("rel"), _first_source("business_emails", "business_email_source_url")),
        usable(related, "size(own_emails) + size(related_emails) > 0").select("domain", "company", "website", F.lit(2).alias("kind"), F.col("_seq").alias("seq"), F.col("own_emails").alias("own"), F.col("related_emails").alias("rel"), F.map_entries("sources").alias("src")),
    ]
    at, place = F.struct("kind", "seq"), F.struct("kind", "seq", "i")
    records = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    heads = records.groupBy("domain").agg(
        F.min_by("company", F.when(_filled(F.col("company")).isNotNull(), at)).alias("company"), F.min_by("website", F.when(_filled(F.col("website")).isNotNull(), at)).alias("website"),
        F.max_by("own", F.when(F.col("kind") == 0, at)).alias("base"), F.max_by("rel", F.when(F.col("kind") == 2, at)).alias("related"))
    # A domain may have any number of records; only its distinct addresses, which the result holds anyway, are gathered.
    emails = records.where("kind > 0").select("domain", "kind", "seq", F.posexplode("own").alias("i", "email"))
    added = emails.groupBy("domain", "email").agg(F.min(place).alias("first")).groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("first", "email"))).alias("added"))
    entries = records.select("domain", "kind", "seq", F.posexplode("src").alias("i", "e"))
    pages = entries.groupBy("domain", "e.key").agg(F.max(place).alias("last"), F.max_by("e.value", place).alias("value")).groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("last", "key", "value"))).alias("pages"))
    rows = heads.join(added, "domain", "left").join(pages, "domain", "left")
    none = F.array().cast("array<string>")
    own = F.array_distinct(F.concat(F.coalesce("base", none), F.coalesce(F.transform("added", lambda r: r["email"]), none)))
    sources = F.map_from_entries(F.coalesce(F.transform("pages", lambda r: F.struct(r["key"], r["value"])), F.array().cast("array<struct<key:string,value:string>>")))
    return rows.select("domain", "company", "website", own.alias("business"), F.coalesce("related", none).alias("related"), sources.alias("sources"))


def _first_source(emails: str, url: str):
    entry = F.struct(F.get(emails, F.lit(0)).alias("key"), F.col(url).alias("value"))
    return F.when(_filled(F.col(url)).isNotNull(), F.array(entry)).otherwise(F.array().cast("array<struct<key:string,value:string>>")).alias("src")


def inbox_rows(inboxes: DataFrame) -> DataFrame:
    """The inbox deliverable: the own address, else the first affiliated one; neither, no row."""
    own, other = F.get("business", F.lit(0)), F.get("related", F.lit(0))
    email = F.coalesce(own, other)
    return inboxes.where(email.isNotNull()).select(
        "company", "domain", "website", email.alias("email"), F.array_join("business", "; ").alias("all_business_emails"), F.coalesce(other, F.lit("")).alias("related_email"),
        F.when(own.isNotNull(), "Published on their website").otherwise("Published on an affiliated domain").alias("source"), F.coalesce(F.try_element_at("sources", email), F.lit("")).alias("proof"))


def still_empty(ledger: DataFrame, master: DataFrame) -> DataFrame:
    """Domains with a record that didn't fail and no address: in the master, or where that lacks them in the record itself."""
    clean = ledger.where("error is null and domain is not null").groupBy("domain").agg(F.bool_or(F.size("business_emails") > 0).alias("_own"))
    held = has_any(master, "domain", (F.coalesce("email", F.lit("")) != "") | (F.coalesce("business_email", F.lit("")) != ""), "_held")
    return clean.join(held, "domain", "left").where(~F.coalesce("_held", "_own")).select("domain")


def replace_columns(master: DataFrame, derived: DataFrame, key: str = "domain") -> DataFrame:
    """Master with the derived columns replaced outright; null where the key has none."""
    return master.drop(*[c for c in derived.columns if c != key]).join(derived, key, "left")


def fill_if_empty(master: DataFrame, found: DataFrame, key: str = "domain") -> DataFrame:
    """Master whose empty cells take the found values; what is there stays."""
    fresh = found.select(key, *[F.col(c).alias(f"_new_{c}") for c in found.columns if c != key])
    joined = master.join(fresh, key, "left")
    for c in found.columns:
        if c != key:
            old = F.col(c) if c in master.columns else F.lit(None).cast(found.schema[c].dataType)
            empty = old.isNull() | (old.cast("string") == "")
            joined = joined.withColumn(c, F.when(empty, F.col(f"_new_{c}")).otherwise(old)).drop(f"_new_{c}")
    return joined


def first_source_per_address(found: DataFrame) -> DataFrame:
    """(site, email, source_url): the page on which each address of a site was seen first; ``found`` has pos."""
    return found.select("site", F.lower("email").alias("email"), "url", "pos").groupBy("site", "email").agg(F.min_by("url", F.struct("pos", "url")).alias("source_url"))
