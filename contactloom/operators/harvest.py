"""Inboxes of sites from their pages: home, then contact pages, then classification."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import addresses, markup
from ..sources.shared import keep
from .crawl import contact_pages


def harvest(sites: DataFrame, fetch: Callable[[DataFrame], DataFrame], kind: str = "classify", contact_limit: int = 2) -> DataFrame:
    """(domain, company, website, own, other, sources, pages, error), one row for each site.

    ``sites`` (key, company, original, origin); ``fetch`` adds html and error to a table of urls.
    ``kind``: "classify" for the site's own inboxes and role inboxes at free hosts, "tier" for own and
    related ones.  A contact page that fails is passed over; a home page that fails is the site's error.
    The first page with an address is its source.  At most 1 + ``contact_limit`` pages a site are read.
    """
    home = keep(fetch(sites.select(F.col("original").alias("url")).distinct()).select(F.col("url").alias("original"), "html", "error"), "home-pages")
    first = sites.join(home, "original", "left").withColumn("error", F.when(F.col("html").isNull(), F.coalesce("error", F.lit("no page"))))
    next_ = F.when(F.col("error").isNull(), contact_pages(markup.extract_links(F.col("html"), F.col("original"), 1000), F.col("origin"), contact_limit))
    visits = first.select("key", F.posexplode(next_).alias("_at", "url"))
    more = fetch(visits.select("url").distinct()).where("html is not null").select("url", "html")
    pages = first.where("error is null").select("key", F.lit(-1).alias("_at"), F.col("original").alias("url"), "html").unionByName(visits.join(more, "url").select("key", "_at", "url", "html"))
    # A site has at most 1 + contact_limit pages, so its list is bounded.
    read = pages.select("key", F.struct("_at", "url", addresses.extract_addresses(F.col("html")).alias("emails")).alias("p")).groupBy("key").agg(F.array_sort(F.collect_list("p")).alias("_pages"))
    told = first.drop("html").join(read, "key", "left").withColumn("_pages", F.coalesce("_pages", F.array().cast("array<struct<_at:int,url:string,emails:array<string>>>")))
    emails = F.array_distinct(F.flatten(F.transform("_pages", lambda p: p["emails"])))
    places = F.flatten(F.transform("_pages", lambda p: F.transform(p["emails"], lambda e: F.struct(e.alias("key"), p["url"].alias("value")))))
    source = lambda e: F.struct(e.alias("key"), F.get(F.filter("_places", lambda x: x["key"] == e), F.lit(0))["value"].alias("value"))
    told = told.select("*", emails.alias("_emails"), places.alias("_places"))
    sorted_ = addresses.classify(F.col("_emails"), F.col("key")) if kind == "classify" else addresses.tier(F.col("_emails"), F.col("key"))
    first_name, second_name = ("business", "other") if kind == "classify" else ("own", "related")
    return told.withColumn("_c", sorted_).select(
        F.col("key").alias("domain"), "company", F.col("original").alias("website"), F.col(f"_c.{first_name}").alias("own"), F.col(f"_c.{second_name}").alias("other"),
        F.map_from_entries(F.transform("_emails", source)).alias("sources"), F.size("_pages").alias("pages"), "error")
