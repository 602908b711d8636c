"""Whole stages of a run, put together from their parts.

Services are functions over tables: ``providers.asking`` and its like for live ones, ``providers.recorded`` for recorded ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..sources import files
from ..sources.providers import Provider, Service, map_sites
from ..sources.shared import keep
from . import crawl, harvest, inboxes, ledger
from .models import extract_people, organise_people, rank_pages

RELATED = "domain string, company string, website string, own_emails array<string>, related_emails array<string>, sources map<string,string>, pages int, error string"
NO_URLS = "array<string>"


def recover_related(companies: DataFrame, master: DataFrame, static: DataFrame, path: str, fetch: Service, website: str = "Website", name: str = "Name", order: str = "_pos", only: tuple[str, ...] = (), sample: int | None = None) -> DataFrame:
    """The master after a second harvest of the sites that are still without an address.

    Targets are sites of the company list whose record in the ``static`` ledger didn't fail and holds no address; those that
    the ledger at ``path`` has already are passed over, failures are tried again.  ``only`` keeps sites with one of these
    fragments in key or company, ``sample`` every n-th of them.  What is found goes to the ledger first; the
    master is then folded from the whole ledger, as ``refold`` does without any fetch.
    """
    spark = master.sparkSession
    sites = crawl.only_fragments(crawl.targets(companies, website, name, order), list(only), "key", "company")
    sites = sites.join(inboxes.still_empty(static, master).select(F.col("domain").alias("key")), "key", "left_semi")
    done = files.read_ledger(spark, path, RELATED).select(F.col("domain").alias("key"), "error")
    todo = ledger.pending(sites, done, "key", F.col("error").isNotNull())
    todo = ledger.stride_sample(todo, "pos", sample) if sample else todo
    found = harvest.harvest(todo.select("key", "company", "original", "origin"), fetch, kind="tier")
    files.append_ledger(found.select("domain", "company", "website", F.col("own").alias("own_emails"), F.col("other").alias("related_emails"), "sources", "pages", "error"), path)
    return refold(master, files.read_ledger(spark, path, RELATED))


def refold(master: DataFrame, records: DataFrame) -> DataFrame:
    """The master with what the related ledger holds: own addresses where there is no business_email, related ones where there is no related_email.

    The last record of a domain that didn't fail counts; nothing that is there is replaced.
    """
    last = ledger.latest_per_key(records.select("domain", "own_emails", "related_emails", "_seq", "error"), "domain", "_seq", F.col("error").isNotNull())
    given = last.select("domain", F.when(F.size("own_emails") > 0, F.col("own_emails")).alias("_own"), F.when(F.size("related_emails") > 0, F.array_join("related_emails", "; ")).alias("_related"))
    joined = master.join(given, "domain", "left")
    old = lambda c: F.col(c) if c in master.columns else F.lit(None).cast("string")
    empty = lambda c: F.coalesce(old(c), F.lit("")) == ""
    fresh = empty("business_email") & F.col("_own").isNotNull()
    values = {
        "business_email": F.when(fresh, F.get("_own", F.lit(0))).otherwise(old("business_email")), "all_business_emails": F.when(fresh, F.array_join("_own", "; ")).otherwise(old("all_business_emails")),
        "related_email": F.when(empty("related_email") & F.col("_related").isNotNull(), F.col("_related")).otherwise(old("related_email"))}
    return joined.select(*[c for c in master.columns if c not in values], *[v.alias(c) for c, v in values.items()])


def team_pages(sites: DataFrame, mapping: Service, model: Provider, cap: int = 800, top: int = 15, min_score: int = 85, most: int = 5) -> DataFrame:
    """(key, company, original, pages, candidates, profile_pages, mapped, listed, error): from a site to its pages that may name people.

    ``sites`` (key, company, original): a service maps each site, its usable pages are numbered, a model ranks them,
    and the confident ones that are no profiles make the shortlist.  A site that can't be mapped has its error.
    """
    mapped = keep(map_sites(sites, mapping), "site-maps")
    links = mapped.select("key", F.posexplode("links").alias("pos", "l")).select("key", "pos", "l.url", "l.title")
    known = sites.join(mapped.where("error is null").select("key"), "key", "left_semi")
    entries = crawl.candidate_links(known.select("key", urls.without_fragment(F.col("original")).alias("original")), links, cap)
    ranked, profiles = rank_pages(entries, model, top)
    choice = F.struct("rank", F.struct("url", "title", "score", "reason", "kind").alias("c"))
    chosen = ranked.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(choice)), lambda x: x["c"]).alias("candidates"))  # at most ``top``
    below = profiles.groupBy("key").agg(F.array_sort(F.collect_set("url")).alias("profile_pages"))  # at most ``cap``
    counts = entries.groupBy("key").agg(F.count("*").cast("int").alias("listed"))
    whole = sites.select("key", "company", "original").join(mapped.select("key", F.size("links").alias("mapped"), "error"), "key", "left").join(chosen, "key", "left").join(below, "key", "left").join(counts, "key", "left")
    candidates = F.coalesce("candidates", F.array().cast(f"array<{crawl.CANDIDATE}>"))
    return whole.withColumn("candidates", candidates).select(
        "key", "company", "original", crawl.shortlist(F.col("candidates"), min_score, most).alias("pages"), "candidates", F.coalesce("profile_pages", F.array().cast(NO_URLS)).alias("profile_pages"), "mapped", F.coalesce("listed", F.lit(0)).alias("listed"), "error")


def site_people(sites: DataFrame, read: Service, model: Provider, organiser: Provider | None = None, sweep: int = 150) -> tuple[DataFrame, DataFrame]:
    """(people, outcomes): from sites with their shortlists to people, what was read before a failure or a time limit included.

    ``sites`` (key, company, original, pages, profile_pages, site_down): a host that was down before is not asked; without a
    shortlist the home page is read.  ``read`` adds html and error to (key, url, pos) rows; ``providers.ask_within``
    gives each site a time limit, after which its pages are errors and the people found so far stay.  Where far more profile
    pages are known than people were found, up to ``sweep`` of them are read too.  ``outcomes`` (domain, company, website, people,
    visits, failed_pages, error) has a row for each site.
    """
    up = sites.where(~F.coalesce("site_down", F.lit(False)))
    first = F.when(F.size("pages") > 0, F.transform("pages", lambda p: p["url"])).otherwise(F.array("original"))
    visits = up.select("key", F.posexplode(first).alias("pos", "url"))
    seen = keep(read(visits).select("key", "url", "pos", "html", "error"), "pages")
    said = keep(extract_people(seen.where("error is null").select(F.col("key").alias("domain"), "url", "html", "pos"), model), "people")
    counts = said.groupBy("domain").agg(F.count("*").alias("n"))
    left = up.select(F.col("key").alias("domain"), first.alias("visited"), "profile_pages").join(counts, "domain", "left")
    more = left.select(F.col("domain").alias("key"), F.posexplode(crawl.to_sweep(F.col("profile_pages"), F.col("visited"), F.coalesce("n", F.lit(0)), sweep)).alias("at", "url"))
    swept = keep(read(more.select("key", "url", (F.col("at") + 1000).alias("pos"))).select("key", "url", "pos", "html", "error"), "pages")
    later = extract_people(swept.where("error is null").select(F.col("key").alias("domain"), "url", "html", "pos"), model)
    people = keep(organise_people(said.unionByName(later), organiser), "people")
    tried = seen.unionByName(swept).groupBy("key").agg(F.count_if(F.col("error").isNull()).alias("visits"), F.count_if(F.col("error").isNotNull()).alias("failed_pages"), F.min_by("error", "pos").alias("_error"))
    found = people.groupBy("domain").agg(F.count("*").alias("people"))
    none = F.lit(0).cast("long")
    outcome = sites.join(tried, "key", "left").join(found.withColumnRenamed("domain", "key"), "key", "left")
    error = F.when(F.coalesce("site_down", F.lit(False)), "site unreachable").when(F.coalesce("visits", none) == 0, F.coalesce("_error", F.lit("nothing was read")))
    return people, outcome.select(F.col("key").alias("domain"), "company", F.col("original").alias("website"), *[F.coalesce(c, none).alias(c) for c in ("people", "visits", "failed_pages")], error.alias("error"))
