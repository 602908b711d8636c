"""Which pages of a site to read: targets, candidate links, rankings, contact pages, sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.let import with_fields
from .ledger import first_per_key

# What marks a contact page, the paths to guess, and titles of people easily found.
CONTACT_URL, CONTACT_TEXT = r"(?i)contact|reach|get-in-touch|enquir", r"(?i)contact|reach|enquir"
CONTACT_GUESSES = ("contact", "contact-us", "contactus")
SENIOR = r"(?i)dr|prof|surgeon|specialist|director|founder|consultant"
CANDIDATE = "struct<url:string,title:string,score:int,reason:string,kind:string>"


def targets(companies: DataFrame, website: str, name: str, order: str) -> DataFrame:
    """(key, company, original, origin, pos): sites of a company list, the first row of each site.

    Rows without a usable website go; the website stands in for a missing name.
    """
    if website not in companies.columns:
        raise ValueError(f"there is no column {website!r}")
    site = urls.normalize_website(F.col(website))
    named = F.coalesce(F.when(F.trim(F.col(name)) != "", F.trim(F.col(name))), F.col(website)) if name in companies.columns else F.col(website)
    rows = companies.select(site.alias("_s"), named.alias("company"), F.col(order).alias("pos")).where("_s is not null")
    return first_per_key(rows.select("_s.key", "company", "_s.original", "_s.origin", "pos"), "key", "pos")


def only_fragments(df: DataFrame, fragments: list[str], *columns: str) -> DataFrame:
    """Rows that hold one of the fragments in one of the columns, whatever the case; no fragments: all rows."""
    test = F.lit(not fragments)
    for f in fragments:
        for c in columns:
            test = test | F.contains(F.lower(F.col(c)), F.lit(f.lower()))
    return df.where(F.coalesce(test, F.lit(False)))


def candidate_links(sites: DataFrame, links: DataFrame, cap: int = 500) -> DataFrame:
    """(key, entry, url, title): pages that may name people, in link order, at most ``cap`` for a site.

    ``sites`` (key, original), ``links`` (key, url, title, pos).  The site's own address comes first;
    links off the site, files and repeats of host, path and query go.  The cap is taken before the
    shuffle too, so a site with very many links sends no more than that from a task.
    """
    own = sites.select("key", F.col("original").alias("url"), F.lit(None).cast("string").alias("title"), F.lit(-1).cast("long").alias("pos"))
    rows = _inside(own.unionByName(links.select("key", "url", "title", F.col("pos").cast("long").alias("pos"))))
    firsts = rows.groupBy("key", "_k").agg(F.min(F.struct("pos", "url", "title")).alias("f"))
    entry = F.row_number().over(Window.partitionBy("key").orderBy("f.pos", "f.url"))
    return firsts.withColumn("entry", entry).where(F.col("entry") <= cap).select("key", "entry", urls.without_fragment(F.col("f.url")).alias("url"), F.col("f.title").alias("title"))


def _inside(rows: DataFrame) -> DataFrame:
    url = F.col("url")
    usable = urls.is_http(url) & ~urls.path_of(url).rlike(urls.NON_CONTENT) & urls.same_site(urls.site_key(url), F.col("key"))
    return rows.where(usable).withColumn("_k", urls.dedupe_key(url))


def overflow(sites: DataFrame, links: DataFrame, cap: int = 500) -> DataFrame:
    """(key, n_entries, n_dropped) for every site: how many pages the cap keeps and leaves out."""
    rows = _inside(sites.select("key", F.col("original").alias("url")).unionByName(links.select("key", "url")))
    counts = rows.select("key", "_k").distinct().groupBy("key").agg(F.count("*").alias("_n"))
    return sites.select("key").distinct().join(counts, "key", "left").select(
        "key", F.least(F.coalesce("_n", F.lit(0)), F.lit(cap)).cast("long").alias("n_entries"), F.greatest(F.coalesce("_n", F.lit(0)) - cap, F.lit(0)).cast("long").alias("n_dropped"))


def ranked_candidates(entries: DataFrame, answers: DataFrame, top: int = 15) -> DataFrame:
    """(key, rank, url, title, score, reason, kind): a model's choices by index, directories before others before profiles.

    ``answers`` (key, said, index, score, reason, kind), ``said`` the order in which the model gave them.
    Indexes that no entry has go; the first ``top`` that remain are ordered.
    """
    known = answers.join(entries.select("key", (F.col("entry") - 1).alias("index"), "url", "title"), ["key", "index"])
    kept = known.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("said"))).where(F.col("_n") <= top)
    kind = F.when(F.col("kind") == "directory", 0).when(F.col("kind") == "profile", 2).otherwise(1)
    rounded = F.floor(F.col("score") + 0.5).cast("int")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(kind, F.desc("score"), "said"))
    return kept.withColumn("score", rounded).select("key", rank.alias("rank"), "url", "title", "score", "reason", "kind")


def shortlist(candidates: Column, min_score: int = 85, most: int = 5) -> Column:
    """The first ``most`` candidates of at least that score that are no profiles, in their order."""
    return F.slice(F.filter(candidates, lambda c: (c["score"] >= min_score) & (c["kind"] != "profile")), 1, most)


def under_prefixes(pages: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Rows of ``pages`` (key, url) below one of the site's path prefixes and not that page itself.

    ``prefixes`` (key, prefix) are normalised, slashes at both ends; a page's path is cut at each of its slashes, and these
    few folders meet the prefixes in a join by equality, so a site may have any number of either.
    """
    known = prefixes.select("key", urls.normalize_prefix(F.col("prefix")).alias("_folder")).where("_folder != ''").distinct()
    path = F.lower(urls.path_of(F.col("url")))
    bare = F.regexp_replace(path, r"/+\z", "")
    parts = F.split(path, "/")
    cut = F.when(F.size(parts) > 2, F.sequence(F.lit(2), F.size(parts) - 1)).otherwise(F.array().cast("array<int>"))
    # What a page's own path is without its last slashes is the page itself.
    above = F.transform(cut, lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    folders = F.filter(above, lambda f: F.regexp_replace(f, r"/+\z", "") != bare)
    placed = pages.select("key", "url").distinct().select("key", "url", F.explode(folders).alias("_folder"))
    return pages.join(placed.join(known, ["key", "_folder"], "left_semi").select("key", "url").distinct(), ["key", "url"], "left_semi")


def contact_pages(links: Column, origin: Column, most: int = 2) -> Column:
    """URLs of pages that look like contact pages, then guessed ones, distinct, the first ``most``."""
    found = F.transform(F.filter(links, lambda x: x["url"].rlike(CONTACT_URL) | x["text"].rlike(CONTACT_TEXT)), lambda x: x["url"])
    return F.slice(F.array_distinct(F.concat(found, *[F.array(F.concat(origin, F.lit(g))) for g in CONTACT_GUESSES])), 1, most)


def findable(people: DataFrame, context: DataFrame, done: DataFrame, limit: int, ids: list[str]) -> DataFrame:
    """The ``limit`` people without an address who are easiest to find, ``score`` first; a limit must be given.

    ``people`` (ids, domain, name, title, email, pos), ``context`` (domain, specialty), ``done`` (ids).
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    wanted = people.where((F.trim(F.coalesce("email", F.lit(""))) == "") & (F.size(F.split(F.trim("name"), r"\s+")) >= 2)).join(done.select(*ids).distinct(), ids, "left_anti")
    known = wanted.join(context.select("domain", "specialty"), "domain", "left")
    score = F.when(filled("title"), 2).otherwise(0) + F.when(filled("specialty"), 1).otherwise(0) + F.when(F.col("title").rlike(SENIOR), 2).otherwise(0)
    return known.withColumn("score", score).orderBy(F.desc("score"), "pos").limit(limit)


def usable_hits(hits: DataFrame) -> DataFrame:
    """Searched addresses whose owner is confirmed and whose page is known."""
    return hits.where("email like '%@%' and source_url != '' and identity_match = 'confirmed' and coalesce(confidence, '') != 'not_found'")


def merge_hits(master: DataFrame, hits: DataFrame, ids: list[str], order: str) -> DataFrame:
    """Master with web_found_email, _source and _confidence, and best_email upgraded where none was published.

    Joined on a stable key; the last usable hit of a person counts.
    """
    last = usable_hits(hits).groupBy(*ids).agg(F.max_by(F.struct("email", "source_url", "confidence"), F.struct(order, "email", "source_url")).alias("_h"))
    joined = master.drop("web_found_email", "web_found_source", "web_found_confidence").join(last, ids, "left")
    better = F.col("_h").isNotNull() & (F.trim(F.coalesce("email", F.lit(""))) == "")
    old = lambda c: F.col(c) if c in master.columns else F.lit(None).cast("string")
    return joined.select(
        *[c for c in joined.columns if c not in ("_h", "best_email", "best_email_basis")], F.col("_h.email").alias("web_found_email"), F.col("_h.source_url").alias("web_found_source"), F.col("_h.confidence").alias("web_found_confidence"),
        F.when(better, F.col("_h.email")).otherwise(old("best_email")).alias("best_email"), F.when(better, F.concat(F.lit("web-found:"), "_h.confidence")).otherwise(old("best_email_basis")).alias("best_email_basis"))


def routed(sites: DataFrame, rank_ledger: DataFrame) -> DataFrame:
    """Sites with ``route``: reuse a ranking, skip a host that is down, explore unseeded after a failure, else map.

    ``rank_ledger`` (key, error, site_down) holds the last record of each site, failures included.
    """
    seen = rank_ledger.select("key", F.lit(True).alias("_seen"), "error", "site_down")
    route = F.when(F.col("_seen").isNull(), "map").when(F.col("error").isNull(), "reuse").when(F.coalesce("site_down", F.lit(False)), "skip").otherwise("unseeded")
    return sites.join(seen, "key", "left").withColumn("route", route).drop("_seen", "error", "site_down")


def _same_page(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^(?i:https?)://(?i:www\.)?", ""), r"/+\z", "")


def to_sweep(profiles: Column, visited: Column, people: Column, most: int = 150) -> Column:
    """Profile pages not visited yet, where there are over 1.3 times as many profiles as people found; else none."""
    seen = F.transform(visited, _same_page)
    left = F.transform(F.array(seen), lambda s: F.filter(profiles, lambda p: ~F.array_contains(s, _same_page(p))))[0]
    return F.when(F.size(profiles) > 1.3 * people, F.slice(left, 1, most)).otherwise(F.array().cast("array<string>"))


def rank_report(records: DataFrame) -> DataFrame:
    """The ranking's report: a row for each candidate, then profile pages not listed; a row for a failure or for no candidate."""
    none, blank = F.lit(None).cast("string"), F.lit(None).cast("int")
    row = lambda rank, kind, score, url, title, reason, error: F.struct(rank.cast("int").alias("rank"), kind.alias("kind"), score.cast("int").alias("score"), url.alias("url"), title.alias("title"), reason.alias("reason"), error.alias("error"))
    listed = F.transform("candidates", lambda c, i: row(i + 1, c["kind"], c["score"], c["url"], c["title"], c["reason"], none))
    more = F.transform(F.array_except("profile_urls", F.transform("candidates", lambda c: c["url"])), lambda u: row(blank, F.lit("profile"), blank, u, none, F.lit("expanded from profile prefix"), none))
    failed = F.array(row(blank, none, blank, none, none, none, F.col("error")))
    empty = F.array(row(blank, none, blank, none, none, F.lit("no candidate pages found"), none))
    rows = F.when(F.col("error").isNotNull(), failed).when(F.size("candidates") + F.size("profile_urls") == 0, empty).otherwise(F.concat(listed, more))
    return records.select("company", "website", F.explode(rows).alias("r")).select("company", "website", "r.*")
