"""Queries over whole stages and the steps between services, all recorded or answered by rule."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import domains, frontier, ledger, models, patterns, people, rounds, stages
from ..sources import files, providers
from ..sources.shared import new_folder
from .ledger_queries import RAW_SQL, _raw_people
from .page_queries import HOST, KEY, PATH, QUERY, SCHEME
from .registry import query, table

# The data's hosts hold a vendor word, so both sides read another word in its place.
_CLINIC_SQL = "clinics AS (SELECT page_id, replace(url, 'example', 'clinic') AS url FROM pages)"
_SITES_SQL = f"{_CLINIC_SQL}, sites AS (SELECT {KEY} AS key, min(page_id) AS page_id, count(*) AS n FROM clinics GROUP BY 1)"


def _clinics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "url").select("page_id", F.replace("url", F.lit("example"), F.lit("clinic")).alias("url"))


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import crawl

    return crawl.targets(_clinics(spark, sf_dir), "url", "name", "page_id")


@query(f"""WITH {_SITES_SQL}, m AS (SELECT key, page_id, CASE WHEN n % 3 = 0 THEN 'held@' || key ELSE '' END AS held FROM sites),
told AS (SELECT *, held = '' AND length(key) % 7 <> 0 AND page_id % 5 <> 0 AS fills FROM m)
SELECT key AS domain, CASE WHEN fills THEN 'info@' || key ELSE held END AS business_email, CASE WHEN fills THEN 'info@' || key || '; ann.lee@' || key END AS all_business_emails, CASE WHEN fills THEN 'office@gmail.com; x@partner.net' END AS related_email FROM told""")
def recover_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second harvest of sites that are still empty, run twice over one ledger: failed sites are tried again, the others are not asked."""
    sites = _sites(spark, sf_dir)
    counts = _clinics(spark, sf_dir).groupBy(providers.urls.site_key(F.col("url")).alias("key")).agg(F.count("*").alias("n"))
    master = sites.join(counts, "key").select(F.col("key").alias("domain"), F.lit("").alias("email"), F.when(F.col("n") % 3 == 0, F.concat(F.lit("held@"), "key")).otherwise("").alias("business_email"))
    static = sites.select(F.col("key").alias("domain"), F.array().cast("array<string>").alias("business_emails"), F.when(F.length("key") % 7 == 0, "failed").alias("error"))
    shown = F.concat(F.lit("<p>ann.lee@"), "key", F.lit(" x@partner.net info@"), "key", F.lit(" office@gmail.com</p>"))
    recorded = sites.select(F.col("original").alias("url"), F.when(F.col("pos") % 5 != 0, shown).alias("html"), F.when(F.col("pos") % 5 == 0, "HTTP 500").alias("error"))
    path = new_folder(spark, "related")
    for _ in range(2):
        folded = stages.recover_related(_clinics(spark, sf_dir), master, static, path, lambda asked: providers.recorded(asked, recorded, "url"), "url", "name", "page_id")
    return folded.select("domain", "business_email", "all_business_emails", "related_email")


_ENTRIES_SQL = f"""{_SITES_SQL}, placed AS (SELECT {KEY} AS key, url, row_number() OVER (PARTITION BY {KEY} ORDER BY page_id) - 1 AS pos FROM clinics),
pooled AS (SELECT key, url, pos FROM placed JOIN sites USING (key) WHERE n % 4 <> 3 AND pos < 1000),
parts AS (SELECT key, url, pos, {HOST} AS host, {PATH} AS path, {QUERY} AS q, {SCHEME} AS scheme FROM pooled),
usable AS (SELECT * FROM parts WHERE NOT regexp_matches(lower(path), '(^|/)(sitemap([_-][^/]*)?\\.xml(\\.gz)?|robots\\.txt)$|\\.(css|js|mjs|map|json|xml|pdf|jpe?g|png|gif|webp|svg|ico|woff2?|ttf|eot|zip|gz|mp[34]|webm|avi|mov)$')),
each AS (SELECT key, min(pos) AS pos, arg_min(regexp_replace(url, '#.*$', ''), pos) AS url, arg_min(path, pos) AS path FROM usable GROUP BY key, regexp_replace(host, '^www\\.', ''), CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(path, '/') END, q),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos, url) AS entry FROM each)"""


def _rank(request: dict) -> dict:
    """Ten pages in falling order, every third a profile, and an index that no page has."""
    lines = request["prompt"].count("\n") + 1
    chosen = [{"index": i, "score": 95 - 3 * i, "reason": "r", "kind": "profile" if i % 3 == 2 else "directory"} for i in range(min(10, lines))]
    return {"answer": json.dumps({"candidates": [*chosen, {"index": 9999, "score": 99, "reason": "r", "kind": "directory"}], "profilePrefixes": ["/en"]})}


@query(f"""WITH {_ENTRIES_SQL}, c AS (SELECT key, string_agg(url, ' ' ORDER BY entry) FILTER (WHERE entry IN (1, 2, 4)) AS pages, count(*) AS listed, count(DISTINCT url) FILTER (WHERE starts_with(lower(path), '/en/') AND rtrim(lower(path), '/') <> '/en') AS n_profiles FROM numbered WHERE entry <= 800 GROUP BY 1)
SELECT key, coalesce(pages, '') AS pages, coalesce(listed, 0)::INTEGER AS listed, coalesce(n_profiles, 0)::INTEGER AS n_profiles, CASE WHEN n % 4 = 3 THEN 0 ELSE least(n, 1000) END::INTEGER AS mapped, CASE WHEN n % 4 = 3 THEN 'HTTP 500' END AS error FROM sites LEFT JOIN c USING (key)""")
def team_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of every site that may name people: its map is its pages in the table, a rule ranks them, every fourth site can't be mapped."""
    held = _clinics(spark, sf_dir).withColumn("key", providers.urls.site_key(F.col("url"))).withColumn("l", F.struct("url", F.lit(None).cast("string").alias("title")))
    # A map service answers with at most its limit of pages for a site.
    first = held.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("page_id"))).where(F.col("r") <= 1000)
    listed = first.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("r", "l"))).alias("p")).select("key", F.transform("p", lambda p: p["l"]).alias("links"))
    maps = listed.join(held.groupBy("key").agg(F.count("*").alias("n")), "key").select("key", "links", F.when(F.col("n") % 4 == 3, "HTTP 500").alias("error"))
    found = stages.team_pages(_sites(spark, sf_dir), lambda asked: providers.recorded(asked, maps, "key"), providers.Provider("rule", _rank, "answer string"))
    return found.select("key", F.array_join(F.transform("pages", lambda p: p["url"]), " ").alias("pages"), "listed", F.size("profile_pages").alias("n_profiles"), "mapped", "error")


@query("""WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 3 END AS n, s_suppkey % 10 = 9 AS down FROM supplier),
t AS (SELECT *, n - (k % 5 = 1 AND n = 3)::INT AS ok, CASE WHEN k % 3 <> 0 THEN 0 WHEN k % 7 = 0 THEN 5 ELSE 10 END AS swept, CASE WHEN k % 3 = 0 AND k % 7 = 0 THEN 5 ELSE 0 END AS lost FROM s)
SELECT 's' || k || '.test' AS domain, CASE WHEN down THEN 0 ELSE greatest(ok, swept) END::BIGINT AS people, CASE WHEN down THEN 0 ELSE ok + swept END::BIGINT AS visits, CASE WHEN down THEN 0 ELSE n - ok + lost END::BIGINT AS failed_pages, CASE WHEN down THEN 'site unreachable' END AS error FROM t""")
def site_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From shortlists to people: some sites run out of time and keep what they have, some have far more profile pages than people found."""
    k, key = F.col("s_suppkey"), F.concat(F.lit("s"), "s_suppkey", F.lit(".test"))
    page = lambda i: F.concat(F.lit("https://"), key, F.lit("/"), i)
    pages = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(page(i).alias("url")))
    sites = table(spark, sf_dir, "supplier").select(
        key.alias("key"), F.col("s_name").alias("company"), page(F.lit("home")).alias("original"), F.when(k % 4 != 0, pages).otherwise(F.slice(pages, 1, 0)).alias("pages"),
        F.when(k % 3 == 0, F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: page(F.concat(F.lit("p"), i)))).otherwise(F.array().cast("array<string>")).alias("profile_pages"), (k % 10 == 9).alias("site_down"))

    def read(asked: DataFrame) -> DataFrame:
        n = F.regexp_extract("key", "[0-9]+", 0).cast("int")
        late = ((n % 5 == 1) & F.col("pos").between(2, 999)) | ((n % 7 == 0) & (F.col("pos") >= 1005))
        return asked.select("*", F.when(~late, F.concat(F.lit("Person "), n, F.lit(" at "), F.col("pos") % 1000)).alias("html"), F.when(late, "over the time limit").alias("error"))

    model = providers.Provider("rule", lambda request: {"answer": json.dumps({"people": [{"name": request["prompt"], "title": None, "email": None}]})}, "answer string")
    _, outcomes = stages.site_people(sites, read, model)
    return outcomes.select("domain", "people", "visits", "failed_pages", "error")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type <> 'error') AND c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def unfinished_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a good record in the ledger of events and without an order, which stands for a row of the master."""
    records = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), "event_type")
    return ledger.unfinished(table(spark, sf_dir, "customer", "c_custkey"), records, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", F.col("event_type") == "error")


@query("""WITH m AS (SELECT c_custkey AS pos, 'www.n' || c_nationkey || '.clinic.com' AS domain, 'n' || c_nationkey || '.clinic.com' AS bare, c_nationkey AS n FROM customer),
cells AS (SELECT domain, bare, n, pos, 0 AS c, 0 AS p, 'P' || pos || '@' || bare AS e FROM m WHERE pos % 2 = 0 UNION ALL SELECT domain, bare, n, pos, 1, 0, 'info@' || bare FROM m UNION ALL SELECT domain, bare, n, pos, 2, 0, 'info@' || bare FROM m
  UNION ALL SELECT domain, bare, n, pos, 2, 1, ' sales@other.net' FROM m UNION ALL SELECT domain, bare, n, pos, 2, 2, 'box' || pos % 7 || '@mail' || n || '.net ' FROM m UNION ALL SELECT domain, bare, n, pos, 4, 0, 'q' || pos % 3 || '@n' || n || '.other.org' FROM m),
given AS (SELECT domain, bare, n, lower(trim(e)) AS email, min((pos, c, p)) AS pos FROM cells GROUP BY ALL)
SELECT domain, email, (pos[1])::BIGINT AS first_row, email NOT LIKE 'info@%' AS personal FROM given WHERE split_part(email, '@', 2) = CASE WHEN n % 2 = 0 THEN 'mail' || n || '.net' ELSE bare END OR split_part(email, '@', 2) = bare OR split_part(split_part(email, '@', 2), '.', 1) = 'n' || n""")
def master_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses from five columns of the master that stand on a domain's own or its mail domain."""
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    bare = F.concat(F.lit("n"), n, F.lit(".clinic.com"))
    master = table(spark, sf_dir, "customer").select(
        k.alias("pos"), F.concat(F.lit("www."), bare).alias("domain"), F.when(k % 2 == 0, F.concat(F.lit("P"), k, F.lit("@"), bare)).alias("email"), F.concat(F.lit("info@"), bare).alias("business_email"),
        F.concat(F.lit("info@"), bare, F.lit("; sales@other.net,box"), k % 7, F.lit("@mail"), n, F.lit(".net ")).alias("all_business_emails"), F.concat(F.lit("q"), k % 3, F.lit("@n"), n, F.lit(".other.org")).alias("web_found_email"))
    resolved = table(spark, sf_dir, "nation").select(F.concat(F.lit("www.n"), "n_nationkey", F.lit(".clinic.com")).alias("domain"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("mail"), "n_nationkey", F.lit(".net"))).alias("email_domain"))
    return patterns.master_evidence(master, resolved).select("domain", "email", F.col("pos.pos").alias("first_row"), "personal")


@query("""SELECT 'c' || c_custkey || '.clinic.com' AS domain, (['high', 'none', 'medium', 'none', 'error'])[1 + c_custkey % 5] AS confidence,
  CASE c_custkey % 5 WHEN 0 THEN 'aspmx.l.google.com,backup.google.com' WHEN 2 THEN 'mx.first.net' ELSE '' END AS mx FROM customer""")
def lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail domains by a native lookup, then two others where it failed: certain answers are kept, wherever they come from."""
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey", F.lit(".clinic.com")).alias("domain"), (F.col("c_custkey") % 5).alias("m"))
    none, blank = F.lit(None).cast("int").alias("priority"), F.lit(None).cast("string").alias("exchange")
    served = rows.where("m = 0").select("domain", F.explode(F.array(F.struct(F.lit(5).alias("priority"), F.lit("aspmx.l.google.com").alias("exchange")), F.struct(F.lit(10).alias("priority"), F.lit("backup.google.com.").alias("exchange")))).alias("h")).select("domain", "h.*", F.lit("NOERROR").alias("rcode"))
    native = served.unionByName(rows.where("m > 0").select("domain", none, blank, F.when(F.col("m") == 1, "NODATA").otherwise("SERVFAIL").alias("rcode")))
    first = rows.where("m in (0, 2)").select("domain", F.lit(1).alias("priority"), F.lit("10 mx.first.net.").alias("exchange"), F.lit("NOERROR").alias("rcode"))
    second = rows.where("m in (2, 3)").select("domain", F.lit(1).alias("priority"), F.when(F.col("m") == 2, "mx.second.net").alias("exchange"), F.when(F.col("m") == 3, "NXDOMAIN").otherwise("NOERROR").alias("rcode"))
    known = providers.looked_up(rows, native, first, second)
    return domains.resolve_domains(rows, known, "domain").select("domain", "confidence", F.array_join("mx", ",").alias("mx"))


@query("SELECT event_id, event_type <> 'error' AS alive FROM events")
def reachable_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which hosts are up: any status counts, a refusal too."""
    status = F.when(F.col("event_type") != "error", 200 + F.col("event_id") % 300)
    return providers.reachable(table(spark, sf_dir, "events", "event_id", "event_type"), lambda asked: asked.withColumn("status", status)).select("event_id", "alive")


@query("""WITH p AS (SELECT CASE WHEN p_size > 25 THEN 'large' ELSE p_brand END AS domain, p_name || ' ' || p_partkey AS name FROM part), n AS (SELECT domain, count(*) AS n FROM p GROUP BY 1)
SELECT domain, name, CASE WHEN n > 250 THEN row_number() OVER (PARTITION BY domain ORDER BY name) END::INTEGER AS rank FROM p JOIN n USING (domain)""")
def people_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of sites that are too large for a model, in the order of their names."""
    raw = table(spark, sf_dir, "part").select(F.when(F.col("p_size") > 25, "large").otherwise(F.col("p_brand")).alias("domain"), F.concat_ws(" ", "p_name", "p_partkey").alias("name"), *[F.lit(None).cast("string").alias(c) for c in ("title", "email", "source_url")], F.col("p_partkey").alias("pos"))
    return models.by_name(people.dedupe_people(raw)).select("domain", "name", "rank")


@query("SELECT 'n' || c_nationkey || '.test' AS domain, CASE WHEN c_nationkey % 2 = 0 THEN -1 ELSE count(*) END AS people FROM customer GROUP BY c_nationkey")
def company_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each company, written for all and then again for every second one."""
    path = new_folder(spark, "companies")
    outcomes = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("people")).select(F.concat(F.lit("n"), "c_nationkey", F.lit(".test")).alias("domain"), "people", "c_nationkey")
    files.write_companies(outcomes.select("domain", "people"), path)
    files.write_companies(outcomes.where("c_nationkey % 2 = 0").select("domain", F.lit(-1).alias("people")), path)
    return spark.read.schema("domain string, people long").json(path).select("domain", "people")


def _explorer(request: dict) -> dict:
    """The next wish by rule: a page without text is rendered at once, else the first known link that was not visited, in the order in which links were seen."""
    last, tried = request["history"][-1], {h["url"] for h in request["history"]}
    if last["error"] is None and last["mode"] == "none" and not last["chars"]:
        return {"tool": "visit", "url": last["url"], "mode": "render", "selector": None}
    ahead = [x["url"] for h in request["history"] for x in h["links"] or [] if x["url"] not in tried]
    return {"tool": "visit" if ahead else "done", "url": ahead[0] if ahead else None, "mode": "none", "selector": None}


@query(f"""WITH RECURSIVE held AS (SELECT {KEY} AS key, page_id, row_number() OVER (PARTITION BY {KEY} ORDER BY page_id) - 1 AS r, count(*) OVER (PARTITION BY {KEY}) AS n, length(html) % 4 = 0 AS thin FROM (SELECT page_id, replace(url, 'example', 'clinic') AS url, html FROM pages)),
site AS (SELECT key, r, page_id % 7 = 3 AS fails, thin, list_filter([2 * r + 1, 2 * r + 2], lambda x: x < n) AS kids FROM held),
walk AS (SELECT key, 1 AS step, 0::BIGINT AS r, 'none' AS mode, [0::BIGINT] AS tried, []::BIGINT[] AS links FROM site WHERE r = 0 UNION ALL
  SELECT key, step + 1, CASE WHEN again THEN r ELSE ahead END, CASE WHEN again THEN 'render' ELSE 'none' END, CASE WHEN again THEN tried ELSE list_append(tried, ahead) END, seen FROM (
    SELECT *, list_filter(seen, lambda x: NOT list_contains(tried, x))[1] AS ahead FROM (
      SELECT w.*, mode = 'none' AND thin AND NOT fails AS again, list_concat(links, CASE WHEN fails OR mode = 'none' AND thin THEN [] ELSE kids END) AS seen FROM walk w JOIN site USING (key, r))) WHERE step < 16 AND (again OR ahead IS NOT NULL))
SELECT key, step, 'https://' || key || '/p' || r AS url, mode, CASE WHEN fails THEN 'HTTP 500' END AS error FROM walk JOIN site USING (key, r)""")
def explored_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites explored by a rule, at most 16 steps each: a page links to two more, some fail, some show nothing until they are rendered."""
    pages = table(spark, sf_dir, "pages")
    key = providers.urls.site_key(F.replace("url", F.lit("example"), F.lit("clinic")))
    placed = ledger.numbered_within(pages.select(key.alias("key"), "page_id", (F.length("html") % 4 == 0).alias("thin")), "key", "page_id")
    counts = placed.groupBy("key").agg(F.count("*").alias("n"))
    page = lambda r: F.concat(F.lit("https://"), "key", F.lit("/p"), r.cast("string"))
    link = lambda r: F.when(r < F.col("n"), F.concat(F.lit('<a href="'), page(r), F.lit('">page</a>'))).otherwise("")
    r = F.col("r")
    shown = F.concat(F.lit("<body>"), link(2 * r + 1), link(2 * r + 2), F.lit("<p>text</p></body>"))
    recorded = placed.join(counts, "key").select("key", page(r).alias("url"), "thin", F.when(F.col("page_id") % 7 != 3, shown).alias("full"), F.when(F.col("page_id") % 7 == 3, "HTTP 500").alias("error"))

    def fetch(asked: DataFrame) -> DataFrame:
        html = F.when(F.col("thin") & (F.col("mode") == "none") & F.col("full").isNotNull(), "<body></body>").otherwise(F.col("full"))
        return asked.join(recorded, ["key", "url"], "left").select(*asked.columns, html.alias("html"), "error")

    sites = counts.select("key", page(F.lit(0)).alias("original"))
    model = providers.asking(providers.Provider("rule", _explorer, "tool string, url string, mode string, selector string"), at_once=8)
    found = frontier.explore(sites, fetch, model, new_folder(spark, "exploration"))
    return found.answers.select("key", "step", "url", "mode", "error")


def _organised(request: dict) -> dict:
    """Leaders first, then by name; some lines are no people, and some people get another name."""
    rows = [[x.strip() for x in line.split(" | ")] for line in request["prompt"].split("\n")]
    kept = sorted((r for r in rows if r[0].lower() >= "c"), key=lambda r: ("BRASS" not in r[1], r[0]))
    return {"answer": json.dumps({"people": [{"name": r[0] + " Jr" if r[0].lower().rstrip("!").endswith("e") else r[0], "title": r[1], "email": r[2].upper()} for r in kept]})}


@query(f"""WITH {RAW_SQL}, counted AS (SELECT *, trim(name) AS shown, CASE WHEN email IS NULL THEN first_url ELSE email_url END AS url, count(*) OVER (PARTITION BY domain) AS n FROM merged),
asked AS (SELECT *, regexp_matches(lower(rtrim(shown, '!')), 'e$') AS renamed, row_number() OVER (PARTITION BY domain ORDER BY coalesce(title, '') NOT LIKE '%BRASS%', shown) - 1 AS place FROM counted WHERE n <= 250 AND lower(shown) >= 'c')
SELECT domain, CASE WHEN renamed THEN shown || ' Jr' ELSE shown END AS name, title, email, CASE WHEN NOT renamed THEN url END AS source_url, place::INTEGER AS place FROM asked UNION ALL SELECT domain, name, title, email, url, NULL FROM counted WHERE n > 250""")
def organised_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of each brand merged by code, then put in order by a rule that drops and renames some; brands of over 250 people are not asked for."""
    return models.organise_people(_raw_people(spark, sf_dir), providers.Provider("rule", _organised, "answer string")).select("domain", "name", "title", "email", "source_url", "place")


def _judged(request: dict) -> dict:
    """A format by the first name and how many there are; none where the prompt isn't what was promised."""
    shown, given = (x.split("\n") for x in request["prompt"].split("\n\n"))
    if len(shown) > 25 or len(given) > 12 or not given[0].startswith("ann."):
        return {"answer": json.dumps({"pattern": None})}
    return {"answer": json.dumps({"pattern": "{first}.{last}" if len(shown) == 25 or shown[0][-1] in "acegi" else "{last}"})}


@query("""WITH p AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'hot.test' ELSE 'n' || c_nationkey || '.test' END AS domain, c_custkey AS pos, 'x' || translate(c_custkey::VARCHAR, '0123456789', 'abcdefghij') AS last FROM customer),
n AS (SELECT domain, count(*) AS names, right(arg_min(last, pos), 1) AS l FROM p GROUP BY 1), e AS (SELECT domain, pos, 'ann.' || last || '@' || domain AS email FROM p WHERE pos % 4 = 1)
SELECT domain, '{first}.{last}' AS pattern, arg_min(email, pos) AS source FROM n JOIN e USING (domain) WHERE names >= 25 OR l IN ('a', 'c', 'e', 'g', 'i') GROUP BY 1""")
def judged_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats that a rule proposes from 25 names and 12 addresses of each domain; one domain has a third of all names."""
    k = F.col("c_custkey")
    last = F.concat(F.lit("x"), F.translate(k.cast("string"), "0123456789", "abcdefghij"))
    rows = table(spark, sf_dir, "customer").select(F.when(k % 3 == 0, "hot.test").otherwise(F.concat(F.lit("n"), "c_nationkey", F.lit(".test"))).alias("domain"), k.alias("pos"), last.alias("last"))
    named = rows.select("domain", "pos", F.concat(F.lit("Ann "), "last").alias("name"))
    given = rows.where("pos % 4 = 1").select("domain", "pos", F.concat(F.lit("ann."), "last", F.lit("@"), "domain").alias("email"))
    return models.judge_patterns(rows.select("domain").distinct(), named, given, providers.Provider("rule", _judged, "answer string"))


@query("""WITH c AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS n, count(*) OVER () AS total FROM customer), s AS (SELECT *, greatest(1, total // 8) AS size FROM c),
p AS (SELECT *, n // size AS round, id % 11 = 5 AS fails FROM s), again AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS m FROM p WHERE round >= 3 OR fails)
SELECT id, 'answer ' || id AS answer, 0 AS run, round::INTEGER AS asked FROM p WHERE round < 3 AND NOT fails UNION ALL SELECT id, 'answer ' || id, 1, (m // size)::INTEGER FROM again""")
def metered_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dear calls in rounds of an eighth of all keys: a recorded meter stops the first run after three; the second asks for what is left and for what failed."""
    requests = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    path, size = new_folder(spark, "metered"), max(1, requests.count() // 8)
    for run, readings in enumerate(([10.0, 50.0, 89.0, 90.0], [0.0] * 20)):
        read = iter(readings)
        fails = (F.col("id") % 11 == 5) & F.lit(run == 0)
        service = lambda asked: asked.select("id", F.when(~fails, F.concat(F.lit("answer "), "id")).alias("answer"), F.lit(run).alias("run"), F.when(fails, "no luck").alias("error"))  # noqa: B023, E731
        rounds.ask_in_rounds(requests, service, path, "id", "id", "answer string, run int", lambda: next(read), size)  # noqa: B023
    told = files.read_ledger(spark, path, "id long, answer string, run int, error string, asked int")
    return ledger.latest_per_key(told, "id", "_seq", F.col("error").isNotNull()).select("id", "answer", "run", "asked")
