"""Queries over readers, writers, recorded services and the choices of a crawl."""

from __future__ import annotations

import asyncio

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import crawl, harvest
from ..operators.ledger import numbered, numbered_within
from ..sources import files, ledger_source, providers
from ..sources.shared import bytes_of, new_folder, scattered
from ..streaming import resume
from .page_queries import ADDRESSES_SQL, KEY, _csv_sql, _decoded_sql, _squeezed_sql, _text_sql
from .registry import query, table


@query("""SELECT c_custkey::VARCHAR AS id, c_name || ', "' || c_mktsegment || '"' AS name, CASE WHEN c_custkey % 3 = 0 THEN 'line' || chr(10) || c_custkey END AS note FROM customer WHERE c_custkey % 10 <> 0""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as one CSV file and read again in ten splits, cut where they fall: quotes, commas and line feeds in cells; blank rows are left out."""
    k = F.col("c_custkey")
    filled = lambda c: F.when(k % 10 != 0, c)
    rows = table(spark, sf_dir, "customer").select(
        filled(k.cast("string")).alias("id"), filled(F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))).alias("name"), filled(F.when(k % 3 == 0, F.concat(F.lit("line\n"), k))).alias("note"))
    path = new_folder(spark, "csv")
    files.write_csv(rows.coalesce(1), path)  # one file, as people hand tables over
    return files.read_csv(spark, path, split_bytes=max(1, bytes_of(spark, path) // 10)).drop("_pos")


@query("""SELECT user_id AS domain, event_id, CASE WHEN event_type = 'error' THEN 'key <redacted> refused' END AS error, 'sk-' || event_type AS company,
  row_number() OVER (ORDER BY event_id % 3, event_id) AS seq FROM events""")
def ledger_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a JSON-lines ledger in three runs and read again, in the order of appends: only errors lose what looks like a key."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("domain"), "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("key sk-abcd"), "event_id", F.lit(" refused"))).alias("error"), F.concat(F.lit("sk-"), "event_type").alias("company"))
    path = new_folder(spark, "ledger")
    for run in range(3):
        files.append_ledger(rows.where(F.col("event_id") % 3 == run).orderBy("event_id"), path)
    read = files.read_ledger(spark, path, "domain long, event_id long, error string, company string")
    return numbered(read, "_seq", "seq").withColumn("seq", F.col("seq") + 1).drop("_seq")


@query("""WITH runs AS (SELECT user_id AS domain, event_id, event_type, event_id % 3 + 1 AS run, row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1 AS place FROM events WHERE event_id % 3 <> 2 OR event_id % 2 = 0)
SELECT domain, event_id, CASE WHEN event_type = 'error' THEN 'key <redacted> refused' END AS error, run, place FROM runs WHERE run >= 2""")
def ledger_source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a ledger in three runs by its data source and read from the second run on; the filter on runs leaves the first run's files out."""
    e, path = F.col("event_id"), new_folder(spark, "ledger-source")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("domain"), "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("key sk-abcd"), e, F.lit(" refused"))).alias("error"))
    for run in range(3):
        ledger_source.append(rows.where((e % 3 == run) & ((e % 3 != 2) | (e % 2 == 0))).orderBy("event_id"), path)
    read = spark.read.format("ledger").load(path).where("_run >= 2")
    return numbered_within(read, "_run", "_at", name="place").select("domain", "event_id", "error", F.col("_run").alias("run"), "place")


@query("SELECT user_id AS domain, event_id, event_id % 4 + 1 AS run FROM events")
def ledger_source_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over a ledger's runs: two are there when it starts, one comes before each of two restarts on its checkpoint."""
    path, checkpoint, out = (new_folder(spark, f"ledger-{n}") for n in ("streamed", "checkpoint", "followed"))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("domain"), "event_id")
    for run in range(4):
        ledger_source.append(rows.where(F.col("event_id") % 4 == run), path)
        if run:
            stream = spark.readStream.format("ledger").schema(ledger_source.with_places(rows.schema)).load(path)
            each = resume.ledger_batch(out, lambda df: df.select("domain", "event_id", F.col("_run").alias("run")))
            stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("domain", "event_id", "run")


@query("""WITH runs AS (SELECT user_id AS domain, event_id, event_id % 3 AS run, CASE WHEN event_type = 'error' THEN 'error' ELSE 'high' END AS confidence FROM events WHERE event_id % 3 = 0 OR user_id % (event_id % 3 + 1) = 0),
good AS (SELECT * FROM runs WHERE confidence <> 'error') SELECT domain, arg_max(event_id, (run, event_id)) AS event_id, 'high' AS confidence FROM good GROUP BY 1""")
def cache_after_three_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last good lookup of each domain after three appends, each smaller than the one before."""
    e, path = table(spark, sf_dir, "events"), new_folder(spark, "cache")
    rows = e.select(F.col("user_id").alias("domain"), "event_id", F.when(F.col("event_type") == "error", "error").otherwise("high").alias("confidence"))
    for run in range(3):
        files.append_ledger(rows.where((F.col("event_id") % 3 == run) & (F.col("domain") % (run + 1) == 0)).orderBy("event_id"), path)
    return files.read_cache(spark, path, "domain long, event_id long, confidence string")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice; readers get the second version."""
    rows, path = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_acctbal"), new_folder(spark, "versions")
    files.write_versioned(rows.drop("s_acctbal"), path, "v1")
    files.write_versioned(rows.where("s_acctbal > 0").drop("s_acctbal"), path, "v2")
    return files.read_versioned(spark, path)


@query("""SELECT c_nationkey AS domain, arg_min(c_mktsegment, c_custkey) AS specialty, '' AS suburb, arg_min(CASE WHEN c_acctbal > 0 THEN 'in' ELSE '' END, c_custkey) AS state FROM customer GROUP BY 1""")
def context_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first context of every domain; a column that isn't there is blank."""
    rows = table(spark, sf_dir, "customer").withColumn("state", F.when(F.col("c_acctbal") > 0, "in"))
    return files.context(rows, F.col("c_nationkey"), "c_mktsegment", "c_suburb", "state", "c_custkey")


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN lower(CASE WHEN event_id % 4 = 2 THEN '' ELSE 'A' || event_id || '@x.example' END) END AS email,
  CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN 'uncertain' ELSE 'confirmed' END AS identity_match, CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN 'low' ELSE 'high' END AS confidence FROM events""")
def search_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a search as whole JSON, inside other words, without fields, and unreadable."""
    at = F.col("event_id") % 4
    whole = F.format_string('{"email": " A%d@x.example ", "source_url": "u", "identity_match": "confirmed", "confidence": "high"}', "event_id")
    said = F.when(at == 0, whole).when(at == 1, F.concat(F.lit("Found: "), whole, F.lit(" and no more."))).when(at == 2, '{"identity_match": ""}').otherwise("I could not find it")
    return table(spark, sf_dir, "events").select("event_id", providers.search_answer(said).alias("a")).select("event_id", "a.email", "a.identity_match", "a.confidence")


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 7 <> 3 THEN 'answer ' || c_custkey * 2 END AS answer, CASE WHEN c_custkey % 7 <> 3 THEN CASE c_custkey % 5 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END END::INTEGER AS tries,
  CASE WHEN c_custkey % 7 = 3 THEN 'ValueError: no such host' END AS error FROM customer""")
def answers_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A service with recorded delays, asked forty times at once in a task: some calls are slow, some heal when asked again, some fail."""
    async def call(request: dict) -> dict:
        k = request["id"]
        tried[k] = tried.get(k, 0) + 1
        await asyncio.sleep(k % 4 / 1000)
        if k % 7 == 3:
            raise ValueError("no such host")
        if tried[k] <= k % 5 < 3:
            raise ConnectionError("try again")
        return {"answer": f"answer {2 * k}", "tries": tried.pop(k)}

    tried: dict[int, int] = {}
    service = providers.Provider("recorded delays", call, "answer string, tries int", providers.Retry(attempts=3, first_wait=0.001))
    asked = scattered(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id")
    return providers.ask(asked, service, at_once=40)


_RENDER_SQL = f"""shown AS (SELECT 'document' AS kind, doc_id AS id, text AS s FROM documents UNION ALL SELECT 'page', page_id, html FROM pages
  UNION ALL SELECT 'stub', doc_id, '<main>' || text[1:590] || '</main>' FROM documents UNION ALL SELECT 'empty', doc_id, CASE WHEN doc_id % 2 = 0 THEN '' END FROM documents),
told AS (SELECT kind, id, s, coalesce(regexp_matches(s[1:4000], '(?i)<(!doctype|html|head|body|div|main|section)\\b'), false) AS markup, {_squeezed_sql(_decoded_sql(_text_sql('s')))} AS seen FROM shown)"""


@query(f"""WITH {_RENDER_SQL} SELECT kind, id, coalesce(s, '') = '' OR (markup AND length(seen) < 600 AND NOT coalesce(json_valid(trim(s)) AND regexp_matches(trim(s), '^[\\[{{]'), false) AND NOT {_csv_sql('s')}) AS needs_render FROM told""")
def needs_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sources a browser would fetch again: none at all, and markup with little text; texts that are no markup are data."""
    docs, kind = table(spark, sf_dir, "documents", "doc_id", "text"), lambda k: F.lit(k).alias("kind")
    shown = docs.select(kind("document"), F.col("doc_id").alias("id"), F.col("text").alias("s")).union(table(spark, sf_dir, "pages").select(kind("page"), "page_id", "html"))
    stubs = docs.select(kind("stub"), "doc_id", F.concat(F.lit("<main>"), F.substring("text", 1, 590), F.lit("</main>")))
    shown = shown.union(stubs).union(docs.select(kind("empty"), "doc_id", F.when(F.col("doc_id") % 2 == 0, "")))
    return shown.select("kind", "id", providers.needs_render(F.col("s")).alias("needs_render"))


@query(f"""WITH {ADDRESSES_SQL}, s AS (SELECT {KEY} AS key, min(page_id) AS page_id FROM pages GROUP BY 1), n AS (SELECT id, count(*) AS n FROM found WHERE kind = 'page' GROUP BY 1)
SELECT key AS domain, 1 AS pages, coalesce(n, 0)::INTEGER AS n_addresses FROM s LEFT JOIN n ON id = page_id""")
def harvest_inboxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of every site from its recorded home page; its contact pages were not recorded."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    sites = crawl.targets(pages, "url", "name", "page_id")
    recorded = pages.groupBy("url").agg(F.min_by("html", "page_id").alias("html"))
    found = harvest.harvest(sites, lambda asked: providers.recorded(asked, recorded, "url"), kind="tier")
    return found.select("domain", "pages", F.size("sources").alias("n_addresses"))


_CHOICES = """e AS (SELECT user_id, event_id, 'https://example.com/' || event_type || '/' || event_id AS url, 50 + event_id % 50 AS score, (['directory', 'other', 'profile'])[1 + event_id % 3] AS kind FROM events), c AS (SELECT user_id || '-' || event_id // 500 AS site, * FROM e)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of every site, in order: a site is a user's part of 500 events, so its list is bounded."""
    e = F.col("event_id")
    url = F.concat(F.lit("https://example.com/"), "event_type", F.lit("/"), e)
    kind = F.element_at(F.array(F.lit("directory"), F.lit("other"), F.lit("profile")), (e % 3 + 1).cast("int"))
    one = F.struct(url.alias("url"), F.lit(None).cast("string").alias("title"), (F.lit(50) + e % 50).cast("int").alias("score"), F.lit("r").alias("reason"), kind.alias("kind"))
    site = F.concat_ws("-", "user_id", F.floor(e / 500))
    rows = table(spark, sf_dir, "events").select(site.alias("site"), "user_id", F.struct("event_id", one.alias("c")).alias("x"))
    return rows.groupBy("site", "user_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["c"]).alias("candidates"))


@query(f"""WITH {_CHOICES}, k AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY event_id) AS rank FROM c WHERE score >= 85 AND kind <> 'profile') SELECT site, rank::INTEGER AS rank, url FROM k WHERE rank <= 5""")
def shortlist_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five good pages of every site that are no profiles."""
    rows = _records(spark, sf_dir).select("site", F.posexplode(crawl.shortlist(F.col("candidates"))).alias("_at", "c"))
    return rows.select("site", (F.col("_at") + 1).alias("rank"), "c.url")


@query(f"""WITH {_CHOICES}, u AS (SELECT DISTINCT site, user_id FROM c), f AS (SELECT site, user_id % 10 = 0 AS failed FROM u)
SELECT site AS company, row_number() OVER (PARTITION BY site ORDER BY event_id)::INTEGER AS rank, url, kind, NULL AS error FROM c JOIN f USING (site) WHERE NOT failed
UNION ALL SELECT site, NULL, 'https://example.com/extra/' || site, 'profile', NULL FROM f WHERE NOT failed UNION ALL SELECT site, NULL, NULL, NULL, 'failed' FROM f WHERE failed""")
def rank_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking's report: candidates, profile pages that are not listed among them, and failures."""
    u = F.col("user_id")
    listed = F.when(F.size("candidates") > 0, F.get("candidates", F.lit(0))["url"])
    records = _records(spark, sf_dir).select(
        F.col("site").alias("company"), F.lit("w").alias("website"), "candidates", F.array(listed, F.concat(F.lit("https://example.com/extra/"), "site")).alias("profile_urls"), F.when(u % 10 == 0, "failed").alias("error"))
    return crawl.rank_report(records).select("company", "rank", "url", "kind", "error")


@query(f"""WITH {_CHOICES}, n AS (SELECT site, count(*) AS n FROM c GROUP BY 1), k AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY event_id) AS r FROM c JOIN n USING (site) WHERE n > 1.3 * 3 AND event_id % 2 = 1)
SELECT site, r::INTEGER AS rank, url FROM k WHERE r <= 150""")
def profile_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile pages still to read where three people were found and far more profiles are known; half were visited by another spelling."""
    rows = _records(spark, sf_dir).select("site", F.transform("candidates", lambda c: c["url"]).alias("profiles"))
    seen = F.transform(F.filter("profiles", lambda u: F.regexp_extract(u, r"(\d+)\z", 1).cast("long") % 2 == 0), lambda u: F.concat(F.replace(u, F.lit("https://"), F.lit("http://www.")), F.lit("/")))
    return rows.select("site", F.posexplode(crawl.to_sweep(F.col("profiles"), seen, F.lit(3))).alias("_at", "url")).select("site", (F.col("_at") + 1).alias("rank"), "url")
