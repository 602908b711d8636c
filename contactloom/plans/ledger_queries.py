"""Queries over keyed state: ledgers of events, people merged and upserted, merges into the master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import crawl, inboxes, ledger, people
from .registry import query, table

def _failed() -> F.Column:
    return F.col("event_type") == "error"


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_type <> 'error') WHERE r = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last good record of every user; errors don't hide one."""
    return ledger.latest_per_key(table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value"), "user_id", "event_id", _failed())


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def last_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last record of every user, errors included."""
    return ledger.last_with_failures(table(spark, sf_dir, "events", "user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record of every user."""
    return ledger.first_per_key(table(spark, sf_dir, "events", "user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def pending_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a purchase: work still to do."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name").withColumnRenamed("c_custkey", "user_id")
    done = table(spark, sf_dir, "events", "user_id", "event_type")
    return ledger.pending(customers, done, "user_id", F.col("event_type") != "purchase").select(F.col("user_id").alias("c_custkey"), "c_name")


@query("""SELECT user_id, count(*) AS n_errors FROM events e WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events g WHERE g.user_id = e.user_id AND g.event_type <> 'error' AND g.event_id > e.event_id) GROUP BY user_id""")
def error_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose last records failed, and how many failures stand at the end: these are tried again."""
    events = table(spark, sf_dir, "events", "user_id", "event_id", "event_type")
    good = events.where(~_failed()).groupBy("user_id").agg(F.max("event_id").alias("_good"))
    late = events.where(_failed()).join(good, "user_id", "left").where(F.col("_good").isNull() | (F.col("event_id") > F.col("_good")))
    return late.groupBy("user_id").agg(F.count("*").alias("n_errors"))


@query("SELECT user_id, bool_or(event_type = 'purchase' AND value > 50) AS has_any FROM events GROUP BY 1")
def has_email_bool_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether any of a user's records passes a test."""
    return ledger.has_any(table(spark, sf_dir, "events", "user_id", "event_type", "value"), "user_id", (F.col("event_type") == "purchase") & (F.col("value") > 50))


@query("SELECT user_id, n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ORDER BY n DESC, user_id LIMIT 8")
def top8_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight most frequent users."""
    return ledger.histogram(table(spark, sf_dir, "events", "user_id"), "user_id", 8)


@query("SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS n, count(*) OVER () AS total FROM customer) WHERE n % greatest(1, total // 40) = 0 AND n // greatest(1, total // 40) < 40")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty customers at even strides."""
    return ledger.stride_sample(table(spark, sf_dir, "customer", "c_custkey", "c_name"), "c_custkey", 40)


RAW_SQL = """raw AS (
    SELECT p_brand AS domain, p_partkey AS pos, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) || '!' WHEN p_partkey % 3 = 1 THEN p_name ELSE '  ' || p_name || ' ' END AS name,
           CASE WHEN p_size > 10 THEN p_type ELSE '' END AS title, CASE WHEN p_partkey % 4 = 0 THEN replace(p_name, ' ', '.') || p_partkey || '@example.com' END AS email, 'https://example.com/p/' || p_partkey AS source_url FROM part),
keyed AS (SELECT *, trim(regexp_replace(regexp_replace(lower(name), '[^\\p{L}\\p{N}\\s]', '', 'g'), '\\s+', ' ', 'g')) AS person_key FROM raw),
merged AS (SELECT domain, person_key, arg_max(name, (length(name), -pos)) AS name, arg_max(title, (length(title), -pos)) FILTER (title <> '') AS title,
    arg_min(email, pos) FILTER (email IS NOT NULL) AS email, arg_min(source_url, pos) FILTER (email IS NOT NULL) AS email_url, arg_min(source_url, pos) AS first_url FROM keyed GROUP BY 1, 2)"""


def _raw_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("p_partkey") % 3
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("domain"), F.col("p_partkey").alias("pos"), F.when(at == 0, F.concat(F.upper("p_name"), F.lit("!"))).when(at == 1, F.col("p_name")).otherwise(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"),
        F.when(F.col("p_size") > 10, F.col("p_type")).otherwise("").alias("title"), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), "p_partkey", F.lit("@example.com"))).alias("email"),
        F.concat(F.lit("https://example.com/p/"), "p_partkey").alias("source_url"))


@query(f"WITH {RAW_SQL} SELECT domain, person_key, name, title, email, CASE WHEN email IS NULL THEN first_url ELSE email_url END AS source_url FROM merged")
def dedupe_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of each brand merged by key: longest name and title, the first address with its own page."""
    return people.dedupe_people(_raw_people(spark, sf_dir))


@query(f"""WITH {RAW_SQL}, found AS (SELECT domain, person_key, email FROM merged WHERE email IS NOT NULL)
SELECT pos, k.domain, f.email AS known_email FROM keyed k LEFT JOIN found f USING (domain, person_key)""")
def reattach_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row with the address that the merge kept for its person, null where there is none."""
    raw = _raw_people(spark, sf_dir)
    kept = people.dedupe_people(raw).where("email is not null").select("domain", "person_key", F.col("email").alias("known_email"))
    return raw.withColumn("person_key", names.person_key(F.col("name"))).join(kept, ["domain", "person_key"], "left").select("pos", "domain", "known_email")


@query("""WITH o AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS title, CASE WHEN c_custkey % 2 = 0 THEN 'a' || c_custkey || '@example.com' END AS email, 'old' || c_custkey AS u FROM customer WHERE c_custkey % 5 <> 0),
n AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS title, CASE WHEN c_custkey % 3 = 0 THEN 'b' || c_custkey || '@example.com' END AS email, 'new' || c_custkey AS u FROM customer WHERE c_custkey % 4 <> 1),
j AS (SELECT coalesce(o.k, n.k) AS k, o.k IS NULL AS added, n.k IS NOT NULL AS seen, coalesce(o.name, n.name) AS name, o.title AS ot, n.title AS nt, o.email AS oe, n.email AS ne, o.u AS ou, n.u AS nu FROM o FULL JOIN n ON o.k = n.k),
d AS (SELECT *, seen AND coalesce(nt, '') <> '' AND nt IS DISTINCT FROM ot AS dt, seen AND coalesce(ne, '') <> '' AND ne IS DISTINCT FROM oe AS de FROM j)
SELECT 'd' || (k % 10) AS domain, 'p' || k AS person_key, name, CASE WHEN coalesce(nt, '') <> '' THEN nt ELSE ot END AS title, CASE WHEN coalesce(ne, '') <> '' THEN ne ELSE oe END AS email,
  CASE WHEN added OR de THEN nu ELSE ou END AS source_url, CASE WHEN added OR (seen AND (dt OR de)) THEN 'now' ELSE CASE WHEN added THEN NULL ELSE 'before' END END AS updated_at, CASE WHEN added THEN 'added' WHEN dt OR de THEN 'updated' ELSE 'same' END AS change FROM d""")
def upsert_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New and changed people put into the master; two overlapping parts of the customers stand for both sides."""
    k = F.col("c_custkey")
    base = table(spark, sf_dir, "customer")
    keys = [F.concat(F.lit("d"), k % 10).alias("domain"), F.concat(F.lit("p"), k).alias("person_key"), F.col("c_name").alias("name")]
    old = base.where(k % 5 != 0).select(*keys, F.col("c_mktsegment").alias("title"), F.when(k % 2 == 0, F.concat(F.lit("a"), k, F.lit("@example.com"))).alias("email"), F.concat(F.lit("old"), k).alias("source_url"), F.lit("before").alias("updated_at"))
    new = base.where(k % 4 != 1).select(*keys, F.when(k % 7 == 0, "").when(k % 11 == 0, "CHANGED").otherwise(F.col("c_mktsegment")).alias("title"), F.when(k % 3 == 0, F.concat(F.lit("b"), k, F.lit("@example.com"))).alias("email"), F.concat(F.lit("new"), k).alias("source_url"))
    return people.upsert_people(old, new, F.lit("now"))


@query("""SELECT o_orderkey, c_mktsegment AS segment, CASE WHEN o_orderpriority LIKE '%NOT SPECIFIED%' THEN c_name ELSE o_orderpriority END AS note
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def fill_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose empty notes take the customer's name, with a segment column that they lacked."""
    note = F.when(F.col("o_orderpriority").contains("NOT SPECIFIED"), "").otherwise(F.col("o_orderpriority"))
    master = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("domain"), note.alias("note"))
    found = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("domain"), F.col("c_name").alias("note"), F.col("c_mktsegment").alias("segment"))
    return inboxes.fill_if_empty(master, found).select("o_orderkey", "segment", "note")


@query("SELECT o_orderkey, c_name AS o_orderpriority FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def replace_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a derived column replaced outright, null where nothing was found."""
    derived = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("o_orderpriority"))
    return inboxes.replace_columns(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority"), derived, "o_custkey").select("o_orderkey", "o_orderpriority")


@query("""WITH clean AS (SELECT user_id, bool_or(event_type = 'purchase') AS own FROM events WHERE event_type <> 'error' GROUP BY 1),
held AS (SELECT c_custkey AS user_id, c_acctbal > 5000 AS held FROM customer WHERE c_custkey % 3 = 0)
SELECT 'u' || user_id AS domain FROM clean LEFT JOIN held USING (user_id) WHERE NOT coalesce(held, own)""")
def still_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with a good record and no address in the master, or in the record where the master lacks them."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), "user_id").alias("domain"), F.when(_failed(), "failed").alias("error"), F.when(F.col("event_type") == "purchase", F.array(F.lit("a@example.com"))).otherwise(F.array().cast("array<string>")).alias("business_emails"))
    master = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.concat(F.lit("u"), "c_custkey").alias("domain"), F.when(F.col("c_acctbal") > 5000, "a@example.com").alias("email"), F.lit("").alias("business_email"))
    return inboxes.still_empty(events, master)


@query("""WITH r AS (SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1)
SELECT c_custkey AS key, CASE WHEN user_id IS NULL THEN 'map' WHEN event_type <> 'error' THEN 'reuse' WHEN value > 10 THEN 'skip' ELSE 'unseeded' END AS route FROM customer LEFT JOIN r ON c_custkey = user_id""")
def route_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do with each site by the last record of its ranking."""
    last = ledger.last_with_failures(table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value"), "user_id", "event_id")
    records = last.select(F.col("user_id").alias("key"), F.when(_failed(), "failed").alias("error"), (F.col("value") > 10).alias("site_down"))
    return crawl.routed(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), records)


@query("""WITH c AS (SELECT c_custkey AS pos, 'n' || c_nationkey AS domain, c_name || ' Quill' AS name, CASE c_mktsegment WHEN 'BUILDING' THEN 'Director' WHEN 'MACHINERY' THEN 'Clerk' ELSE '' END AS title, CASE WHEN c_acctbal < 0 THEN 'x@example.com' ELSE '' END AS email FROM customer),
d AS (SELECT DISTINCT user_id AS pos FROM events WHERE event_type = 'signup'), s AS (SELECT *, (title <> '')::INT * 2 + (domain IN ('n1', 'n5', 'n9'))::INT + (title = 'Director')::INT * 2 AS score FROM c WHERE email = '' AND pos NOT IN (FROM d))
SELECT pos, domain, score FROM s ORDER BY score DESC, pos LIMIT 50""")
def findability_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty people without an address who are easiest to find."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pos"), F.concat(F.lit("n"), "c_nationkey").alias("domain"), F.concat("c_name", F.lit(" Quill")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Director").when(F.col("c_mktsegment") == "MACHINERY", "Clerk").otherwise("").alias("title"), F.when(F.col("c_acctbal") < 0, "x@example.com").otherwise("").alias("email"))
    context = table(spark, sf_dir, "nation").where("n_nationkey in (1, 5, 9)").select(F.concat(F.lit("n"), "n_nationkey").alias("domain"), F.lit("surgery").alias("specialty"))
    done = table(spark, sf_dir, "events").where("event_type = 'signup'").select(F.col("user_id").alias("pos"))
    return crawl.findable(rows, context, done, 50, ["pos"]).select("pos", "domain", "score")


@query("""WITH h AS (SELECT user_id AS k, event_id, 'w' || event_id || '@example.com' AS email, 'https://example.org/' || event_id AS u, CASE WHEN value > 20 THEN 'high' ELSE 'low' END AS conf FROM events WHERE event_type IN ('click', 'view') AND user_id % 2 = 0),
l AS (SELECT k, arg_max(email, event_id) AS email, arg_max(u, event_id) AS u, arg_max(conf, event_id) AS conf FROM h GROUP BY 1),
m AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 'own@example.com' ELSE '' END AS email, 'guess' || c_custkey AS best FROM customer)
SELECT m.k, m.email, l.email AS web_found_email, l.u AS web_found_source, l.conf AS web_found_confidence, CASE WHEN l.k IS NOT NULL AND m.email = '' THEN l.email ELSE best END AS best_email, CASE WHEN l.k IS NOT NULL AND m.email = '' THEN 'web-found:' || l.conf ELSE 'default:first' END AS best_email_basis FROM m LEFT JOIN l USING (k)""")
def merge_web_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searched addresses put into the master by a stable key; a published one is never replaced."""
    hits = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("k"), "event_id", F.concat(F.lit("w"), "event_id", F.lit("@example.com")).alias("email"), F.concat(F.lit("https://example.org/"), "event_id").alias("source_url"),
        F.when(F.col("event_type").isin("click", "view") & (F.col("user_id") % 2 == 0), "confirmed").otherwise("uncertain").alias("identity_match"), F.when(F.col("value") > 20, "high").otherwise("low").alias("confidence"))
    master = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") < 0, "own@example.com").otherwise("").alias("email"), F.concat(F.lit("guess"), "c_custkey").alias("best_email"), F.lit("default:first").alias("best_email_basis"))
    return crawl.merge_hits(master, hits, ["k"], "event_id")


_INBOX_SQL = """e AS (SELECT 'u' || (user_id % 97) AS domain, event_id, event_type, user_id, value FROM events),
b AS (SELECT domain, arg_max('b' || event_id || '@example.com', event_id) AS base, arg_max('https://example.com/b' || event_id, event_id) AS u FROM e WHERE event_type = 'click' GROUP BY 1),
r AS (SELECT domain, 'b' || event_id || '@example.com' AS email, 1 AS kind, event_id FROM e WHERE event_type = 'view'),
l AS (SELECT domain, 'o' || (user_id % 3) || '@example.com' AS email, 2 AS kind, event_id FROM e WHERE event_type = 'purchase'),
rel AS (SELECT domain, arg_max('r' || event_id || '@example.net', event_id) AS rel FROM e WHERE event_type = 'purchase' GROUP BY 1),
added AS (SELECT domain, email, min((kind, event_id)) AS ord FROM (FROM r UNION ALL FROM l) GROUP BY 1, 2),
listed AS (SELECT domain, base AS email, (0, 0) AS ord FROM b UNION ALL SELECT a.domain, a.email, a.ord FROM added a LEFT JOIN b USING (domain) WHERE a.email IS DISTINCT FROM base),
firsts AS (SELECT domain, string_agg(email, '; ' ORDER BY ord) AS all_emails, arg_min(email, ord) AS own, count(*) AS n FROM listed GROUP BY 1)"""


@query(f"""WITH {_INBOX_SQL} SELECT domain, own AS email, all_emails AS all_business_emails, coalesce(rel, '') AS related_email FROM firsts LEFT JOIN rel USING (domain)""")
def inbox_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inboxes of every site from three ledgers cut out of the events."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id") % 97).alias("domain"), F.lit("").alias("company"), F.lit(None).cast("string").alias("website"), F.lit(None).cast("string").alias("error"), F.col("event_id").alias("_seq"), "event_type", "user_id")
    b = F.concat(F.lit("b"), "_seq", F.lit("@example.com"))
    found = lambda kind: e.where(F.col("event_type") == kind)
    own = [F.array(b).alias("business_emails"), F.concat(F.lit("https://example.com/b"), "_seq").alias("business_email_source_url")]
    related = found("purchase").select("*", F.array(F.concat(F.lit("o"), F.col("user_id") % 3, F.lit("@example.com"))).alias("own_emails"), F.array(F.concat(F.lit("r"), "_seq", F.lit("@example.net"))).alias("related_emails"), F.create_map().cast("map<string,string>").alias("sources"))
    merged = inboxes.build_inboxes(found("click").select("*", *own), found("view").select("*", *own), related)
    return inboxes.inbox_rows(merged).select("domain", "email", "all_business_emails", "related_email")
