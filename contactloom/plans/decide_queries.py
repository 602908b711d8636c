"""Queries over decisions: bases, learned formats, mail domains, routing, summaries.

Customers are the people here.  Their nation is the company; every third nation takes no mail, every
third has a confirmed mail domain, and the others were never looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, provenance
from ..operators import crawl, decide, domains, ledger, patterns
from ..streaming import resume
from .name_queries import MADE_SQL, PEOPLE_SQL, people
from .registry import query, table

_BASES = ("known", "web-found:high", "web-found:", "learned:first.last", "learned:filast(unverified-domain)(ai)", "learned:{fi}_{last}(ai)", "default:first.last", "default:first(unverified-domain)", "no-domain", "no-name", "mystery", "")
_MEANING = """CASE WHEN b = 'known' THEN ['Ready to send', 'Published on their website', 'true']
 WHEN b LIKE 'web-found:%' THEN ['Ready to send', 'Found on the web (' || CASE WHEN b = 'web-found:' THEN 'low' ELSE b[11:] END || ' confidence)', 'true']
 WHEN b LIKE 'learned:%' THEN ['Needs verification', 'Matches this company''s email format' || CASE WHEN b LIKE '%(ai)%' THEN ' (AI-judged)' ELSE '' END || CASE WHEN b LIKE '%(unverified-domain)%' THEN ' — mail domain not confirmed' ELSE '' END, 'false']
 WHEN b LIKE 'default:%' THEN ['Needs verification', 'Predicted — mail domain ' || CASE WHEN b LIKE '%(unverified-domain)%' THEN 'not ' ELSE '' END || 'confirmed', 'false']
 WHEN b = 'no-domain' THEN ['', 'No mail domain — nothing to send to', 'false'] WHEN b = 'no-name' THEN ['', 'No usable name — could not predict an address', 'false']
 ELSE ['Needs verification', CASE WHEN b = '' THEN 'Unknown' ELSE b END, 'false'] END"""


@query(f"""WITH b(i, b) AS (VALUES {', '.join(f"({i}, '{b}')" for i, b in enumerate(_BASES))}), m AS (SELECT p_partkey, b, {_MEANING} AS m FROM part JOIN b ON i = p_partkey % {len(_BASES)})
SELECT p_partkey, b AS basis, m[1] AS status, m[2] AS source, m[3] = 'true' AS sendable FROM m""")
def basis_to_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every basis of the vocabulary means, and two that aren't in it."""
    basis = F.element_at(F.array(*map(F.lit, _BASES)), (F.col("p_partkey") % len(_BASES)).cast("int") + 1)
    return table(spark, sf_dir, "part").select("p_partkey", basis.alias("basis")).withColumn("m", provenance.basis_status(F.col("basis"))).select("p_partkey", "basis", "m.*")


_PEOPLE_SQL = """master AS (SELECT c_custkey AS id, c_nationkey AS nk, 'nation' || c_nationkey || '.example.com' AS domain,
    CASE WHEN c_custkey % 13 = 0 THEN '—' WHEN c_custkey % 7 = 0 THEN c_name ELSE (['Ada', 'Ben', 'Cleo', 'Dan', 'Eva'])[1 + c_custkey % 5] || ' ' || (['Quill', 'Ash', 'Birch', 'Cole'])[1 + c_custkey % 4] END AS name,
    CASE WHEN c_custkey % 17 = 0 THEN 'real' || c_custkey || '@example.com' ELSE '' END AS email, CASE WHEN c_custkey % 11 = 0 THEN 'web' || c_custkey || '@example.org' END AS web, CASE WHEN c_custkey % 22 = 0 THEN 'high' END AS conf,
    CASE WHEN c_nationkey = 4 THEN 'info@mail4.example.com' ELSE '' END AS business FROM customer),
looked AS (SELECT *, CASE WHEN business <> '' THEN 'mail4.example.com' WHEN nk % 3 = 1 THEN domain END AS confirmed, nk % 3 = 0 AS dead FROM master),
told AS (SELECT *, coalesce(confirmed, CASE WHEN NOT dead THEN domain END) AS win, CASE WHEN confirmed IS NULL THEN '(unverified-domain)' ELSE '' END AS flag,
    CASE WHEN name = '—' THEN 0 WHEN name LIKE 'Customer%' THEN 1 ELSE 2 END AS n, lower(split_part(name, ' ', 1)) AS f, lower(split_part(name, ' ', 2)) AS l,
    CASE nk WHEN 1 THEN 'filast' WHEN 2 THEN '{last}_{fi}' WHEN 5 THEN 'first' END AS pattern, nk = 2 AS ai FROM looked),
made AS (SELECT *, CASE pattern WHEN 'filast' THEN f[1] || l WHEN '{last}_{fi}' THEN l || '_' || f[1] WHEN 'first' THEN f END AS local FROM told),
decided AS (SELECT *, CASE WHEN email <> '' THEN email WHEN web IS NOT NULL THEN web WHEN win IS NULL OR n = 0 THEN NULL WHEN n = 1 THEN 'customer@' || win WHEN local IS NOT NULL THEN local || '@' || win ELSE f || '.' || l || '@' || win END AS best_email,
    CASE WHEN email <> '' THEN 'known' WHEN web IS NOT NULL THEN 'web-found:' || coalesce(conf, 'low') WHEN win IS NULL THEN 'no-domain' WHEN n = 0 THEN 'no-name' WHEN n = 1 THEN 'default:first' || flag
         WHEN local IS NOT NULL THEN 'learned:' || pattern || CASE WHEN ai THEN '(ai)' ELSE '' END || flag ELSE 'default:first.last' || flag END AS basis FROM made)"""


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    pick = lambda words, n: F.element_at(F.array(*map(F.lit, words)), (k % n).cast("int") + 1)
    name = F.when(k % 13 == 0, "—").when(k % 7 == 0, F.col("c_name")).otherwise(F.concat_ws(" ", pick(("Ada", "Ben", "Cleo", "Dan", "Eva"), 5), pick(("Quill", "Ash", "Birch", "Cole"), 4)))
    domain = F.concat(F.lit("nation"), nk, F.lit(".example.com"))
    master = table(spark, sf_dir, "customer").select(
        k.alias("id"), domain.alias("domain"), name.alias("name"), F.col("c_mktsegment").alias("title"), F.concat(F.lit("Nation "), nk).alias("company"), F.concat(F.lit("https://"), domain).alias("website"),
        F.when(k % 17 == 0, F.concat(F.lit("real"), k, F.lit("@example.com"))).otherwise("").alias("email"), F.concat(F.lit("https://example.com/"), k).alias("email_source_url"),
        F.when(k % 11 == 0, F.concat(F.lit("web"), k, F.lit("@example.org"))).alias("web_found_email"), F.when(k % 11 == 0, F.concat(F.lit("https://example.org/"), k)).alias("web_found_source"), F.when(k % 22 == 0, "high").alias("web_found_confidence"),
        F.when(nk == 4, "info@mail4.example.com").otherwise("").alias("business_email"), F.lit("").alias("all_business_emails"))
    n = F.col("n_nationkey")
    known = table(spark, sf_dir, "nation").select(F.concat(F.lit("nation"), n, F.lit(".example.com")).alias("domain"), n)
    cache = known.where("n_nationkey % 3 != 2").select("domain", F.when(n % 3 == 1, F.col("domain")).alias("email_domain"), F.lit("other/self-hosted").alias("provider"), F.when(n % 3 == 0, "none").otherwise("high").alias("confidence"))
    store = known.where("n_nationkey in (1, 2, 5)").select("domain", F.when(n == 1, "filast").when(n == 2, "{last}_{fi}").otherwise("first").alias("pattern"), F.when(n == 2, "ai").otherwise("deterministic").alias("confidence"), F.concat(F.lit("proof@"), "domain").alias("source"))
    return decide.decide(master, cache, store)


@query(f"WITH {_PEOPLE_SQL} SELECT id, best_email, basis FROM decided")
def best_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best address of every person and what it rests on."""
    return _decided(spark, sf_dir).select("id", "best_email", "basis")


@query(f"""WITH {_PEOPLE_SQL} SELECT id, basis, CASE WHEN basis NOT LIKE 'learned:%' THEN 1 WHEN pattern IN ('first', 'filast') THEN d ELSE least(18, d + 1) END AS n_candidates FROM
(SELECT *, CASE WHEN f[1] = l[1] THEN 16 ELSE 18 END AS d FROM decided) WHERE basis LIKE 'learned:%' OR basis LIKE 'default:first(%' OR basis = 'default:first'""")
def candidate_surgery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many candidates people with a learned format or one name have: the learned one leads, at most 18 stay."""
    rows = _decided(spark, sf_dir).where("basis like 'learned:%' or basis in ('default:first', 'default:first(unverified-domain)')")
    return rows.select("id", "basis", F.size("candidates").alias("n_candidates"))


@query(f"WITH {_PEOPLE_SQL} SELECT id, 'no-mail-name' AS why FROM decided WHERE basis IN ('no-domain', 'no-name')")
def without_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People for whom no address can be predicted."""
    return _decided(spark, sf_dir).where("best_email is null").select("id", F.lit("no-mail-name").alias("why"))


@query(f"""WITH {_PEOPLE_SQL} SELECT CASE WHEN n = 0 THEN '—' ELSE split_part(name, ' ', 1) END AS first_name, best_email AS email, CASE WHEN basis = 'known' OR basis LIKE 'web-found:%' THEN 'ready' ELSE 'verify' END AS output,
    CASE WHEN basis = 'known' THEN 'https://example.com/' || id WHEN basis LIKE 'web-found:%' THEN 'https://example.org/' || id WHEN basis LIKE 'learned:%' THEN 'proof@' || domain ELSE '' END AS proof FROM decided WHERE best_email IS NOT NULL""")
def route_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every person with an address in exactly one of the two outputs, with the proof."""
    ready, verify = decide.route(decide.person_rows(_decided(spark, sf_dir)))
    return ready.withColumn("output", F.lit("ready")).unionByName(verify.withColumn("output", F.lit("verify"))).select("first_name", "email", "output", "proof")


@query(f"WITH {_PEOPLE_SQL} SELECT count(*) AS n_ready, 0 AS n_broken FROM decided WHERE basis = 'known' OR basis LIKE 'web-found:%'")
def route_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows are ready to send, and how many of them break the promise about predictions."""
    ready, _ = decide.route(decide.person_rows(_decided(spark, sf_dir)))
    broken = decide.check_routing(ready).agg(F.count("*").alias("n_broken"))
    return ready.agg(F.count("*").alias("n_ready")).join(F.broadcast(broken), F.lit(True)).select("n_ready", F.col("n_broken").cast("int").alias("n_broken"))


@query(f"""WITH {_PEOPLE_SQL} SELECT count(*) AS people, count_if(basis = 'known') AS known, count_if(basis LIKE 'web-found:%') AS web, count_if(basis LIKE 'learned:%') AS learned, count_if(basis = 'default:first.last') AS default_confirmed,
    count_if(basis = 'default:first.last(unverified-domain)') AS default_unverified, count_if(basis IN ('default:first', 'default:first(unverified-domain)')) AS mononym, count_if(basis = 'no-domain') AS no_domain, count_if(basis = 'no-name') AS no_name FROM decided""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of people by what their address rests on."""
    return decide.run_summary(_decided(spark, sf_dir))


@query("SELECT c_custkey, 'customer@n' || c_nationkey || '.example.com' AS best_email, 'default:first(unverified-domain)' AS basis FROM customer")
def mononym_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of one name get that name at a domain that was never looked up."""
    none = F.lit(None).cast("string")
    master = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("n"), "c_nationkey", F.lit(".example.com")).alias("domain"), F.col("c_name").alias("name"), *[none.alias(c) for c in ("email", "web_found_email", "web_found_confidence", "business_email")])
    cache = spark.createDataFrame([], "domain string, email_domain string, provider string, confidence string")
    store = spark.createDataFrame([], "domain string, pattern string, confidence string, source string")
    return decide.decide(master, cache, store).select("c_custkey", "best_email", "basis")


_LEARN_SQL = f"""WITH {PEOPLE_SQL}, made AS ({MADE_SQL}),
given AS (SELECT company_domain AS domain, p_partkey AS pos, m.local FROM people JOIN made m USING (p_partkey) WHERE p_partkey % 3 = 0 AND r = (length(company_domain) + p_partkey // 3) % 4),
evidence AS (SELECT domain, local, min(pos) AS pos FROM given GROUP BY 1, 2),
hits AS (SELECT e.domain, m.pattern, m.r, e.pos AS email_pos, p_partkey AS name_pos, e.local FROM made m JOIN people USING (p_partkey) JOIN evidence e ON e.domain = company_domain AND e.local = m.local),
votes AS (SELECT domain, pattern, r, count(*) AS votes, min((email_pos, name_pos, r)) AS first FROM hits GROUP BY 1, 2, 3),
best AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY votes DESC, first) AS n FROM votes)"""


def _evidence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = people(spark, sf_dir).select(F.col("company_domain").alias("domain"), F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"))
    split = names.first_last(names.name_tokens(F.col("name"), True))
    some = rows.where("pos % 3 = 0").withColumn("n", split)
    local = F.element_at(F.array(*[names.local_part(p, F.col("n.first"), F.col("n.last")) for p in names.PATTERNS[:4]]), ((F.length("domain") + F.floor(F.col("pos") / 3)) % 4 + 1).cast("int"))
    emails = some.select("domain", F.concat(local, F.lit("@"), "domain").alias("email"), "pos").groupBy("domain", "email").agg(F.min("pos").alias("pos"))
    return rows, emails


@query(_LEARN_SQL + " SELECT domain, pattern, votes, (SELECT arg_min(local, pos) FROM evidence e WHERE e.domain = best.domain) || '@' || domain AS source FROM best WHERE n = 1")
def learn_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address format of every brand by votes of its names and its published addresses."""
    rows, emails = _evidence(spark, sf_dir)
    return patterns.learn_patterns(rows, emails, ascii_only=True).select("domain", "pattern", "votes", "source")


@query(_LEARN_SQL + " SELECT pattern, 'deterministic' AS confidence, count(*) AS n FROM best WHERE n = 1 GROUP BY 1")
def pattern_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many brands have each format."""
    rows, emails = _evidence(spark, sf_dir)
    return patterns.distribution(patterns.learn_patterns(rows, emails, ascii_only=True))


@query(_LEARN_SQL + """, proposed(template, r) AS (VALUES ('{first}.{last}', 0), ('{first}{last}', 1)), proof AS (SELECT h.domain, template, arg_min(h.local, email_pos) AS local FROM hits h JOIN proposed USING (r) GROUP BY 1, 2)
SELECT domain, template AS pattern, local || '@' || domain AS source FROM proof""")
def proof_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposed formats that reproduce a published address; those that reproduce none are refused."""
    rows, emails = _evidence(spark, sf_dir)
    proposed = rows.select("domain").distinct().select("domain", F.explode(F.array(*map(F.lit, ("{first}.{last}", "{first}{last}", "x-{first}", "nothing")))).alias("pattern"))
    return patterns.proof_gate(proposed, rows, emails, ascii_only=True)


@query(_LEARN_SQL + """, prior AS (SELECT DISTINCT company_domain AS domain FROM people UNION ALL SELECT 'old.example.org')
SELECT domain, coalesce(b.pattern, 'last') AS pattern FROM prior LEFT JOIN (SELECT domain, pattern FROM best WHERE n = 1 AND votes % 2 = 0) b USING (domain)""")
def store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored formats with those learned now in their place."""
    rows, emails = _evidence(spark, sf_dir)
    learned = patterns.learn_patterns(rows, emails, ascii_only=True).where("votes % 2 = 0").select("domain", "pattern")
    prior = rows.select("domain").distinct().union(spark.range(1).select(F.lit("old.example.org"))).withColumn("pattern", F.lit("last"))
    return patterns.upsert_store(prior, learned)


_HOSTS = ("aspmx.l.google.com", "mx1.mail.protection.outlook.com", "mail.example.net", "mx.zoho.com.", "in1-smtp.messagingengine.com", "smtp.secureserver.net")
_MX_SQL = f"""targets AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 9 = 8 THEN 'not a host' ELSE (['https://www.', 'WWW2.', ''])[1 + s_suppkey % 3] || 'S' || s_suppkey || '.example.com' || (['/team?x=1', '.', ':8080'])[1 + s_suppkey % 3] END AS raw FROM supplier),
hosts AS (SELECT k, CASE WHEN k % 9 <> 8 THEN 's' || k || '.example.com' END AS domain, k % 7 AS m, {list(_HOSTS)}[1 + k % 6] AS top, {list(_HOSTS)}[1 + (k + 1) % 6] AS second FROM targets),
told AS (SELECT *, CASE WHEN domain IS NULL THEN 'invalid' WHEN m = 0 THEN 'error' WHEN m = 1 THEN 'none' END AS bad,
  list_filter(list_transform([top, second], lambda h: CASE WHEN h LIKE '%google%' THEN 'Google Workspace' WHEN h LIKE '%outlook%' THEN 'Microsoft 365' WHEN h LIKE '%zoho%' THEN 'Zoho' WHEN h LIKE '%messagingengine%' THEN 'Fastmail' WHEN h LIKE '%secureserver%' THEN 'GoDaddy' END), lambda p: p IS NOT NULL)[1] AS p FROM hosts)"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    pick = lambda words, at: F.element_at(F.array(*map(F.lit, words)), at.cast("int") + 1)
    rows = table(spark, sf_dir, "supplier").select(k, F.when(k % 9 == 8, "not a host").otherwise(F.concat(pick(("https://www.", "WWW2.", ""), k % 3), F.lit("S"), k, F.lit(".example.com"), pick(("/team?x=1", ".", ":8080"), k % 3))).alias("raw"))
    domain = F.concat(F.lit("s"), k, F.lit(".example.com")).alias("domain")
    both = F.explode(F.array(F.struct(F.lit(10).alias("priority"), pick(_HOSTS, k % 6).alias("exchange")), F.struct(F.lit(20).alias("priority"), pick(_HOSTS, (k + 1) % 6).alias("exchange"))))
    records = rows.where(k % 7 > 1).select(domain, both.alias("r")).select("domain", "r.*", F.lit("NOERROR").alias("rcode"))
    empty = rows.where(k % 7 == 1).select(domain, F.lit(None).cast("int").alias("priority"), F.lit(None).cast("string").alias("exchange"), F.lit("NXDOMAIN").alias("rcode"))
    return domains.resolve_domains(rows, records.union(empty))


@query(f"""WITH {_MX_SQL} SELECT raw, domain, CASE WHEN bad IS NULL THEN domain END AS email_domain, CASE WHEN bad IS NULL THEN coalesce(p, 'other/self-hosted') END AS provider, CASE WHEN bad IS NULL THEN true WHEN bad = 'none' THEN false END AS has_mx,
  coalesce(bad, CASE WHEN p IS NULL THEN 'medium' ELSE 'high' END) AS confidence, CASE WHEN bad IS NULL THEN top || ' | ' || second ELSE '' END AS mx,
  CASE bad WHEN 'invalid' THEN 'unparseable-domain' WHEN 'error' THEN 'lookup-failed' WHEN 'none' THEN 'no-mx' ELSE CASE WHEN p IS NULL THEN 'mx-present' ELSE 'provider-mx:' || p END END AS signal FROM told JOIN targets USING (k)""")
def resolve_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail domain, provider and confidence of suppliers' sites from recorded lookups."""
    return _resolved(spark, sf_dir).withColumn("mx", F.array_join(F.slice("mx", 1, 3), " | "))


@query(f"WITH {_MX_SQL} SELECT coalesce(bad, CASE WHEN p IS NULL THEN 'medium' ELSE 'high' END) AS confidence, count(*) AS n FROM told GROUP BY 1")
def domain_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many domains have each confidence."""
    return ledger.histogram(_resolved(spark, sf_dir), "confidence")


@query("""WITH a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS entry FROM conversations),
c AS (SELECT conv_id, turn, entry, (turn * 37 + conv_id * 11) % 101 AS score, (['directory', 'profile', 'other'])[1 + (turn + conv_id) % 3] AS kind FROM a),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM c) WHERE n <= 3)
SELECT 'c' || conv_id AS key, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY CASE kind WHEN 'directory' THEN 0 WHEN 'profile' THEN 2 ELSE 1 END, score DESC, turn) AS INTEGER) AS rank, 'https://example.com/' || turn AS url, kind, CAST(score AS INTEGER) AS score FROM t""")
def rank_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's choices by index, ordered; conversations stand for sites and turns for pages, and one index is invented."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn")
    key = F.concat(F.lit("c"), "conv_id").alias("key")
    listed = rows.select(key, (F.col("turn") + 1).cast("int").alias("entry"), F.concat(F.lit("https://example.com/"), "turn").alias("url"), F.lit(None).cast("string").alias("title"))
    answers = rows.select(key, F.col("turn").alias("said"), F.col("turn").cast("int").alias("index"), ((F.col("turn") * 37 + F.col("conv_id") * 11) % 101).cast("double").alias("score"), F.lit("names staff").alias("reason"), F.element_at(F.array(*map(F.lit, ("directory", "profile", "other"))), ((F.col("turn") + F.col("conv_id")) % 3 + 1).cast("int")).alias("kind"))
    invented = answers.withColumn("index", F.lit(-7))
    return crawl.ranked_candidates(listed, answers.union(invented), top=3).select("key", "rank", "url", "kind", "score")


@query("SELECT user_id, count(*) AS n_events, max(event_id) AS last_event FROM events WHERE event_type <> 'error' GROUP BY 1")
def resume_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest good record of every user by an incremental run over the events, started twice: the second finds nothing new."""
    return resume.resumed_summary(spark, sf_dir, "events.parquet")


@query(_LEARN_SQL + " SELECT DISTINCT domain, local || '@' || domain AS email FROM hits")
def matched_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published addresses that some name and format give."""
    rows, emails = _evidence(spark, sf_dir)
    return patterns.matched_evidence(rows, emails, ascii_only=True).select("domain", "email")


@query(f"""WITH {_MX_SQL} SELECT s_name AS company, domain, CASE WHEN bad IS NULL THEN domain END AS email_domain, coalesce(bad, CASE WHEN p IS NULL THEN 'medium' ELSE 'high' END) AS confidence FROM told JOIN supplier ON k = s_suppkey WHERE domain IS NOT NULL""")
def domain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mail domain of every supplier that was looked up."""
    targets = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey", F.lit(".example.com")).alias("key"), F.col("s_name").alias("company"))
    return domains.domain_report(targets, _resolved(spark, sf_dir)).drop("provider")


@query(f"""WITH {_MX_SQL}, bare AS (SELECT told.* FROM told JOIN supplier ON k = s_suppkey WHERE domain IS NOT NULL AND s_acctbal <= 5000)
SELECT count(*) AS without_email, count_if(bad IS NULL) AS predictable, count_if(bad = 'none') AS dead FROM bare""")
def predictable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' domains without an address, and how many of them take mail or are dead."""
    k = F.col("s_suppkey")
    master = table(spark, sf_dir, "supplier").where(k % 9 != 8).select(F.concat(F.lit("s"), k, F.lit(".example.com")).alias("domain"), F.when(F.col("s_acctbal") > 5000, "a@example.com").alias("email"), F.lit("").alias("business_email"))
    return domains.predictable_counts(master, _resolved(spark, sf_dir))
