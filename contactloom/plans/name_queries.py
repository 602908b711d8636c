"""Queries over names: tokens, keys, patterns, templates, candidate addresses.

Part names are two words and stand for people; the brand gives the company's domain and the type, for
the larger sizes, a mail domain of its own.  Customer names fold to one word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import permute
from ..sources.shared import spread
from .registry import query, table

HONORIFICS = ", ".join(f"'{h}'" for h in names.HONORIFICS)


def tokens_sql(column: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array(lower(strip_accents({column})), '\\s+'), lambda t: regexp_replace(t, '[^a-z]', '', 'g')), lambda t: t <> '' AND t NOT IN ({HONORIFICS}))"


def local_sql(pattern: str) -> str:
    """The local part of a pattern over columns f and l, built by hand for SQL."""
    out, rest = [], pattern
    while rest:
        for word, sql in (("first", "f"), ("last", "l"), ("fi", "f[1]"), ("li", "l[1]"), (".", "'.'")):
            if rest.startswith(word):
                out.append(sql)
                rest = rest[len(word):]
                break
    return " || ".join(out)


PEOPLE_SQL = f"""people AS (
    SELECT p_partkey, p_name, t[1] AS f, t[len(t)] AS l, len(t) AS n,
           CASE WHEN p_size > 25 THEN lower(p_type) || '.example.com' END AS email_domain,
           regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') || '.example.com' AS company_domain
    FROM (SELECT *, {tokens_sql('p_name')} AS t FROM part))"""
MADE_SQL = " UNION ALL ".join(f"SELECT p_partkey, {i} AS r, '{p}' AS pattern, {local_sql(p)} AS local FROM people WHERE n >= 2" for i, p in enumerate(names.PATTERNS))
LONG_SQL = f"""WITH {PEOPLE_SQL}, made AS ({MADE_SQL}),
kept AS (SELECT p_partkey, local, min(r) AS r, arg_min(pattern, r) AS pattern FROM made GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY r) AS rank FROM kept)"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, p_name, company_domain, email_domain) of the part table, over all cores: names are worked on, and a narrow table's file is few tasks."""
    part = spread(table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    slug = F.concat(F.regexp_replace(F.lower("p_brand"), "[^a-z0-9]", ""), F.lit(".example.com"))
    return part.select("p_partkey", "p_name", slug.alias("company_domain"), F.when(F.col("p_size") > 25, F.concat(F.lower("p_type"), F.lit(".example.com"))).alias("email_domain"))


@query(LONG_SQL + """
SELECT p_partkey, f AS first_name, l AS last_name, coalesce(email_domain, company_domain) AS domain,
       CASE WHEN email_domain IS NULL THEN 'company_domain' ELSE 'email_domain' END AS domain_source,
       CAST(rank AS INTEGER) AS rank, pattern, local || '@' || coalesce(email_domain, company_domain) AS email
FROM ranked JOIN people USING (p_partkey)""")
def permute_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each candidate address, ranks without gaps from 1."""
    return permute.long_table(people(spark, sf_dir), ["p_partkey"], "p_name", ascii_only=True)


@query(LONG_SQL + " SELECT p_partkey, p_name, " + ", ".join(f"max(CASE WHEN rank = {k} THEN local || '@' || coalesce(email_domain, company_domain) END) AS email_{k}" for k in range(1, 19)) + """
FROM people LEFT JOIN ranked USING (p_partkey) GROUP BY 1, 2""")
def permute_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each person with email_1 to email_18."""
    return permute.wide_table(people(spark, sf_dir), ["p_partkey", "p_name"], "p_name", ascii_only=True)


@query(f"""WITH {PEOPLE_SQL}, made AS ({MADE_SQL}), c AS (SELECT count(DISTINCT (p_partkey, local)) AS candidates_out FROM made)
SELECT (SELECT count(*) FROM part) + (SELECT count(*) FROM customer) AS rows_in, (SELECT count(*) FROM customer WHERE c_mktsegment = 'HOUSEHOLD') AS skipped_domain,
       (SELECT count(*) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') AS skipped_name, candidates_out FROM c""")
def permute_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, rows skipped for want of a domain (looked at first) or of a name, candidates out; the customers add rows of both kinds."""
    customers = table(spark, sf_dir, "customer", "c_name", "c_mktsegment").select(
        F.col("c_name").alias("name"), F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.concat(F.lower("c_mktsegment"), F.lit(".example.com"))).alias("company_domain"), F.lit("").alias("email_domain"))
    rows = people(spark, sf_dir).select(F.col("p_name").alias("name"), "company_domain", "email_domain").unionByName(customers)
    return permute.counters(rows, "name", ascii_only=True)


@query(f"""SELECT 'part' AS kind, p_partkey AS id, array_to_string({tokens_sql('p_name')}, ' ') AS tokens FROM part
UNION ALL SELECT 'customer', c_custkey, array_to_string({tokens_sql('c_name')}, ' ') FROM customer
UNION ALL SELECT 'document', doc_id, array_to_string({tokens_sql('text')}, ' ') FROM documents""")
def name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded tokens of part and customer names, and of whole texts, which are full of accents."""
    part = table(spark, sf_dir, "part", "p_partkey", "p_name").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_name").select(F.lit("customer"), "c_custkey", "c_name")
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(F.lit("document"), "doc_id", "text")
    return part.union(customer).union(docs).select("kind", "id", F.array_join(names.name_tokens(F.col("name")), " ").alias("tokens"))


_SHOWN = "'Dr. ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' van der ' || p_type ELSE '' END"
_WORDS = f"list_filter(regexp_split_to_array({_SHOWN}, '\\s+'), lambda t: t <> '' AND regexp_replace(lower(t), '[^a-z]', '', 'g') NOT IN ({HONORIFICS}))"


def _shown() -> F.Column:
    return F.concat(F.lit("Dr. "), "p_name", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" van der "), "p_type")).otherwise(""))


@query(f"SELECT p_partkey, w[1] AS first_name, array_to_string(w[2:], ' ') AS last_name FROM (SELECT p_partkey, {_WORDS} AS w FROM part)")
def display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as people read them: the title goes, particles and case stay."""
    return table(spark, sf_dir, "part").select("p_partkey", names.display_name(_shown()).alias("d")).select("p_partkey", F.col("d.first").alias("first_name"), F.col("d.last").alias("last_name"))


@query("""SELECT c_custkey, trim(regexp_replace(regexp_replace(lower('O''' || c_name || '  Jr.'), '[^\\p{L}\\p{N}\\s]', '', 'g'), '\\s+', ' ', 'g')) AS person_key,
       lower(c_mktsegment) || '.example.com::' || trim(regexp_replace(lower('O''' || c_name || '  Jr.'), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS master_key FROM customer""")
def person_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two keys of a person: punctuation deleted for extraction, a space in the master."""
    name = F.concat(F.lit("O'"), "c_name", F.lit("  Jr."))
    return table(spark, sf_dir, "customer").select("c_custkey", names.person_key(name).alias("person_key"), names.master_key(F.concat(F.lower("c_mktsegment"), F.lit(".example.com")), name).alias("master_key"))


_TEMPLATES = ("{first}.{last}", "{fi}{last}", "{last}_{first}", "x-{li}.{first}", "{first}", "no-placeholder", "{middle}", "{first} {last}")


@query(f"""WITH {PEOPLE_SQL}, t(template) AS (VALUES {', '.join(f"('{t}')" for t in _TEMPLATES)})
SELECT p_partkey, template, CASE WHEN template IN ('no-placeholder', '{{middle}}', '{{first}} {{last}}') THEN NULL
  ELSE replace(replace(replace(replace(template, '{{first}}', f), '{{last}}', l), '{{fi}}', f[1]), '{{li}}', l[1]) || '@' || company_domain END AS email
FROM people, t WHERE n >= 2""")
def template_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses from templates, valid and not; an invalid template gives null."""
    rows = people(spark, sf_dir).withColumn("template", F.explode(F.array(*map(F.lit, _TEMPLATES))))
    return rows.select("p_partkey", "template", names.build_email(F.when(F.col("template").contains("{"), F.col("template")), names.name_tokens(F.col("p_name"), True), F.col("company_domain")).alias("email"))


_TEMPLATE_OF = ", ".join(f"({i}, '{p}', '" + p.replace("first", "[A]").replace("last", "[B]").replace("fi", "{fi}").replace("li", "{li}").replace("[A]", "{first}").replace("[B]", "{last}") + "')" for i, p in enumerate(names.PATTERNS))


@query(f"""SELECT p_partkey, pattern, template, p_partkey % 3 <> 0 AS usable FROM part JOIN (VALUES {_TEMPLATE_OF}) v(i, pattern, template) ON p_partkey % {len(names.PATTERNS)} = i""")
def canonical_to_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A canonical pattern for every part, as a template; a third of them get a character that no template may have."""
    pattern = F.get(F.array(*map(F.lit, names.PATTERNS)), (F.col("p_partkey") % len(names.PATTERNS)).cast("int"))
    rows = table(spark, sf_dir, "part", "p_partkey").withColumn("pattern", pattern).withColumn("template", names.template_of(F.col("pattern")))
    marred = F.when(F.col("p_partkey") % 3 == 0, F.concat("template", F.lit("!"))).otherwise(F.col("template"))
    return rows.select("p_partkey", "pattern", "template", names.is_template(marred).alias("usable"))
