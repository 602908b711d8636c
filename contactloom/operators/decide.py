"""The best address of every person, what it rests on, and where it may go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.let import with_fields
from ..functions.provenance import basis_status

MOST_CANDIDATES = 18


def _filled(c: str) -> Column:
    return F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.trim(F.col(c)))


def with_domains(master: DataFrame, cache: DataFrame) -> DataFrame:
    """Master with ``confirmed`` (the business inbox's host, else the domain that takes mail) and ``win_domain``.

    ``cache`` (domain, email_domain, provider, confidence), one row for a domain: Spark broadcasts it if
    its size allows.
    """
    inbox = F.lower(F.trim(F.get(F.split(F.coalesce("business_email", F.lit("")), "[;,]"), F.lit(0))))
    host = F.get(F.split(inbox, "@"), F.lit(1))
    looked = master.join(cache.select("domain", "email_domain", "provider", "confidence"), "domain", "left")
    confirmed = F.coalesce(F.when(F.trim(host) != "", F.trim(host)), F.when(F.col("email_domain") != "", F.col("email_domain")))
    known = looked.withColumn("confirmed", confirmed)
    site = F.when((F.coalesce("domain", F.lit("")) != "") & ~F.coalesce(F.col("confidence") == "none", F.lit(False)), F.col("domain"))
    return known.withColumn("win_domain", F.coalesce("confirmed", site)).drop("email_domain", "confidence")


def decide(master: DataFrame, cache: DataFrame, patterns: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Master with best_email, basis, candidates (at most 18) and the learned pattern's source."""
    known = with_domains(master, cache).join(patterns.select("domain", "pattern", F.col("confidence").alias("_by"), F.col("source").alias("learned_source")), "domain", "left")
    known = with_fields(known, F.struct(names.name_tokens(F.col("name"), ascii_only).alias("_tokens")))
    known = known.withColumn("_fl", names.first_last(F.col("_tokens")))
    domain, flag = F.col("win_domain"), F.when(F.col("confirmed").isNull(), F.lit("(unverified-domain)")).otherwise("")
    made = F.transform(names.candidates(F.col("_fl.first"), F.col("_fl.last")), lambda c: F.concat(c["local"], F.lit("@"), domain))
    known = with_fields(known, F.struct(made.alias("_listed"), names.build_email(F.col("pattern"), F.col("_tokens"), domain).alias("_learned")))
    listed, learned = F.col("_listed"), F.col("_learned")
    hoisted = F.when(learned.isNotNull(), F.concat(F.array(learned), F.filter(listed, lambda c: c != learned))).otherwise(listed)
    pick = lambda email, basis, several: F.struct(email.alias("best_email"), basis.alias("basis"), several.alias("candidates"))
    none, nobody = F.array().cast("array<string>"), F.lit(None).cast("string")
    mono = F.concat(F.get("_tokens", F.lit(0)), F.lit("@"), domain)
    choice = (
        F.when(_filled("email").isNotNull(), pick(_filled("email"), F.lit("known"), none))
        .when(_filled("web_found_email").isNotNull(), pick(_filled("web_found_email"), F.concat(F.lit("web-found:"), F.coalesce(_filled("web_found_confidence"), F.lit("low"))), none))
        .when(domain.isNull(), pick(nobody, F.lit("no-domain"), none))
        .when(F.size("_tokens") == 0, pick(nobody, F.lit("no-name"), none))
        .when(F.size("_tokens") == 1, pick(mono, F.concat(F.lit("default:first"), flag), F.array(mono)))
        .when(learned.isNotNull(), pick(learned, F.concat(F.lit("learned:"), F.col("pattern"), F.when(F.col("_by") == "ai", "(ai)").otherwise(""), flag), F.slice(hoisted, 1, MOST_CANDIDATES)))
        .otherwise(pick(F.get(listed, F.lit(0)), F.concat(F.lit("default:first.last"), flag), F.slice(listed, 1, MOST_CANDIDATES)))
    )
    return with_fields(known, choice).drop("_tokens", "_fl", "_listed", "_learned", "_by", "pattern")


def person_rows(decided: DataFrame) -> DataFrame:
    """The people's deliverable with ``sendable``; rows without an address are left out."""
    meaning = basis_status(F.col("basis"))
    shown = names.display_name(F.col("name"))
    proof = F.when(F.col("basis") == "known", F.col("email_source_url")).when(F.startswith("basis", F.lit("web-found:")), F.col("web_found_source")).when(F.startswith("basis", F.lit("learned:")), F.col("learned_source"))
    rows = with_fields(decided.where(F.coalesce("best_email", F.lit("")) != ""), F.struct(meaning.alias("_m"), shown.alias("_d"), F.coalesce(proof, F.lit("")).alias("proof")))
    return rows.select(
        F.col("_d.first").alias("first_name"), F.col("_d.last").alias("last_name"), F.col("best_email").alias("email"), "title", "company", "domain", "website",
        F.col("_m.status").alias("status"), F.col("_m.source").alias("source"), "proof", "business_email", "all_business_emails",
        F.array_join("candidates", "; ").alias("all_predicted_emails"), F.col("_m.sendable").alias("sendable"), "basis")


def route(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ready, verify): every row goes to exactly one; what isn't surely sendable goes to verify."""
    ok = F.coalesce(F.col("sendable"), F.lit(False))
    return rows.where(ok), rows.where(~ok)


def check_routing(ready: DataFrame) -> DataFrame:
    """Rows that break the promise that only published and found addresses are sent; always none."""
    return ready.where(~((F.col("basis") == "known") | F.startswith("basis", F.lit("web-found:"))))


def run_summary(decided: DataFrame) -> DataFrame:
    """One row of counts by what addresses rest on."""
    starts = lambda p: F.count_if(F.startswith("basis", F.lit(p)))
    equals = lambda b: F.count_if(F.col("basis") == b)
    return decided.agg(
        F.count("*").alias("people"), equals("known").alias("known"), starts("web-found:").alias("web"), starts("learned:").alias("learned"),
        equals("default:first.last").alias("default_confirmed"), equals("default:first.last(unverified-domain)").alias("default_unverified"),
        F.count_if(F.col("basis").isin("default:first", "default:first(unverified-domain)")).alias("mononym"), equals("no-domain").alias("no_domain"), equals("no-name").alias("no_name"))
