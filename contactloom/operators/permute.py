"""Candidate addresses as tables: long, wide, and the counters of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.let import with_fields


def _domain(company: str, mail: str) -> Column:
    """(domain, source): the mail domain where there is one, else the company's; null for neither."""
    given = lambda c: F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.lower(F.trim(F.col(c))))
    return F.when(given(mail).isNotNull(), F.struct(given(mail).alias("domain"), F.lit("email_domain").alias("source"))).when(
        given(company).isNotNull(), F.struct(given(company).alias("domain"), F.lit("company_domain").alias("source")))


def with_candidates(rows: DataFrame, name: str, company: str = "company_domain", mail: str = "email_domain", limit: int = len(names.PATTERNS), ascii_only: bool = False) -> DataFrame:
    """``rows`` with ``_d`` (domain, source), ``_fl`` (first, last) and ``_list``: (local, pattern) in rank order, empty where a part is missing."""
    if limit < 1:
        raise ValueError("limit must be a positive number")
    split = _split(rows, name, company, mail, ascii_only)
    made = names.candidates(F.col("_fl.first"), F.col("_fl.last"), limit)
    return with_fields(split, F.struct(F.when(F.col("_d").isNotNull() & F.col("_fl").isNotNull(), made).otherwise(F.array().cast("array<struct<local:string,pattern:string>>")).alias("_list")))


def _split(rows: DataFrame, name: str, company: str = "company_domain", mail: str = "email_domain", ascii_only: bool = False) -> DataFrame:
    """``rows`` with ``_d`` and ``_fl``.  Worked out once for each row: a generator's fields are not merged into what reads them."""
    return with_fields(rows, F.struct(_domain(company, mail).alias("_d"), names.first_last(names.name_tokens(F.col(name), ascii_only)).alias("_fl")))


def _address(c: Column) -> Column:
    return F.concat(c["local"], F.lit("@"), F.col("_d.domain"))


def long_table(rows: DataFrame, ids: list[str], name: str, **options) -> DataFrame:
    """(ids, first_name, last_name, domain, domain_source, rank, pattern, email): a row for each candidate.

    Rows without a domain or without two name tokens give none; repeated rows give theirs each.
    """
    made = with_candidates(rows, name, **options).select(*ids, "_d", "_fl", F.posexplode("_list").alias("_at", "_c"))
    return made.select(
        *ids, F.col("_fl.first").alias("first_name"), F.col("_fl.last").alias("last_name"), F.col("_d.domain").alias("domain"), F.col("_d.source").alias("domain_source"),
        (F.col("_at") + 1).alias("rank"), F.col("_c.pattern").alias("pattern"), _address(F.col("_c")).alias("email"))


def wide_table(rows: DataFrame, keep: list[str], name: str, limit: int = len(names.PATTERNS), **options) -> DataFrame:
    """``keep`` and email_1 to email_N for every row; no shuffle, the candidates are an array of the row."""
    if limit < 1:
        raise ValueError("limit must be a positive number")
    split = _split(rows, name, **options)
    made = with_fields(split, F.struct(F.when(F.col("_d").isNotNull() & F.col("_fl").isNotNull(), names.local_parts(F.col("_fl.first"), F.col("_fl.last"), limit)).alias("_locals")))
    return made.select(*keep, *[F.concat(F.get("_locals", F.lit(k)), F.lit("@"), F.col("_d.domain")).alias(f"email_{k + 1}") for k in range(limit)])


def counters(rows: DataFrame, name: str, **options) -> DataFrame:
    """One row: rows_in, skipped_domain (looked at first), skipped_name, candidates_out."""
    made = with_candidates(rows, name, **options)
    return made.agg(
        F.count("*").alias("rows_in"), F.count_if(F.col("_d").isNull()).alias("skipped_domain"), F.count_if(F.col("_d").isNotNull() & F.col("_fl").isNull()).alias("skipped_name"),
        F.coalesce(F.sum(F.size("_list")), F.lit(0)).alias("candidates_out"))
