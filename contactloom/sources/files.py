"""CSV tables, JSON-lines ledgers, pattern stores and versioned tables."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructType

from ..functions.provenance import redact
from ..operators.ledger import latest_per_key
from . import commits, quoted
from .shared import exists

MASTER = ("company", "domain", "website", "name", "title", "email", "email_source_url", "updated_at")
STORE = "domain string, pattern string, confidence string, source string, evidence array<string>"
SEQUENCE = "struct<run:long,written:timestamp,file:string,split:long,at:long>"
PATTERN = "struct<pattern:string,confidence:string,source:string,evidence:array<string>>"


#: A row's place: its file, the split's start in it, and a number that rises within a split.
def _place() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))


def _opens_cells(spark: SparkSession, path: str) -> bool:
    """Whether any line leaves a quote open, so that a cell goes on in the next line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None, split_bytes: int | None = None) -> DataFrame:
    """A CSV table, every column a string, with ``_pos`` in file order; rows of blank cells are left out.

    Quotes are doubled inside quoted cells; a byte order mark, CRLF line ends and short rows are read.
    Files are split among tasks in any case: where a line leaves a quote open, ``quoted`` finds the rows, which are
    then written once.  ``multi_line`` says whether there are such cells, where that is known; ``split_bytes`` bounds their splits.
    """
    multi_line = _opens_cells(spark, path) if multi_line is None else multi_line
    df = spark.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE", inferSchema=False)
    # Reading lines as rows, Spark says what the header's cells are; it needs the first row only.
    df = quoted.read(spark, path, df.columns, split_bytes) if multi_line else df.withColumn("_pos", _place())
    names = [c for c in df.columns if c != "_pos"]
    blank = reduce(Column.__and__, (F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))) == "" for c in names))
    cells = [F.regexp_replace(F.col(f"`{c}`"), r"\r\n?", "\n").alias(c.replace("﻿", "").strip("\r")) for c in names]
    return df.where(~blank).select(*cells, "_pos")


def read_master(spark: SparkSession, path: str, base_only: bool = False) -> DataFrame:
    """The master table; a missing one is an error.  ``base_only``: the eight base columns, last row of a person, rows without domain or name dropped."""
    if not exists(spark, path):
        raise FileNotFoundError(f"there is no master table at {path}; run the extraction first")
    df = read_csv(spark, path)
    missing = [c for c in ("domain", "name") if c not in df.columns]
    if missing:
        raise ValueError(f"the master lacks {missing}")
    if not base_only:
        return df
    rows = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in MASTER], "_pos").where("domain != '' and name != ''")
    return latest_per_key(rows.withColumn("_key", F.concat_ws("::", "domain", F.lower("name"))), "_key", "_pos").drop("_key")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with quotes only where a cell needs them; arrays joined by "; ", nulls as empty cells."""
    cells = [F.array_join(c, "; ").alias(c) if isinstance(df.schema[c].dataType, ArrayType) else F.col(f"`{c}`") for c in df.columns if not c.startswith("_")]
    df.select(*cells).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="")


def write_master(df: DataFrame, path: str) -> None:
    """The base columns by company, then name, in the order of a reader's language."""
    write_csv(df.select(*MASTER).orderBy(F.collate("company", "UNICODE"), F.collate("name", "UNICODE")), path)


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON-lines ledger with ``_seq`` in the order of appends; no file gives no records, torn lines are passed over.

    Records that ``append_ledger`` wrote are ordered by their run and their place in it, whatever the files' names
    and sizes; records from elsewhere stand before them, by age of the file, then by place.
    """
    whole = StructType.fromDDL(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], whole).withColumn("_seq", F.lit(None).cast(SEQUENCE))
    read = StructType(whole.fields).add("_run", LongType()).add("_at", LongType()).add("_torn", StringType())
    lines = spark.read.schema(read).option("columnNameOfCorruptRecord", "_torn").json(path)
    foreign = F.col("_run").isNull()
    place = [F.when(foreign, F.col(f"_metadata.{c}")) for c in ("file_modification_time", "file_path", "file_block_start")]
    seq = F.struct(F.coalesce("_run", F.lit(0)), *place, F.coalesce("_at", F.monotonically_increasing_id())).cast(SEQUENCE)
    return lines.withColumn("_seq", seq).where("_torn is null").drop("_torn", "_run", "_at")


def _without_secrets(column: Column, kind: DataType, name: str, secrets: tuple[str, ...]) -> Column:
    if isinstance(kind, StructType):
        return F.when(column.isNotNull(), F.struct(*[_without_secrets(column[f.name], f.dataType, f.name, secrets).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(column, lambda x: _without_secrets(x, kind.elementType, name, secrets))
    return redact(column, secrets) if isinstance(kind, StringType) and name in ("error", "message") else column


def without_secrets(df: DataFrame, secrets: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without the columns that place a ledger's records, and without credentials in ``error`` and ``message`` fields at any depth."""
    return df.select(*[_without_secrets(F.col(f"`{f.name}`"), f.dataType, f.name, secrets).alias(f.name) for f in df.schema.fields if f.name not in ("_run", "_at")])


def append_ledger(df: DataFrame, path: str, secrets: tuple[str, ...] = ()) -> None:
    """Append records as one run; ``error`` and ``message`` fields at any depth lose credentials, everything else stays as it is.

    Every record gets the run's number, the time in nanoseconds, and its place in ``df``; columns named _run or _at are replaced.
    """
    without_secrets(df, secrets).select("*", F.lit(time.time_ns()).alias("_run"), F.monotonically_increasing_id().alias("_at")).write.mode("append").json(path)


def read_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last lookup of each domain; failed ones are passed over, so they are tried again."""
    return latest_per_key(read_ledger(spark, path, schema), "domain", "_seq", F.col("confidence") == "error").drop("_seq")


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """(domain, pattern, confidence, source, evidence) as ``write_patterns`` left them; no file is an empty store, unreadable lines are passed over."""
    if not exists(spark, path):
        return spark.createDataFrame([], STORE)
    lines = spark.read.schema(STORE + ", _torn string").option("columnNameOfCorruptRecord", "_torn").json(path)
    return lines.where("_torn is null and domain is not null").drop("_torn")


def import_patterns(spark: SparkSession, path: str) -> DataFrame:
    """The same from one JSON object of patterns by domain, a small file; no file or an unreadable one is an empty store."""
    if not exists(spark, path):
        return spark.createDataFrame([], STORE)
    held = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{PATTERN}>").alias("m")).where("m is not null")
    return held.select(F.explode("m").alias("domain", "p")).select("domain", "p.*")


def write_patterns(store: DataFrame, path: str) -> None:
    """One JSON line for each domain."""
    store.write.mode("overwrite").json(path)


def write_versioned(df: DataFrame, path: str, version: str, after: commits.Commit | None = None) -> str:
    """Write a whole table beside its older versions, then commit it; readers never see half of one.

    ``after`` is the commit that the writer read, from ``commits.latest``; where it isn't given, the last one when writing begins.
    If somebody else has committed meanwhile, or a version of this name is there, this is a Conflict and nothing changes.
    """
    spark = df.sparkSession
    at = after or commits.latest(spark, path)
    if exists(spark, f"{path}/{version}"):
        raise commits.Conflict(f"{path} has a version {version} already")
    df.write.parquet(f"{path}/{version}")
    commits.add(spark, path, at, {"version": version})
    return f"{path}/{version}"


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    at = commits.latest(spark, path)
    if at is None:
        raise FileNotFoundError(f"nothing is committed at {path}")
    return spark.read.parquet(f"{path}/{at.content['version']}")


def context(df: DataFrame, website_key: Column, specialty: str, suburb: str, state: str, order: str) -> DataFrame:
    """(domain, specialty, suburb, state), the first row of each domain; columns that aren't there are blank."""
    pick = lambda c: (F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")).alias
    rows = df.select(website_key.alias("domain"), pick(specialty)("specialty"), pick(suburb)("suburb"), pick(state)("state"), F.col(order).alias("_p")).where("domain is not null")
    return rows.groupBy("domain").agg(F.min_by(F.struct("specialty", "suburb", "state"), "_p").alias("c")).select("domain", "c.*")


def write_companies(outcomes: DataFrame, path: str) -> None:
    """One JSON document for each company, below a folder of its domain; a company's older document is replaced, those of others stay.

    ``outcomes`` (domain, ...), one row for each domain.
    """
    named = outcomes.withColumn("company_domain", F.col("domain"))
    named.write.option("partitionOverwriteMode", "dynamic").partitionBy("company_domain").mode("overwrite").json(path)
