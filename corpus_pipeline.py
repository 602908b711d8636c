"""A corpus pipeline: labelled quality, near-duplicates, test-set passages, secrets, packing.

Every stage takes (spark, docs, sf_dir); ``docs`` has the columns of the documents table, and all stages but
the last return these columns.  In every stage null columns are values like any other, a null text counts
as an empty one where it is judged and stays null where it is kept, further columns of any names are
ignored, and an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm import decontam, packing, scratch, secret_scan as scan, simhash, zstd_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, takes for bad (score under 0.3) go.

    Repeated rows stay or go together; a score of just 0.3 stays.  The classifier is fitted on the labelled
    rows of ``docs``; without any its curve is flat at one half and all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(zstd_quality.in_training())
    return zstd_quality.keep_good(docs, zstd_quality.fit(docs, labels)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id stays; of repeated rows one.

    Null and empty texts are one group.  Null ids come last; where ids are equal the first row by file and
    place stays.
    """
    return simhash.keep_one_of_each_group(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words inside benchmark windows go, repeated rows all alike.

    Texts without words stay, and so does everything where the benchmark is empty.
    """
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text becomes ``[kind]``; n_chars follows the text, and stays where the text is null."""
    clean = scan.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens; a null or empty text is its end id alone, repeated rows are packed each."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: SQL cannot express the classifier and the packing; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        after = scratch.write_table(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            scratch.drop_table(before)
        docs = before = after
    return STAGES[-1][1](spark, docs, sf_dir)
