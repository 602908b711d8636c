"""Runs that go on where the last one stopped: a stream over appended files, batches written once, failures tried again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import new_folder


def run_available(spark: SparkSession, folder: str, pattern: str, schema, checkpoint: str, each: Callable[[DataFrame, int], None]) -> int:
    """Hand every file that is new since the last run on ``checkpoint`` to ``each`` in batches; the number of batches."""
    batches = 0

    def counted(df: DataFrame, number: int) -> None:
        nonlocal batches
        batches += 1
        each(df, number)

    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    stream.writeStream.foreachBatch(counted).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return batches


def ledger_batch(path: str, work: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch writer whose rows land in a folder of the batch's number: a batch that runs twice replaces itself."""
    return lambda df, number: work(df).write.mode("overwrite").parquet(f"{path}/batch={number}")


def pending_batch(batch: DataFrame, ledger: DataFrame, key: str, failed: Column) -> DataFrame:
    """Rows of a batch whose key has no good record in the ledger: a failure never marks a key as done."""
    done = ledger.where(~F.coalesce(failed, F.lit(False))).select(key).distinct()
    return batch.join(done, key, "left_anti")


def resumed_summary(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Counts and last good records of every user from a ledger that two runs on one checkpoint wrote."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    checkpoint, ledger = new_folder(spark, "stream-checkpoint"), new_folder(spark, "stream-ledger")
    work = ledger_batch(ledger, lambda df: df.where("event_type != 'error'").select("user_id", "event_id"))
    run_available(spark, folder, pattern, schema, checkpoint, work)
    run_available(spark, folder, pattern, schema, checkpoint, work)
    rows = spark.read.parquet(ledger)
    return rows.groupBy("user_id").agg(F.count("*").alias("n_events"), F.max("event_id").alias("last_event"))
