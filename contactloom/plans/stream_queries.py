"""Queries over keyed state that streams keep, stopped and started again on one checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger, people
from ..sources.keyed import KeyedTable, replaced
from ..sources.shared import new_folder
from ..streaming import keyed as streams
from .ledger_queries import RAW_SQL, _raw_people
from .registry import query, table


class _Lost(Exception):
    """Stands for a driver that is lost after a batch's upsert and before Spark notes the batch as done."""


def _streamed(spark: SparkSession, rows: DataFrame, order: str, keys: tuple[str, ...], changes: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` arriving in three parts, a run for each on one checkpoint; the second run is lost after its upsert and its batch comes again."""
    arrived, checkpoint = new_folder(spark, "arrived"), new_folder(spark, "stream-checkpoint")
    held = KeyedTable(new_folder(spark, "keyed"), keys, buckets=16)
    each = streams.upserted(held, replaced(keys), "changes")

    def lost(df: DataFrame, number: int) -> None:
        each(df, number)
        raise _Lost

    for part in range(3):
        rows.where(F.pmod(order, F.lit(3)) == part).write.mode("append").parquet(arrived)
        stream = lambda: changes(spark.readStream.schema(rows.schema).parquet(arrived))
        if part == 1:
            try:
                streams.follow(stream(), checkpoint, lost)
            except StreamingQueryException:
                pass
        streams.follow(stream(), checkpoint, each)
    return held.read(spark)


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_type <> 'error') WHERE r = 1")
def streamed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last good record of every user, kept by a stream over three runs and upserted by batch."""
    rows = table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value")
    found = _streamed(spark, rows, "event_id", ("user_id",), lambda stream: ledger.latest_per_key(stream, "user_id", "event_id", F.col("event_type") == "error"))
    return found.select("user_id", "event_id", "event_type", "value")


@query(f"WITH {RAW_SQL} SELECT domain, person_key, name, title, email, CASE WHEN email IS NULL THEN first_url ELSE email_url END AS source_url FROM merged")
def streamed_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People merged as their records arrive, over three runs."""
    return _streamed(spark, _raw_people(spark, sf_dir), "pos", ("domain", "person_key"), people.dedupe_people).select("domain", "person_key", "name", "title", "email", "source_url")
