"""Keyed state over streams: the latest good record, people merged, and keys that have gone quiet.

The first two are the batch operators themselves: aggregates with partial results, whose buffers Spark keeps in its
state store, one for each key.  Every batch hands on the keys that it changed, and these are upserted by the batch's
number, so a batch that is run again changes nothing.  The third keeps a count and a timer for each key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.keyed import KeyedTable, Merge
from ..sources.shared import keep

Each = Callable[[DataFrame, int], None]


def upserted(table: KeyedTable, merge: Merge, writer: str) -> Each:
    """A batch writer that merges a batch into ``table``; ``writer`` names the stream whose batches are numbered.

    The batch is written first, whether it is new or comes again: that brings the state stores up to it, once.
    """
    def each(df: DataFrame, number: int) -> None:
        table.upsert(keep(df, "changes"), merge, writer, number)

    return each


def follow(changes: DataFrame, checkpoint: str, each: Each) -> None:
    """Work on everything that has arrived since the last run on ``checkpoint``; the keys that changed go to ``each``."""
    changes.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


QUIET = "key string, records long, first timestamp, last timestamp"


def quiet_keys(stream: DataFrame, key: str, at: str, minutes: int) -> DataFrame:
    """(key, records, first, last) of each run of records of a key, once no record has come for ``minutes`` of event time.

    A key's state is three numbers and goes when its run is told; a later record begins a new run.  Records later than the
    watermark, which is as many minutes, are dropped by Spark.  Null keys are left out.
    """
    def run(of: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            n, first, last = state.get
            state.remove()
            yield pd.DataFrame({"key": [of[0]], "records": [n], "first": [pd.Timestamp(first, unit="us")], "last": [pd.Timestamp(last, unit="us")]})
            return
        n, first, last = state.get if state.exists else (0, None, None)
        for frame in frames:
            told = frame["micros"]
            n, first, last = n + len(told), int(min([told.min(), *([] if first is None else [first])])), int(max([told.max(), *([] if last is None else [last])]))
        state.update((n, first, last))
        state.setTimeoutTimestamp(max(last // 1000, state.getCurrentWatermarkMs()) + minutes * 60_000)

    records = stream.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(at).alias("at"), F.unix_micros(at).alias("micros")).withWatermark("at", f"{minutes} minutes")
    return records.groupBy("key").applyInPandasWithState(run, QUIET, "n long, first long, last long", "append", GroupStateTimeout.EventTimeTimeout)
