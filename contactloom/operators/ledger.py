"""Keyed state over append-only records: first row, latest good record, what is done and what is pending.

Every operator takes an explicit order column; row order of files is never relied on.  Ties on key
and order are broken by the whole row, so results don't depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import keep


def _pick(df: DataFrame, key: str, order: str, last: bool) -> DataFrame:
    # Map columns have no order; everything else breaks ties.
    ties = [c for c, kind in df.dtypes if c not in (key, order) and "map<" not in kind and "variant" not in kind]
    rank = F.struct(order, *ties)
    pick = F.max_by if last else F.min_by
    return df.groupBy(key).agg(pick(F.struct(*[c for c in df.columns if c != key]), rank).alias("_row")).select(key, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key.  Aggregated before the shuffle, so a hot key costs nothing."""
    return _pick(df, key, order, last=False)


def latest_per_key(df: DataFrame, key: str, order: str, failed: Column | None = None) -> DataFrame:
    """The last row of each key; rows that ``failed`` never hide an earlier good one."""
    return _pick(df if failed is None else df.where(~F.coalesce(failed, F.lit(False))), key, order, last=True)


def last_with_failures(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key whatever it says: a failure hides the success before it."""
    return _pick(df, key, order, last=True)


def pending(targets: DataFrame, ledger: DataFrame, key: str, failed: Column) -> DataFrame:
    """Targets without a record that didn't fail: failures are tried again."""
    done = ledger.where(~F.coalesce(failed, F.lit(False))).select(key).distinct()
    return targets.join(done, key, "left_anti")


def unfinished(targets: DataFrame, ledger: DataFrame, master: DataFrame, key: str, failed: Column) -> DataFrame:
    """Targets without a good record and without a row in the master, which an earlier run may have filled without a ledger."""
    return pending(targets, ledger, key, failed).join(master.select(key).distinct(), key, "left_anti")


def has_any(df: DataFrame, key: str, test: Column, name: str = "has_any") -> DataFrame:
    return df.groupBy(key).agg(F.coalesce(F.bool_or(test), F.lit(False)).alias(name))


def histogram(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts of a column's values, the most frequent first; ``top`` of them if given."""
    counts = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return counts.limit(top) if top else counts


def stride_sample(df: DataFrame, order: str, size: int) -> DataFrame:
    """Every n-th row in the order of a unique column, ``size`` rows: numbered by ranges, not in one task."""
    stride = F.greatest(F.lit(1), F.floor(F.col("_total") / size))
    return _numbered(df, order).where((F.col("_n") % stride == 0) & (F.floor(F.col("_n") / stride) < size)).drop("_n", "_total")


BLOCK_ROWS = 500_000


def numbered_within(df: DataFrame, group: str, *order: str | Column, name: str = "r") -> DataFrame:
    """``df`` with each row's number from 0 in its group, in the order of ``order`` and then of the row.

    Rows are laid out by ranges of (group, order), not by group, so a group with a third of all rows is many ranges; a
    range's first number in a group is the sum of the group's rows in the ranges before.
    """
    ties = [c for c, kind in df.dtypes if c != group and "map<" not in kind and "variant" not in kind]
    laid = df.repartitionByRange(group, *order, *ties).sortWithinPartitions(group, *order, *ties)
    placed = keep(laid.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_spot")), "numbered")
    counts = placed.groupBy(group, "_range").agg(F.count("*").alias("_n"), F.min("_spot").alias("_first"))
    # One row for each range of a group.
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_range")) - F.col("_n")
    starts = counts.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), (before - F.col("_first")).alias("_shift"))
    joined = placed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return joined.select(*df.columns, (F.col("_spot") + F.col("_shift")).alias(name))


def numbered(df: DataFrame, order: str, name: str = "n") -> DataFrame:
    """``df`` with each row's number from 0 in the order of a column of any kind, worked out by ranges."""
    return numbered_within(df.withColumn("_all", F.lit(0)), "_all", order, name=name).drop("_all")


def _numbered(df: DataFrame, order: str) -> DataFrame:
    """Rows with ``_n``, their number from 0 in the order of a column of any kind, and ``_total``: ranges of bounded size, then the ranges' starts."""
    total = df.count()
    ranges = df.repartitionByRange(max(1, -(-total // BLOCK_ROWS)), order)
    placed = keep(ranges.withColumn("_block", F.spark_partition_id()), "ordered")
    counts = placed.groupBy("_block").agg(F.count("*").alias("n"))
    # One row for each range.
    starts = counts.select("_block", (F.sum("n").over(Window.orderBy("_block")) - F.col("n")).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_block").orderBy(order)) - 1
    return placed.withColumn("_at", within).join(starts, "_block").withColumn("_n", F.col("_start") + F.col("_at")).withColumn("_total", F.lit(total)).drop("_block", "_at", "_start")
