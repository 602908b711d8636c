"""Tables of one row for each key that change by batches: only the buckets that a batch touches are written anew.

A version is a commit that names the folder of every bucket.  A batch is merged with its own buckets, these go to a
new folder, and the commit that names it carries the number of the writer's last batch; so a batch that
comes again is passed over, and a reader never sees half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import commits
from .commits import Commit, Conflict

BUCKET = "_bucket"
Merge = Callable[[DataFrame, DataFrame], DataFrame]


def replaced(keys: tuple[str, ...]) -> Merge:
    """Merge that takes the incoming row of a key for the old one."""
    same = lambda o, n: [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    return lambda old, new: old.alias("o").join(new.alias("n"), same("o", "n"), "left_anti").unionByName(new)


@dataclass(frozen=True)
class KeyedTable:
    """A table below ``path``; ``buckets`` is fixed by its first commit.  A merge leaves a row in every bucket that it is given."""

    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int").alias(BUCKET)

    def read(self, spark: SparkSession, at: Commit | None = None, only: list[int] | None = None) -> DataFrame:
        """The rows of a commit, the last one if none is given; ``only`` some buckets' rows."""
        at = at or commits.latest(spark, self.path)
        if at is None:
            raise FileNotFoundError(f"nothing is committed at {self.path}")
        schema = StructType.fromJson(at.content["schema"])
        folders = [f"{self.path}/{folder}/{BUCKET}={b}" for b, folder in sorted(at.content["buckets"].items()) if only is None or int(b) in only]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def upsert(self, incoming: DataFrame, merge: Merge, writer: str = "", batch: int | None = None, retries: int = 3) -> Commit | None:
        """Commit ``merge(old rows of the touched buckets, incoming)``; none where ``writer`` has committed ``batch`` already.

        ``incoming`` holds a key once.  Where another writer commits meanwhile, the merge is done again on its version, ``retries``
        times.  The columns are those of the first commit.
        """
        spark = incoming.sparkSession
        for left in range(retries, -1, -1):
            at = commits.latest(spark, self.path)
            done = at.content["batches"].get(writer) if at else None
            if batch is not None and done is not None and done >= batch:
                return None
            buckets = at.content["count"] if at else self.buckets
            held = incoming.select("*", self.bucket(buckets))
            touched = [r[0] for r in held.select(BUCKET).distinct().collect()]  # at most all buckets
            if at:
                schema = StructType.fromJson(at.content["schema"])
                merged = merge(self.read(spark, at, touched), incoming).select(*schema.names)
            else:
                merged = merge(spark.createDataFrame([], incoming.schema), incoming)
                schema = merged.schema
            folder = f"data-{uuid.uuid4().hex}"
            # Rows of a bucket come to one task each, and so to one file.
            merged.select("*", self.bucket(buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
            written = {str(b) for b in touched}
            content = {
                "count": buckets, "schema": schema.jsonValue(), "batches": {**(at.content["batches"] if at else {}), **({} if batch is None else {writer: batch})},
                "buckets": {**{b: f for b, f in (at.content["buckets"] if at else {}).items() if b not in written}, **{b: folder for b in written}}}
            try:
                return commits.add(spark, self.path, at, content)
            except Conflict:
                if not left:
                    raise
        return None
