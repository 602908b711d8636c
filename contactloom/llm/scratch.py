"""Written intermediate tables in the folder that driver and executors share, and rows that keep their names."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset a local session takes one below the temporary folder; on a cluster it is an error,
    because a temporary folder is another one on every host.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{tempfile.gettempdir()}/checkpoints"


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name, ``name`` or longer, that none of the tables has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Rows:
    """A table whose rows have names that every scan of it gives again, whatever the split of its files among tasks.

    A row's name is (file, at): a hash of its file, which no other file of the table has, and its place there.
    A plain read of Parquet files is taken as it is; where rows were filtered, joined or made, the table is
    written once first.  A bare ``limit`` has no fixed rows and looks like a shorter file, so write it before.  ``files`` maps each file to its number of rows, one entry for every file that
    the driver lists anyway.
    """

    def __init__(self, docs: DataFrame) -> None:
        self.docs, self.files = docs, self._plain(docs)
        if self.files is None:
            self.docs = write_table(docs, "rows")
            self.files = self._plain(self.docs)

    def _plain(self, docs: DataFrame) -> dict[int, int] | None:
        try:
            place = docs.metadataColumn("_metadata")
            file, at = place["file_path"], place["row_index"]
            for self.seed in range(8):
                named = docs.select(F.xxhash64(F.lit(self.seed), file).alias("file"), at.alias("at"), file.alias("path"))
                found = named.groupBy("path", "file").agg(F.count("*").alias("n"), F.max("at").alias("last"), F.sum("at").alias("sum")).collect()
                if len({r["file"] for r in found}) == len(found):
                    break
        except AnalysisException:
            return None
        whole = all(r["last"] == r["n"] - 1 and r["sum"] == r["n"] * (r["n"] - 1) // 2 for r in found)
        return {r["file"]: r["n"] for r in found} if whole else None

    def file(self) -> Column:
        return F.xxhash64(F.lit(self.seed), self.docs.metadataColumn("_metadata")["file_path"])

    def at(self) -> Column:
        return self.docs.metadataColumn("_metadata")["row_index"]

    def name(self) -> Column:
        return F.struct(self.file().alias("file"), self.at().alias("at"))


def write_table(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return it as read back from there.

    The files outlive any executor, so later steps never recompute what stands before them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    _written[path] = spark
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def drop_table(table: DataFrame) -> None:
    """Delete the files of a table from ``write_table`` that nothing reads any more."""
    path = getattr(table, "_scratch_path", None)
    if path and (spark := _written.pop(path, None)):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _delete_all() -> None:
    for path, spark in list(_written.items()):
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already at exit
            break
    _written.clear()
