"""Ledgers as a data source of Spark: ``spark.read.format("ledger")``, ``df.write.format("ledger")``, ``readStream`` by runs.

A ledger is a folder of JSON-lines files and of run files.  A run's records are written to files of their own first; then
one run file is created that lists them, with the number of the run and the least and greatest values of their plain columns.
A run is there as a whole from then on, and a run that fails leaves nothing that a reader sees.  Readers cut files
into splits, leave out files whose values a filter rules out, and streams go on from the last run they saw.

Records get two columns: ``_run``, the run's number, which rises by one, and ``_at``, a record's place in its run.
Executors open files by ``pyarrow.fs``, so the folder is one that pyarrow can open by its address.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.json as pj
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructType

from .files import without_secrets

SPLIT_BYTES = 32 << 20
PLAIN = (str, int, float)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), path) if "://" not in path and not path.startswith("file:") else fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def runs(path: str) -> list[dict]:
    """The committed runs in order: number, schema, and files with their records, bytes and ranges of values."""
    store, root = opened(path)
    found = [i.path for i in store.get_file_info(fs.FileSelector(f"{root}/_runs", allow_not_found=True)) if i.path.endswith(".json")]
    out = []
    for p in found:
        with store.open_input_stream(p) as f:
            out.append(json.loads(f.read()))
    return sorted(out, key=lambda r: r["run"])


def commit_run(path: str, run: dict) -> int:
    """Create the next run's file, whole or not at all; a writer that finds its number taken takes the next one."""
    store, root = opened(path)
    store.create_dir(f"{root}/_runs", recursive=True)
    number = max([0, *(int(i.base_name[:-5]) for i in store.get_file_info(fs.FileSelector(f"{root}/_runs")) if i.base_name.endswith(".json"))])
    part = f"{root}/_runs/{uuid.uuid4().hex}.part"
    while True:
        number += 1
        target = f"{root}/_runs/{number:020d}.json"
        with store.open_output_stream(part) as f:
            f.write(json.dumps({**run, "run": number}).encode())
        try:
            if isinstance(store, fs.LocalFileSystem):
                os.link(part, target)
                os.remove(part)
            else:
                # Stores that don't refuse to move a file over another one take one writer at a time.
                if store.get_file_info(target).type != fs.FileType.NotFound:
                    raise FileExistsError(target)
                store.move(part, target)
            return number
        except FileExistsError:
            continue


@dataclass
class Split(ds.InputPartition):
    """Bytes of a file: the records that begin there."""

    file: str
    start: int
    end: int
    run: int


def to_line_end(f: pa.NativeFile, at: int) -> bytes:
    """What is left of the line that ``at`` stands in."""
    f.seek(at)
    out = b""
    while chunk := f.read(1 << 16):
        end = chunk.find(b"\n")
        if end >= 0:
            return out + chunk[: end + 1]
        out += chunk
    return out


def records(path: str, split: Split, schema: StructType) -> Iterator[pa.RecordBatch]:
    """The split's records in batches; fields that aren't in the schema are passed over, missing ones are null."""
    arrow = to_arrow_schema(schema)
    own = pa.schema([f for f in arrow if f.name != "_run"])
    store, root = opened(path)
    with store.open_input_file(f"{root}/{split.file}") as f:
        at = split.start
        if at:
            at = at - 1 + len(to_line_end(f, at - 1))
        while at < split.end:
            f.seek(at)
            block = f.read(min(4 << 20, split.end - at))
            if not block.endswith(b"\n"):
                block += to_line_end(f, at + len(block))
            at += len(block)
            if not block.strip():
                continue
            held = pj.read_json(pa.BufferReader(block), pj.ReadOptions(block_size=len(block) + 1), pj.ParseOptions(explicit_schema=own, unexpected_field_behavior="ignore"))
            columns = [pa.array([split.run] * held.num_rows, f.type) if f.name == "_run" else held[f.name].cast(f.type) for f in arrow]
            yield from pa.table(columns, schema=arrow).to_batches()


def splits(run: dict) -> list[Split]:
    return [Split(f["file"], a, min(a + SPLIT_BYTES, f["bytes"]), run["run"]) for f in run["files"] for a in range(0, f["bytes"], SPLIT_BYTES)]


def rules_out(filters: list[ds.Filter], run: int, values: dict) -> bool:
    """Whether no record of a file can pass the filters, by the least and greatest values of its columns."""
    for f in filters:
        low, high = (run, run) if f.attribute == ("_run",) else values.get(f.attribute[0], (None, None)) if len(f.attribute) == 1 else (None, None)
        wanted = list(f.value) if isinstance(f, ds.In) else [f.value]
        if low is None or not wanted or any(type(v) is not type(low) for v in wanted):
            continue
        if isinstance(f, (ds.EqualTo, ds.In)) and all(v < low or v > high for v in wanted):
            return True
        if isinstance(f, ds.GreaterThan) and high <= f.value or isinstance(f, ds.GreaterThanOrEqual) and high < f.value:
            return True
        if isinstance(f, ds.LessThan) and low >= f.value or isinstance(f, ds.LessThanOrEqual) and low > f.value:
            return True
    return False


class LedgerReader(ds.DataSourceReader):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema, self.filters = path, schema, []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Comparisons leave out files; Spark still tests the records of the others."""
        for f in filters:
            if isinstance(f, (ds.EqualTo, ds.In, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual)):
                self.filters.append(f)
            yield f

    def partitions(self) -> list[Split]:
        kept = [{**r, "files": [f for f in r["files"] if not rules_out(self.filters, r["run"], f["values"])]} for r in runs(self.path)]
        return [s for r in kept for s in splits(r)] or [Split("", 0, 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return records(self.path, partition, self.schema) if partition.file else iter(())


class LedgerStream(ds.DataSourceStreamReader):
    """Offsets are runs: a batch is the runs that were committed since the last one."""

    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:
        return {"run": 0}

    def latestOffset(self) -> dict:
        return {"run": max([0, *(r["run"] for r in runs(self.path))])}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return [s for r in runs(self.path) if start["run"] < r["run"] <= end["run"] for s in splits(r)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return records(self.path, partition, self.schema)


@dataclass
class Written(ds.WriterCommitMessage):
    file: str
    records: int
    bytes: int
    values: dict = field(default_factory=dict)


class LedgerWriter(ds.DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema, self.folder = path, schema, f"data/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = opened(self.path)
        task = TaskContext.get()
        # A task that runs again writes a file of its own; only the one that succeeds is in the run.
        told = Written(f"{self.folder}/{task.partitionId():06d}-{task.taskAttemptId()}.json", 0, 0)
        store.create_dir(f"{root}/{self.folder}", recursive=True)
        with store.open_output_stream(f"{root}/{told.file}", compression=None) as f:
            for batch in iterator:
                rows = batch.to_pylist()
                lines = [json.dumps({**row, "_at": (task.partitionId() << 33) + told.records + i}, ensure_ascii=False, default=str) for i, row in enumerate(rows)]
                block = "".join(x + "\n" for x in lines).encode()
                f.write(block)
                told.bytes, told.records = told.bytes + len(block), told.records + len(rows)
                for name, column in zip(batch.schema.names, zip(*[r.values() for r in rows])):
                    known = [v for v in column if type(v) in PLAIN and v == v]
                    if known:
                        low, high = told.values.get(name, (known[0], known[0]))
                        told.values[name] = (min(low, *known), max(high, *known))
        return told

    def commit(self, messages: list[Written | None]) -> None:
        files = [{"file": m.file, "records": m.records, "bytes": m.bytes, "values": m.values} for m in messages if m and m.records]
        if files:
            commit_run(self.path, {"schema": self.schema.jsonValue(), "files": files})

    def abort(self, messages: list[Written | None]) -> None:
        store, root = opened(self.path)
        if store.get_file_info(f"{root}/{self.folder}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.folder}")


class Ledger(ds.DataSource):
    """``path`` is the ledger's folder; without a schema given it is that of the last run."""

    @classmethod
    def name(cls) -> str:
        return "ledger"

    def schema(self) -> StructType:
        found = runs(self.options["path"])
        if not found:
            raise ValueError(f"the ledger at {self.options['path']} has no run yet; give its schema")
        return with_places(StructType.fromJson(found[-1]["schema"]))

    def reader(self, schema: StructType) -> LedgerReader:
        return LedgerReader(self.options["path"], schema)

    def streamReader(self, schema: StructType) -> LedgerStream:
        return LedgerStream(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> LedgerWriter:
        if overwrite:
            raise ValueError("a ledger is only appended to")
        return LedgerWriter(self.options["path"], StructType([f for f in schema.fields if f.name not in ("_run", "_at")]))


def with_places(schema: StructType | str) -> StructType:
    """A schema of records with the columns that place them."""
    whole = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    return whole.add("_run", LongType()).add("_at", LongType())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Ledger)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def append(df: DataFrame, path: str, secrets: tuple[str, ...] = ()) -> None:
    """Append records as one run; ``error`` and ``message`` fields at any depth lose credentials."""
    register(df.sparkSession)
    without_secrets(df, secrets).write.format("ledger").mode("append").save(path)
