"""CSV files whose quoted cells hold line feeds, read by all cores.

A split of such a file may begin inside a cell, and only what stands before it says so.  Every split is therefore
parsed for both cases; each tells how it would end.  These ends, one pair for each split, are combined in the
order of the file, which gives every split's true start.  Then each split cuts its lines into rows from its first
true row on, and the pieces of a row that runs over splits are put together by the split in which it began.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import keep

#: The rest of a quoted cell: doubled quotes are part of it, a single one ends it.
REST = re.compile(r'(?:[^"]++|"")*+"')
PIECES = "file string, split long, n long, part int, text string"
_ARROW = pa.schema([("file", pa.string()), ("split", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("text", pa.string())])
WHOLE, OPENED, MORE, CLOSED = range(4)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell, for one that begins inside of one or not."""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            rest = REST.match(line, at if inside else at + 1)
            if rest is None:
                return True
            inside, at = False, rest.end()
        # What follows a closing quote belongs to the cell, as do quotes inside of an unquoted one.
        at = line.find(",", at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def _both_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, outside, inside): for each split in turn, whether it ends inside a cell if it began outside or inside of one."""
    now, ends = None, (False, True)
    for b in batches:
        for file, split, line in zip(*[c.to_pylist() for c in b.columns]):
            if (file, split) != now:
                if now:
                    yield _end(now, ends)
                now, ends = (file, split), (False, True)
            ends = ends_inside(line, ends[0]), ends_inside(line, ends[1])
    if now:
        yield _end(now, ends)


def _end(of: tuple[str, int], ends: tuple[bool, bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"file": [of[0]], "split": pa.array([of[1]], pa.int64()), "outside": [ends[0]], "inside": [ends[1]]})


def starts(lines: DataFrame) -> DataFrame:
    """(file, split, begins_inside) of the splits that hold a quote, and of no others, whose ends say nothing new.

    A split either leaves the state as it is, turns it, or sets it whatever it was; so the state before a split is what the
    last one that set it said, turned as often as it has been turned since.
    """
    ends = lines.where(F.contains("value", F.lit('"'))).mapInArrow(_both_ends, "file string, split long, outside boolean, inside boolean")
    order = Window.partitionBy("file").orderBy("split")
    turned = ends.withColumn("turns", F.sum((F.col("outside") & ~F.col("inside")).cast("long")).over(order))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("long").alias("value"), "turns"))
    said = turned.withColumn("fixed", fixed).withColumn("last", F.last("fixed", ignorenulls=True).over(order))
    after = (F.coalesce("last.value", F.lit(0)) + F.col("turns") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    return said.select("file", "split", after.alias("ends_inside"))


def pieces(lines: DataFrame) -> DataFrame:
    """(file, split, n, part, text): rows that stand in one split, and the parts of rows that run over several.

    Which splits begin inside a cell goes to every task: a few bytes for each split after such a cell's begin, and
    the driver lists all splits in any case.
    """
    state = starts(lines).collect()
    by_file: dict[str, list[tuple[int, bool]]] = {}
    for r in sorted(state):
        by_file.setdefault(r["file"], []).append((r["split"], r["ends_inside"]))
    sent = lines.sparkSession.sparkContext.broadcast({f: tuple(zip(*x)) for f, x in by_file.items() if any(e for _, e in x)})

    def begins_inside(file: str, split: int) -> bool:
        splits, ends = sent.value.get(file, ((), ()))
        before = bisect_left(splits, split)
        return before > 0 and ends[before - 1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, inside, part, held = None, 0, False, WHOLE, []
        for b in batches:
            out: list[tuple] = []
            quoted = pc.match_substring(b.column(2), '"').to_pylist()
            for file, split, line, quote in zip(*[c.to_pylist() for c in b.columns], quoted):
                if (file, split) != now:
                    if held:
                        out.append((*now, n, MORE if part == MORE else OPENED, "\n".join(held)))
                    now, n, held, inside = (file, split), 0, [], begins_inside(file, split)
                    part = MORE if inside else WHOLE
                inside = ends_inside(line, inside) if quote else inside
                held.append(line)
                if not inside:
                    if part == MORE or line.strip() or len(held) > 1:
                        out.append((*now, n, CLOSED if part == MORE else WHOLE, "\n".join(held)))
                        n += 1
                    held, part = [], WHOLE
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _ARROW)], schema=_ARROW)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip((*now, n, MORE if part == MORE else OPENED, "\n".join(held)), _ARROW)], schema=_ARROW)

    return lines.mapInArrow(rows, PIECES)


def read_rows(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """(file, split, n, text): every row of the files as written, with line feeds inside its cells, in file order by (file, split, n).

    The rows are written once, so both passes see the same splits; ``split_bytes`` bounds these for this read.
    A cell that is never closed runs to the end of its file, as any reader takes it.
    """
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if split_bytes:
        spark.conf.set(key, str(split_bytes))
    try:
        found = keep(pieces(_lines(spark, path)), "csv-pieces")
    finally:
        spark.conf.set(key, before)
    order = Window.partitionBy("file").orderBy("split", F.desc("part"))  # a split's closing piece, then its opening one
    over = found.where(F.col("part") != WHOLE).withColumn("begun", F.last(F.when(F.col("part") == OPENED, F.struct("split", "n")), ignorenulls=True).over(order))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "text"))), lambda x: x["text"]), "\n")
    joined = over.groupBy("file", "begun").agg(text.alias("text")).select("file", "begun.split", "begun.n", "text")
    return found.where(F.col("part") == WHOLE).select("file", "split", "n", "text").unionByName(joined)


def read(spark: SparkSession, path: str, columns: list[str], split_bytes: int | None = None) -> DataFrame:
    """The cells of the files' rows, all strings, under these names, with ``_pos`` in file order; each file's first row is its header."""
    rows = read_rows(spark, path, split_bytes).where("not (split = 0 and n = 0)")
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    parsed = rows.select("file", "split", "n", F.from_csv(F.regexp_replace("text", r"\r\z", ""), schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}).alias("c"))
    return parsed.select(*[F.col(f"c.c{i}").alias(c) for i, c in enumerate(columns)], F.struct("file", "split", F.col("n").alias("row")).alias("_pos"))
