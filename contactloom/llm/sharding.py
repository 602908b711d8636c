"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

How many rows each input part sends to each shard is drawn first, exactly as a uniform permutation of
all rows would deal them.  Every part then permutes its rows locally and deals them out by those
counts, one exchange moves them, and every shard is permuted again by sorting its rows by random keys.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Rows, fresh

PART_BITS = 18  # rows of a part: its permutation is at most 1 MB, whatever the size of files and tasks


def communication_matrix(rows_in: np.ndarray, rows_out: np.ndarray, seed: int) -> np.ndarray:
    """Rows from each part to each shard, as a uniform permutation deals them; margins are exact."""
    rng, left = np.random.default_rng(seed), np.array(rows_out, np.int64)
    matrix = np.zeros((len(rows_in), len(left)), np.int32)
    for p, n in enumerate(rows_in):
        matrix[p] = rng.multivariate_hypergeometric(left, int(n), method="marginals")
        left -= matrix[p]
    return matrix


def even_sizes(rows: int, parts: int) -> np.ndarray:
    """Sizes that differ by one at most."""
    return rows // parts + (np.arange(parts) < rows % parts)


def exact_shuffle(docs: DataFrame, shards: int = 16, seed: int = 7, cell_rows: int = 20_000) -> DataFrame:
    """All rows and columns of ``docs``, with ``shard`` int and ``slot`` long (gapless from 0 in each shard).

    The permutation is uniform over all rows, shard counts differ by one at most, and equal rows
    (copies, nulls, empty texts) are rows like any other.  A part is up to 2^18 rows of a file, so the
    matrix holds one line of ``shards`` numbers for as many rows.  A shard's random order is cut into cells of
    about ``cell_rows`` rows by the keys themselves, so no task holds a shard.  Rows are dealt by their
    file and place, so lost executors and other splits change nothing; what isn't a plain read of Parquet
    files is written first.  An empty table gives an empty result; existing columns named shard or
    slot are replaced, all others stay.
    """
    rows = Rows(docs)
    parts = [(f, p, min(n - (p << PART_BITS), 1 << PART_BITS)) for f, n in sorted(rows.files.items()) for p in range(-(-n >> PART_BITS))]
    total = sum(n for *_, n in parts)
    matrix = communication_matrix(np.array([n for *_, n in parts], np.int64), even_sizes(total, shards), seed)
    sent = docs.sparkSession.sparkContext.broadcast({(f, p): matrix[i] for i, (f, p, _) in enumerate(parts)})
    cells = max(1, -(-total // (shards * cell_rows)))

    held: dict[tuple[int, int], np.ndarray] = {}  # a task's current part, permuted once

    def deal(file: int, part: int) -> np.ndarray:
        if (file, part) not in held:
            held.clear()
            counts = sent.value[file, part]
            order = np.random.default_rng([seed, file & (1 << 63) - 1, int(file < 0), part]).permutation(int(counts.sum()))
            held[file, part] = np.repeat(np.arange(shards, dtype=np.int32), counts)[order]
        return held[file, part]

    @F.pandas_udf("int")
    def dealt(files: pd.Series, places: pd.Series) -> pd.Series:
        file, at = files.to_numpy(), places.to_numpy()
        out, part = np.empty(len(at), np.int32), at >> PART_BITS
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(part) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(at)] if len(at) else []):
            out[a:b] = deal(int(file[a]), int(part[a]))[at[a:b] & ((1 << PART_BITS) - 1)]
        return pd.Series(out)

    plain = rows.docs.drop("shard", "slot")
    file, at, key, cell, start = (fresh(c, plain) for c in ("_file", "_at", "_key", "_cell", "_start"))

    def placed(*columns) -> DataFrame:
        moved = rows.docs.select(*columns, rows.file().alias(file), rows.at().alias(at)).withColumn("shard", dealt(file, at))
        keyed = moved.withColumn(key, F.xxhash64(F.lit(seed), F.lit("order"), file, at))
        return keyed.withColumn(cell, F.pmod(F.shiftright(key, 16), F.lit(cells)).cast("int"))

    # The first scan reads no column of the table, only where its rows stand.
    counts = placed().groupBy("shard", cell).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    again = Window.partitionBy("shard", cell).orderBy(key, file, at)
    found = placed(*[rows.docs[f"`{c}`"] for c in plain.columns]).join(starts, ["shard", cell])
    return found.select(*[F.col(f"`{c}`") for c in plain.columns], "shard", (F.col(start) + F.row_number().over(again) - 1).alias("slot"))
