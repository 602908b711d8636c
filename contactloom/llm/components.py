"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop_table, write_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long, a != b) to one row (node, root) for every node; root is the least node reachable.

    Every round is written to the shared folder, so no round's lineage holds an earlier one.  The
    number of rounds is logarithmic in the longest shortest path.  No edges: an empty result.
    """
    state, before = write_table(edges, "edges"), None
    while True:
        after = write_table(_small_star(_large_star(state)), "edges")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_table(state)
        state = after
        if mark == before:
            break
        before = mark
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
