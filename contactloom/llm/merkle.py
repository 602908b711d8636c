"""Merkle manifest of a dataset: one tree for each part, and one over the parts' roots.

A row's leaf is the hash of its columns.  Spark orders the leaves of each part and numbers them without gaps, so
every aligned block of ``FANOUT ** ROUNDS`` leaves is one group, whatever the part's size.  In a block
the leaves' 64 hexadecimal digits stand in a contiguous matrix; reshaped by the fanout its rows hash to the next
level.  The blocks' nodes are the next stage's leaves, until a part has one node.  On the way back down
a node's siblings come from its index alone, and blocks meet the path above them by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import spread
from .scratch import write_table

FANOUT = 8
ROUNDS = 4
BLOCK = FANOUT**ROUNDS
DIGITS = 64

_PATH = "part string, at long, slots array<int>, siblings array<string>"
_TOLD = [("leaf", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string())]
_PROOF = [("slots", pa.list_(pa.int32())), ("siblings", pa.list_(pa.string()))]


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value; whole numbers in decimal."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def digests(rows: np.ndarray) -> np.ndarray:
    """The hash of each row's bytes, as a matrix of hexadecimal digits."""
    return np.frombuffer("".join([hashlib.sha256(r).hexdigest() for r in rows]).encode(), np.uint8).reshape(-1, DIGITS)


def rounds_of(of: int) -> int:
    """Levels that a block hashes in a tree of ``of`` nodes: all of them, or those up to the tree's one node."""
    n, rounds = of, 0
    while n > 1 and rounds < ROUNDS:
        n, rounds = -(-n // FANOUT), rounds + 1
    return rounds


def levels(leaves: np.ndarray, rounds: int) -> list[np.ndarray]:
    """The leaves and the ``rounds`` levels above them."""
    out = [np.ascontiguousarray(leaves)]
    for _ in range(rounds):
        below = out[-1]
        full = len(below) // FANOUT * FANOUT
        up = [digests(below[:full].reshape(-1, FANOUT * DIGITS))] if full else []
        if full < len(below):
            up.append(digests(below[full:].reshape(1, -1)))
        out.append(np.concatenate(up))
    return out


def runs(level: np.ndarray, below: int, n: int) -> Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(leaves, their runs' nodes, their slots in the runs) on a level ``below`` levels above ``n`` leaves: full runs, then the last one if it's shorter."""
    at = np.arange(n) // FANOUT**below
    full = len(level) // FANOUT * FANOUT
    cut = int(np.searchsorted(at, full))
    for leaves, width in ((np.arange(cut), FANOUT), (np.arange(cut, n), len(level) - full)):
        if len(leaves):
            first = at[leaves] // FANOUT * FANOUT
            yield leaves, first[:, None] + np.arange(width), at[leaves] - first


def siblings(level: np.ndarray, below: int, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each leaf the other nodes of its run, left to right, and its slot."""
    others, slots = [], np.zeros(n, np.int32)
    for leaves, nodes, slot in runs(level, below, n):
        slots[leaves] = slot
        width = nodes.shape[1]
        rest = np.array([[j for j in range(width) if j != s] for s in range(width)], np.int64).reshape(width, width - 1)
        others.extend(level[np.take_along_axis(nodes, rest[slot], 1)].reshape(len(leaves), -1))
    return others, slots


def folded(tree: list[np.ndarray], rounds: int, claims: np.ndarray) -> np.ndarray:
    """What each claimed leaf and the true siblings hash to after ``rounds`` levels."""
    n, now = len(claims), claims
    for below in range(rounds):
        up = []
        for leaves, nodes, slot in runs(tree[below], below, n):
            own = tree[below][nodes]
            own[np.arange(len(leaves)), slot] = now[leaves]
            up.append(digests(own.reshape(len(leaves), -1)))
        now = np.concatenate(up)
    return now


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode(), np.uint8).reshape(-1, DIGITS)


def numbered(table: DataFrame, order: list[str]) -> DataFrame:
    """``table`` with ``at``, each row's place in its ``part`` by ``order``, and ``of``, the part's rows.

    Ranges of the order, not parts, are tasks, so a part may be the whole table.
    """
    laid = table.repartitionByRange("part", *order).sortWithinPartitions("part", *order)
    held = write_table(laid.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_place")), "merkle-order")
    counted = held.groupBy("part", "_range").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("part").orderBy("_range"))
    starts = counted.select("part", "_range", (before - F.col("_n") - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("part")).alias("of"))
    return held.join(starts, ["part", "_range"]).select(*table.columns, (F.col("_place") + F.col("_shift")).alias("at"), "of")


def raised(stage: DataFrame) -> DataFrame:
    """The nodes (part, at, of, node) of a stage's blocks."""
    def block(held: pa.Table) -> pa.Table:
        held = held.sort_by("at")
        of = held["of"][0].as_py()
        node = levels(_matrix(held["node"]), rounds_of(of))[-1].tobytes().decode()
        assert len(node) == DIGITS
        return pa.table({"part": held["part"].slice(0, 1), "at": pa.array([held["at"][0].as_py() // BLOCK]), "of": pa.array([-(-of // BLOCK)]), "node": pa.array([node])})

    return stage.select("part", F.expr(f"at div {BLOCK}").alias("block"), "at", "of", "node").groupBy("part", "block").applyInArrow(block, "part string, at long, of long, node string")


def stages(first: DataFrame) -> list[DataFrame]:
    """A tree's stages from (part, at, of, node), the last with one node for each part."""
    out = [first]
    while (out[-1].agg(F.max("of")).first()[0] or 0) > 1:
        out.append(write_table(raised(out[-1]), "merkle-nodes"))
    return out


def paths(tree: list[DataFrame], top: DataFrame) -> DataFrame:
    """(part, at, slots, siblings) of the nodes of a tree's first stage, given those above its last one."""
    def block(held: pa.Table, above: pa.Table) -> pa.Table:
        if not held.num_rows:
            return pa.table({"part": pa.array([], pa.string()), "at": pa.array([], pa.int64()), "slots": pa.array([], pa.list_(pa.int32())), "siblings": pa.array([], pa.list_(pa.string()))})
        held = held.sort_by("at")
        n, rounds = held.num_rows, rounds_of(held["of"][0].as_py())
        found = [siblings(level, below, n) for below, level in enumerate(levels(_matrix(held["node"]), rounds)[:-1])]
        up_slots, up_siblings = above["slots"][0].as_py(), above["siblings"][0].as_py()
        return pa.table({
            "part": held["part"], "at": held["at"], "slots": pa.array([[int(s[i]) for _, s in found] + up_slots for i in range(n)], pa.list_(pa.int32())),
            "siblings": pa.array([[o[i].tobytes().decode() for o, _ in found] + up_siblings for i in range(n)], pa.list_(pa.string()))})

    for stage in tree[-2::-1]:
        nodes = stage.select("part", F.expr(f"at div {BLOCK}").alias("block"), "at", "of", "node")
        top = write_table(nodes.groupBy("part", "block").cogroup(top.groupBy("part", "at")).applyInArrow(block, _PATH), "merkle-paths")
    return top


@dataclass
class Manifest:
    """A dataset's trees: the parts' stages, the stages over the parts' roots, and the root (none for an empty table)."""

    parts: list[DataFrame]
    over: list[DataFrame]
    root: str | None

    def audit(self, proofs: bool = False) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; with ``proofs`` its path too.

        ``proof_sha256`` is the hash of all siblings from the leaf to the root.  ``folded_root`` is what the claimed leaf and
        these siblings hash to; ``verified`` says whether that is the root.  The path is ``slots``, the row's
        place in its run on each level, and ``siblings``, the other digests of the run.
        """
        none = F.array().cast("array<int>").alias("slots"), F.array().cast("array<string>").alias("siblings")
        ranked = paths(self.over, self.over[-1].select(F.lit("").alias("part"), "at", *none))
        # The subroots' places among all are their paths' ``at``; the parts' one node has place 0.
        above = self.over[0].select("own", "at", F.col("node").alias("subroot")).join(ranked.select("at", "slots", "siblings"), "at").select(F.col("own").alias("part"), F.lit(0).cast("long").alias("at"), "slots", "siblings", "subroot")
        above = write_table(above, "merkle-top")
        blocks = paths(self.parts[1:], above.select("part", "at", "slots", "siblings"))
        root, extra = self.root, _PROOF if proofs else []

        def block(held: pa.Table, up: pa.Table) -> pa.Table:
            names = ["id", *[c for c, _ in _TOLD + extra], "part"]
            if not held.num_rows:
                return pa.table([pa.array([], t) for t in (pa.int64(), *[t for _, t in _TOLD + extra], pa.string())], names)
            held = held.sort_by("at")
            n, rounds = held.num_rows, rounds_of(held["of"][0].as_py())
            tree = levels(_matrix(held["node"]), rounds)
            found = [siblings(level, below, n) for below, level in enumerate(tree[:-1])]
            slots, others = up["slots"][0].as_py(), [s.encode() for s in up["siblings"][0].as_py()]
            shared, around = b"".join(others), [(o[: s * DIGITS], o[s * DIGITS :]) for s, o in zip(slots, others)]
            proof, roots = [], []
            for i, own in enumerate(folded(tree, rounds, _matrix(held["claim"]))):
                told = hashlib.sha256()
                for o, _ in found:
                    told.update(o[i])
                told.update(shared)
                proof.append(told.hexdigest())
                now = own.tobytes()
                for left, right in around:
                    now = hashlib.sha256(left + now + right).hexdigest().encode()
                roots.append(now.decode())
            columns = [held["id"], held["node"], pa.array(proof, pa.string()), pa.array(roots, pa.string())]
            if proofs:
                columns += [pa.array([[int(s[i]) for _, s in found] + slots for i in range(n)], pa.list_(pa.int32())), pa.array([[o[i].tobytes().decode() for o, _ in found] + [o.decode() for o in others] for i in range(n)], pa.list_(pa.string()))]
            return pa.table([*columns, held["part"]], names)

        schema = "id long, leaf string, proof_sha256 string, folded_root string" + (", slots array<int>, siblings array<string>" if proofs else "") + ", part string"
        leaves = self.parts[0].select("part", F.expr(f"at div {BLOCK}").alias("block"), "at", "of", "id", "node", "claim")
        told = leaves.groupBy("part", "block").cogroup(blocks.groupBy("part", "at")).applyInArrow(block, schema)
        return told.join(above.select("part", "subroot"), "part").select("id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"), *[c for c, _ in extra])


def manifest(docs: DataFrame, columns: list[str], part_col: str, id_col: str, claims: dict[str, Column] | None = None) -> Manifest:
    """The manifest of all rows: a tree for each value of ``part_col``, leaves in ascending order of ``id_col``.

    A leaf hashes ``columns`` in order, see ``field``.  ``claims`` gives other values of columns, as an auditor
    finds them; ``audit`` folds the leaves of these.  A null part is a part of its own, the first, and
    an empty one is another; null ids come first; rows of one id are in order of their leaves, and equal rows are
    leaves each.  Texts are hashed whole and never exchanged.  Other columns of any names are ignored.
    """
    claimed = claims or {}
    own = {c: F.col(f"`{c}`") for c in columns}
    part = F.col(f"`{part_col}`").cast("string")
    leaves = spread(docs.select(*{f"`{c}`": 0 for c in [*columns, part_col, id_col]})).select(
        F.when(part.isNull(), "").otherwise(F.concat(F.lit("="), part)).alias("part"), F.col(f"`{id_col}`").cast("long").alias("id"), leaf(own.values()).alias("node"),
        leaf([claimed.get(c, v) for c, v in own.items()]).alias("claim"))
    # The row's number parts equal rows of a repeated id among tasks.
    held = write_table(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    parts = stages(numbered(held, ["id", "node", "row"]))
    tops = parts[-1].select(F.lit("").alias("part"), F.col("part").alias("own"), "node")
    over = stages(numbered(tops, ["own"]))
    top = over[-1].first()
    return Manifest(parts, over, top and top["node"])
