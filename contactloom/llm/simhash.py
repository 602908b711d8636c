"""SimHash near-duplicate groups with pigeonring candidate pruning.

A 64-bit fingerprint is cut into ``segments`` pieces on a ring.  If two fingerprints differ in at
most ``radius`` bits, then from some segment every chain of ``l`` consecutive segments differs in at
most ``floor(l * radius / segments)`` bits.  The longest chain whose budget is still zero must agree
exactly, so it is the join key; longer chains are held against their budgets before the whole
Hamming distance is taken.  Where many fingerprints share a key, parts of the longer chains join it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .components import connected_components
from .scratch import Rows, fresh, write_table

BITS = 64
FULL = (1 << BITS) - 1
FREE_BITS = 6  # fingerprints that agree on all other bits are at most 64
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text: bit is 1 if set in over half of the hashes of its word shingles."""
    split = (text or b"").lower().split()
    if not split:
        return 0
    last = max(1, len(split) - words + 1)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, last, SHINGLES_AT_ONCE):
        part = split[at : min(at + SHINGLES_AT_ONCE, last) + words - 1]
        if words == 3 and len(part) >= 3:
            shingles = [b"%b %b %b" % g for g in zip(part, part[1:], part[2:])]
        else:
            shingles = [b" ".join(part[i : i + words]) for i in range(max(1, len(part) - words + 1))]
        hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > last, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, name: Column | None = None) -> DataFrame:
    """(doc_id, fp long, file long, at long) for every row; null and empty texts have fingerprint zero.

    ``name`` is a struct of file and at that names each row; without one both are null.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *b.columns[2:]], ["doc_id", "fp", "file", "at"])

    name = F.lit(None).cast("struct<file:long,at:long>") if name is None else name
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"), name["file"].alias("file"), name["at"].alias("at"))
    return spread(narrow).mapInArrow(rows, "doc_id long, fp long, file long, at long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ring_masks(segments: int) -> list[list[int]]:
    """``[start][length - 1]``: mask of that many consecutive segments from that one on the ring."""
    edge = [BITS * i // segments for i in range(segments + 1)]
    one = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(segments)]
    return [[_signed(reduce(int.__or__, (one[(s + j) % segments] for j in range(n)))) for n in range(1, segments + 1)] for s in range(segments)]


def _pick(masks: list[int], start: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m).cast("long") for m in masks]), start + 1)


def _bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if mask >> b & 1]


def longer_keys(start: int, mask: int, radius: int, segments: int) -> list[int]:
    """Masks, each ``mask`` and more, of which one at least agrees wherever the chains from ``start`` keep their budgets.

    A chain that may differ in ``b`` bits agrees on one of any ``b + 1`` parts of what ``mask`` leaves of it; the
    chain that is cut is the one whose parts are longest.  Nothing is left to cut when ``mask`` leaves only 6 bits.
    """
    chains, best = ring_masks(segments)[start], []
    if BITS - (mask & FULL).bit_count() <= FREE_BITS:
        return []
    for n in range(1, segments + 1):
        budget = n * radius // segments
        open_ = _bits(chains[n - 1] & FULL & ~mask)
        parts = [open_[len(open_) * k // (budget + 1) : len(open_) * (k + 1) // (budget + 1)] for k in range(budget + 1)]
        if min(map(len, parts)) > 0 and (not best or len(parts[0]) > len(best[0])):
            best = parts
    return [_signed(mask & FULL | sum(1 << b for b in part)) for part in best]


def links(fps: DataFrame, radius: int = 2, segments: int = 9, bucket_limit: int = 64) -> DataFrame:
    """Links (a, b), a < b, of all ``fps`` (fp long, distinct) within ``radius`` bits of each other.

    A bucket holds the fingerprints that agree on a chain.  Up to ``bucket_limit`` of them are compared in
    pairs: the chains' budgets first, then the whole distance.  A larger bucket is split by longer keys:
    the next chain of the ring may differ in few bits, so it agrees on one of its parts, and that part joins
    the key.  Keys grow until buckets are small; with 6 free bits a bucket has at most 64 fingerprints anyway.
    """
    masks = ring_masks(segments)
    zero = max((n for n in range(1, segments + 1) if n * radius < segments), default=0)
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # A budget that several lengths share is implied by the longest of them.
    tight = [n for n in range(zero + 1, segments + 1) if n == segments or (n + 1) * radius // segments > n * radius // segments]
    chain = [F.bit_count(differ.bitwiseAND(_pick([m[n - 1] for m in masks], F.col("start")))) <= n * radius // segments for n in tight]
    keys = [(s, m[zero - 1] if zero else 0) for s, m in enumerate(masks)]
    first = F.explode(F.array(*[F.struct(F.lit(s).alias("start"), F.lit(m).cast("long").alias("mask")) for s, m in keys]))
    index, found = fps.select("fp", first.alias("k")).select("k.start", "k.mask", "fp"), None
    while True:
        index = index.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = write_table(index.groupBy("start", "mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
        splits = [(s, m, longer_keys(s, m, radius, segments)) for s, m in keys]
        whole = F.col("n") <= max(bucket_limit, 1 << FREE_BITS)
        small = index.join(sizes.where(whole), ["start", "mask", "key"], "left_semi")
        left, right = small.select("start", "mask", "key", F.col("fp").alias("a")), small.select("start", "mask", "key", F.col("fp").alias("b"))
        pairs = left.join(right, ["start", "mask", "key"]).where(F.col("a") < F.col("b")).where(reduce(Column.__and__, chain)).select("a", "b")
        found = pairs if found is None else found.union(pairs)
        if sizes.where(~whole).isEmpty():
            return found.distinct()
        keys = [(s, m) for s, _, more in splits for m in more]
        more = fps.sparkSession.createDataFrame([(s, m, part) for s, m, parts in splits for part in parts], "start int, mask long, longer long")
        large = index.join(sizes.where(~whole), ["start", "mask", "key"], "left_semi").join(F.broadcast(more), ["start", "mask"])  # at most some hundred rows
        index = write_table(large.select("start", F.col("longer").alias("mask"), "fp").distinct(), "longer-keys")


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2, name: Column | None = None) -> DataFrame:
    """One row for every row of ``docs``: (doc_id, fingerprint, component_id, file, at, root).

    Words are runs of characters other than U+0020 and U+0009-000D, ASCII letters lower-cased.
    ``fingerprint`` has 16 hex digits; ``component_id`` is the least doc_id reachable over links of
    at most ``radius`` bits, null if all of these are null.  Texts without words share fingerprint
    zero.  Repeated rows stay, each with the same group; an empty table gives an empty result;
    other columns of ``docs`` are ignored.
    """
    marked = write_table(with_fingerprint(docs, id_col, text_col, words, name), "fingerprints")
    each = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = connected_components(links(each.select("fp"), radius))
    rooted = each.join(found, each.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = write_table(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id", "root")
    return marked.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "file", "at", "root")


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each group the one of the least doc_id (null last, then by file and place).

    Null and empty texts are one group; of repeated rows one stays; an empty table gives an empty
    result; columns of any names stay as they are.  What isn't a plain read of Parquet files is written first.
    """
    rows = Rows(docs)
    groups = near_duplicate_groups(rows.docs, id_col, text_col, words, radius, rows.name())
    stay = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "file", "at")).alias("first"))
    file, at = fresh("_file", docs), fresh("_at", docs)
    stay = stay.select(F.col("first.file").alias(file), F.col("first.at").alias(at))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return rows.docs.select(*own, rows.file().alias(file), rows.at().alias(at)).join(stay, [file, at], "left_semi").select(*own)
