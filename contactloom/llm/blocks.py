"""Documents as frequencies of their strings, in blocks, and the blocks' dictionaries.

Tasks gather documents into blocks of bounded text.  A block holds each distinct string once, as a
code; its documents are distinct codes and how often each occurs.  The dictionaries of all blocks, dealt into
buckets by the string's hash, meet in Spark, so every distinct string of the corpus is seen in one place
once; the values found there go back to the blocks and from there to the documents.

Frequencies and dictionaries stand in binary columns, because as arrays and rows of strings they take
more than twice the space in an exchange.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Some documents of a block, packed by column, or a bucket of its dictionary.
SCHEMA = "block long, ids binary, nulls binary, fact binary, sizes binary, codes binary, times binary, bucket int, pieces binary"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))])
DOCUMENTS_A_ROW = 4000


def pack(pieces: list[bytes]) -> bytes:
    return zstandard.compress(np.array([len(pieces), *map(len, pieces)], "<u4").tobytes() + b"".join(pieces), 3)


def unpack(packed: bytes) -> list[bytes]:
    raw = zstandard.decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist())]


def numbers(values: np.ndarray) -> bytes:
    """Values as compressed byte planes: the high bytes of small numbers cost next to nothing."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes() if len(values) else b"", 3)


def read_numbers(packed: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(width, -1).T.tobytes(), kind)


class Block:
    """Strings of one block and their codes, in order of their first use."""

    def __init__(self) -> None:
        self.code_of: dict[bytes, int] = {}
        self.memo: dict = {}
        self.documents: list[tuple] = []
        self.bytes = 0

    def code(self, piece: bytes) -> int:
        return self.code_of.setdefault(piece, len(self.code_of))

    def add(self, doc_id: int | None, fact: int, codes: np.ndarray) -> None:
        """A document with one number of its own, and its strings' codes: distinct ones in order, by their gaps, and how often each occurs."""
        distinct, times = np.unique(codes, return_counts=True)
        self.documents.append((doc_id, fact, np.diff(distinct, prepend=0).astype("<u4"), times.astype("<u4")))

    def rows(self, number: int, buckets: int) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, then one row for each bucket of the dictionary."""
        for at in range(0, len(self.documents), DOCUMENTS_A_ROW):
            ids, facts, gaps, times = zip(*self.documents[at : at + DOCUMENTS_A_ROW])
            yield _row(
                block=number, ids=numbers(np.array([i or 0 for i in ids], "<i8")), nulls=numbers(np.array([i is None for i in ids], np.uint8)), fact=numbers(np.array(facts, "<i8")),
                sizes=numbers(np.array([len(g) for g in gaps], "<u4")), codes=numbers(np.concatenate(gaps)), times=numbers(np.concatenate(times)))
        if not self.code_of:
            return
        pieces = list(self.code_of)
        of = np.fromiter((zlib.crc32(p) % buckets for p in pieces), np.int32, len(pieces))
        order = np.argsort(of, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            yield _row(block=number, codes=numbers(group.astype("<u4")), bucket=int(of[group[0]]), pieces=pack([pieces[i] for i in group]))


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(t.name)], t.type) for t in ARROW], schema=ARROW)


def encoded(docs: DataFrame, encoder: Callable[[], Callable], buckets: int, block_bytes: int) -> DataFrame:
    """Document and dictionary rows of ``docs`` (doc_id, text as binary); ``encoder()`` makes ``encode(block, text) -> (fact, codes)`` in each task."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block = encoder(), Block()
        number = TaskContext.get().partitionId() << 24
        for whole in batches:
            for doc_id, text in zip(*[c.to_pylist() for c in whole.columns]):
                block.add(doc_id, *encode(block, text or b""))
                block.bytes += len(text or b"")
                if block.bytes >= block_bytes:
                    yield from block.rows(number, buckets)
                    number, block = number + 1, Block()
        yield from block.rows(number, buckets)

    return docs.mapInArrow(rows, SCHEMA)


def looked_up(table: DataFrame, value_of: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """(of, codes, found): the value of each dictionary string by block, worked out once for each distinct one."""
    def bucket(group: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        spots = [np.fromiter((place.setdefault(p, len(place)) for p in unpack(packed)), np.int64) for packed in group["pieces"].to_pylist()]
        values = np.asarray(value_of(list(place)), "<u8")
        return pa.table({"of": group["block"], "codes": group["codes"], "found": pa.array([numbers(values[at]) for at in spots], pa.binary())})

    strings = table.where("bucket is not null").select("bucket", "block", "codes", "pieces")
    return strings.groupBy("bucket").applyInArrow(bucket, "of long, codes binary, found binary")


def summed(table: DataFrame, values: DataFrame) -> DataFrame:
    """(doc_id, fact, total): for each document its number and the sum of its strings' values, each as often as it occurs."""
    def block(documents: pa.Table, found: pa.Table) -> pa.Table:
        parts = [(read_numbers(r["codes"], "<u4"), read_numbers(r["found"], "<u8")) for r in found.to_pylist()]
        value = np.zeros(sum(len(c) for c, _ in parts))
        for codes, v in parts:
            value[codes] = v
        out = []
        for r in documents.to_pylist():
            sizes, gaps, times = (read_numbers(r[c], "<u4").astype(np.int64) for c in ("sizes", "codes", "times"))
            starts = np.cumsum(sizes) - sizes
            # Gaps start anew with each document.
            run = np.concatenate([[0], np.cumsum(gaps)])
            codes, of = run[1:] - np.repeat(run[starts], sizes), np.repeat(np.arange(len(sizes)), sizes)
            total = np.bincount(of, weights=value[codes] * times, minlength=len(sizes)).astype(np.int64)
            ids = pa.array(read_numbers(r["ids"], "<i8"), mask=read_numbers(r["nulls"], np.uint8) != 0)
            out.append(pa.table({"doc_id": ids, "fact": read_numbers(r["fact"], "<i8"), "total": total}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], pa.int64()) for c in ("doc_id", "fact", "total")})

    documents = table.where("bucket is null").select("block", "ids", "nulls", "fact", "sizes", "codes", "times")
    return documents.groupBy("block").cogroup(values.groupBy("of")).applyInArrow(block, "doc_id long, fact long, total long")


def bucket_count(docs: DataFrame) -> int:
    """Buckets that grow with the input, so that each meets a bounded share of the dictionaries; enough for all cores in any case."""
    return max(docs.rdd.getNumPartitions(), 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def as_bytes(docs: DataFrame, id_col: str, text_col: str) -> list:
    return [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")]
