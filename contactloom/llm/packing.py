"""Packing of token ids into fixed sequences along a space-filling curve.

Each document's ids, counted in hashed buckets, are projected to a few dimensions; the place there
on a Hilbert curve is its key.  Documents are range-sorted by that key, so each partition is a
stretch of the curve, and laid end to end into sequences: neighbours on the curve share sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .scratch import write_table
from .token_counts import Spec, ids_of, load

DIMENSIONS, ORDER, BUCKETS = 4, 15, 1 << 12


def _encoder(spec: Spec) -> Callable[[str], bytes]:
    """A text's ids as little-endian bytes."""
    ids, kind = ids_of(spec), f"<u{spec.width}"
    return lambda text: np.array(ids(text), kind).tobytes()


def hilbert(points: np.ndarray, order: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, dimensions), each coordinate of ``order`` bits.

    Skilling's method: undo the curve's turns from the top bit down, then read the Gray code across.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    bit = 1 << (order - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (order - 1)
    while bit > 1:
        turn = np.where(x[-1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(order - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: list[np.ndarray], seed: int = 3) -> np.ndarray:
    """Hilbert keys of documents: ids hashed into buckets, counts projected by random signs, scaled by length."""
    signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0], np.float32), (BUCKETS, DIMENSIONS))
    points = np.empty((len(ids), DIMENSIONS))
    for k, own in enumerate(ids):
        counts = np.bincount((own.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)
        damped = np.sqrt(counts)
        points[k] = damped @ signs / np.sqrt(len(own))
    top = (1 << ORDER) - 1
    return hilbert(np.clip((points + 2.5) / 5 * top, 0, top), ORDER)


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, end_id: int = 0) -> DataFrame:
    """(key, doc_id, tie, width, ids) for every row; the ids end with ``end_id``."""
    sent = docs.sparkSession.sparkContext.broadcast(load(tokenizer_path))  # one tokenizer file

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = _encoder(sent.value), sent.value.width
        end = end_id.to_bytes(width, "little")
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                raw = [encode(t or "") + end for t in part.column(1).to_pylist()]
                keys = curve_keys([np.frombuffer(r, f"<u{width}") for r in raw])
                yield pa.RecordBatch.from_arrays([pa.array(keys), part.column(0), pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array([width] * len(raw), pa.int32()), pa.array(raw, pa.binary()), pa.array([len(r) for r in raw], pa.int64())], ["key", "doc_id", "tie", "width", "ids", "size"])

    return spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))).mapInArrow(rows, "key long, doc_id long, tie long, width int, ids binary, size long")


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 1024, partition_bytes: int = 32 << 20, with_ids: bool = False) -> DataFrame:
    """One row for each piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    A document is its ids and one id 0; every id lies in exactly one piece, and a sequence is filled
    by neighbouring documents without gaps.  Each partition is one stretch of the curve, of about
    ``partition_bytes`` of ids; what is left at its end goes into sequences of a power of two, so no
    sequence needs padding.  Null and empty
    texts are the id 0 alone; repeated rows are packed each; an empty table gives an empty result;
    other columns are ignored.
    """
    table = write_table(tokenized(docs, tokenizer_path, id_col, text_col), "token-ids")
    held = table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    count = max(1, -(-held // partition_bytes))
    ordered = table.drop("size").repartitionByRange(count, "key", "tie", "doc_id").sortWithinPartitions("key", "tie", "doc_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, used = TaskContext.get().partitionId() << 40, 0
        open_: list[tuple] = []  # pieces of the sequence that isn't full yet
        done: list[tuple] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t.type) for i, t in enumerate(PIECES)], schema=PIECES)
            done.clear()
            return out

        def close(pieces: list[tuple], number: int) -> None:
            offset = 0
            for doc_id, start, ids, total in pieces:
                done.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, number, offset, ids.astype("<u4").tobytes() if with_ids else None))
                offset += len(ids)

        for b in batches:
            for doc_id, width, raw in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                ids, at = np.frombuffer(raw, f"<u{width}"), 0
                while at < len(ids):
                    n = min(len(ids) - at, length - used)
                    open_.append((doc_id, at, ids[at : at + n], len(ids)))
                    at, used = at + n, used + n
                    if used == length:
                        close(open_, sequence)
                        open_, sequence, used = [], sequence + 1, 0
                if len(done) >= 20_000:
                    yield batch()
        while used:
            size, taken = 1 << (used.bit_length() - 1), []
            left = size
            while left:
                doc_id, start, ids, total = open_.pop(0)
                taken.append((doc_id, start, ids[:left], total))
                if len(ids) > left:
                    open_.insert(0, (doc_id, start + left, ids[left:], total))
                left -= len(taken[-1][2])
            close(taken, sequence)
            sequence, used = sequence + 1, used - size
        yield batch()

    pieces = ordered.mapInArrow(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
    return pieces if with_ids else pieces.drop("ids")
