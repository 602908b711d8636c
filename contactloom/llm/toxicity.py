"""Toxicity by FTRL-proximal logistic regression over hashed words, their n-grams, skip-grams and beginnings.

A text's features are the distinct hash slots of its words, of pairs of words at a distance of one (n-grams), two
and three (skip-grams), and of words' first characters, so that inflected words share some.
Each weight has a rate of its own, which falls with the squared gradients that it has seen, and stays
exactly zero until its evidence exceeds the L1 strength; so the model is a short list of slots and weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .decontam import words_of
from .scratch import fresh

BITS = 20
DISTANCES = (1, 2, 3)
HEADS = (3, 4, 5, 6, 7)
WORDS_KEPT = 200_000  # distinct words whose hashes a task keeps at hand

_MIX, _PAIR = np.uint64(0x9E3779B97F4A7C15), 0xC2B2AE3D27D4EB4F


def _slots(hashed: np.ndarray) -> np.ndarray:
    return ((hashed ^ hashed >> np.uint64(32)) * _MIX >> np.uint64(64 - BITS)).astype(np.int32)


class Words:
    """Hashes of words and of their beginnings, each worked out once in a task."""

    def __init__(self) -> None:
        self.code_of: dict[bytes, int] = {}
        self._grow(np.zeros(0, np.uint64), np.zeros((0, len(HEADS)), np.int32), 1024)

    def _grow(self, own: np.ndarray, heads: np.ndarray, size: int) -> None:
        room = 2 * size
        self.own, self.heads = np.zeros(room, np.uint64), np.zeros((room, len(HEADS)), np.int32)
        self.own[: len(own)], self.heads[: len(own)] = own, heads

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self.code_of) > WORDS_KEPT:
            self.__init__()
        code_of, known = self.code_of, len(self.code_of)
        new = [w for w in dict.fromkeys(words) if w not in code_of]
        if new:
            code_of.update(zip(new, range(known, known + len(new))))
            if len(code_of) > len(self.own):
                self._grow(self.own[:known], self.heads[:known], len(code_of))
            self.own[known : len(code_of)] = [xxhash.xxh64_intdigest(w, 42) for w in new]
            # A word that is too short for a beginning stands for itself.
            begun = [xxhash.xxh64_intdigest(w[:k], k) for w in (w.decode("utf-8", "replace") for w in new) for k in HEADS]
            self.heads[known : len(code_of)] = _slots(np.array(begun, np.uint64)).reshape(-1, len(HEADS))
        return np.fromiter(map(code_of.__getitem__, words), np.int64, len(words))

    def features(self, text: bytes, wanted: np.ndarray | None = None) -> np.ndarray:
        """The distinct slots of a text in ascending order; with ``wanted`` only those that it marks."""
        codes = self.codes(words_of(text))
        h = self.own[codes]
        found = [_slots(h), self.heads[np.unique(codes)].ravel()]
        for d in DISTANCES:
            found.append(_slots(h[:-d] * np.uint64(_PAIR + 2 * d) + h[d:]))
        slots = np.concatenate(found)
        return np.unique(slots if wanted is None else slots[wanted[slots]])


@dataclass(frozen=True)
class Model:
    """The slots with a weight other than zero, their weights, and the constant."""

    slots: np.ndarray
    weights: np.ndarray
    constant: float


def train(texts: list[np.ndarray], labels: list[int], alpha: float, beta: float, l1: float, l2: float, epochs: int) -> Model:
    """FTRL-proximal: one text after another, ``epochs`` times; the constant has no penalty."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z_all = n_all = 0.0

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    def constant() -> float:
        return -z_all * alpha / (beta + math.sqrt(n_all))

    for _ in range(epochs):
        for slots, label in zip(texts, labels):
            z_own, n_own, c = z[slots], n[slots], constant()
            w = weights(z_own, n_own)
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w.sum()) + c)))) - label
            more = n_own + g * g
            z[slots], n[slots] = z_own + g - (np.sqrt(more) - np.sqrt(n_own)) / alpha * w, more
            z_all += g - (math.sqrt(n_all + g * g) - math.sqrt(n_all)) / alpha * c
            n_all += g * g
    w = weights(z, n)
    slots = np.flatnonzero(w)
    return Model(slots.astype(np.int32), w[slots], constant())


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 8000, sample_bytes: int = 64 << 20, alpha: float = 0.3, beta: float = 1.0, l1: float = 8.0, l2: float = 1.0, epochs: int = 4) -> Model:
    """A model from a bounded sample of labelled rows: at most ``sample_rows`` of them, of ``sample_bytes`` bytes in all.

    The sample is that of the least hashes of the ids, whole texts, both labels at their own rate; a text that doesn't fit into
    what is left of the bytes is passed over.  Spark makes the features; one task, which the sample's bound keeps
    small, goes through them in order of the hashes, and only weights other than zero come to the driver.
    Null ids and other labels than 0 and 1 are not learnt from, null texts are empty ones; an id with several labels has the
    larger one, an id with several texts one of them, by their hashes.  Without labels the model
    has no weight and gives one half.  Other columns are ignored.
    """
    mark, size = fresh("_label", docs, labels), fresh("_size", docs, labels)
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias(mark))
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    sized = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).alias(size)).join(marked, "id")
    order = F.xxhash64(F.lit(13), F.col("id"))
    # Rows of one id count once, by their longest text.
    chosen, left = {}, sample_bytes
    for r in sized.groupBy("id").agg(F.max(size).alias(size), F.max(mark).alias(mark)).where(F.col(size) <= sample_bytes).orderBy(order, "id").limit(sample_rows).collect():
        if r[size] <= left:
            left -= r[size]
            chosen[r["id"]] = r[mark]
    if not chosen:
        return Model(np.zeros(0, np.int32), np.zeros(0), 0.0)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array([words.features(t) for t in part.column(4).to_pylist()], pa.list_(pa.int32()))], ["one", "id", "place", "own", "slots"])

    def learnt(sample: pa.Table) -> pa.Table:
        # Rows of one id stand together, in an order of their own; the first is read.
        sample = sample.sort_by([("id", "ascending"), ("own", "ascending")])
        ids = sample["id"].to_numpy()
        sample = sample.filter(pa.array(np.diff(ids, prepend=ids[0] - 1) != 0)).sort_by([("place", "ascending"), ("id", "ascending")])
        column = sample["slots"].combine_chunks()
        flat, ends = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
        model = train([flat[a:b] for a, b in zip(ends[:-1], ends[1:])], [chosen[i] for i in sample["id"].to_pylist()], alpha, beta, l1, l2, epochs)
        return pa.table({"slot": pa.array([-1, *model.slots], pa.int32()), "weight": pa.array([model.constant, *model.weights], pa.float64())})

    ids = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in chosen], "id long"))  # no more than the sample's rows
    own = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).join(ids, "id").where(F.octet_length("text") <= sample_bytes)
    own = own.select(F.lit(1).alias("one"), "id", order.alias("place"), F.xxhash64("text").alias("own"), "text")
    sample = spread(own).mapInArrow(made, "one int, id long, place long, own long, slots array<int>")
    told = sample.groupBy("one").applyInArrow(learnt, "slot int, weight double").collect()  # in the order of slots, the constant first
    return Model(np.array([r["slot"] for r in told[1:]], np.int32), np.array([r["weight"] for r in told[1:]]), told[0]["weight"])


def scorer(m: Model):
    """A text's score, worked out text by text, so that equal texts score alike in any batch."""
    words, weight = Words(), np.zeros(1 << BITS)
    weight[m.slots] = m.weights
    wanted = weight != 0

    def of(text: bytes) -> float:
        z = float(weight[words.features(text, wanted)].sum()) + m.constant
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    return of


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score double) for every row: nearer 1 for toxic text; whole texts, null as empty.

    Repeated rows get a row each; an empty table gives an empty result; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.slots, model.weights, model.constant))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer(Model(*sent.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([of(t or b"") for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary"))).mapInArrow(rows, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``threshold``; null texts are scored as empty ones, repeated rows alike."""
    sent = docs.sparkSession.sparkContext.broadcast((model.slots, model.weights, model.constant))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = scorer(Model(*sent.value))
        for texts in batches:
            yield pd.Series([of(t or b"") for t in texts], dtype="float64")

    return docs.where(scored(F.col(text_col).cast("binary")) < threshold)


def in_training(id_col: str = "doc_id") -> Column:
    """Ids whose decimal text's CRC-32 modulo 4 isn't 2; null ids are never trained on."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(False))
