"""Compression classifier: how much better a dictionary of good text compresses a text than one of bad text.

Two zstandard dictionaries come from labelled texts.  A text is compressed with each; the difference
of the sizes over their sum, with the compressed share of the text and its length, goes through a
logistic curve fitted on labelled texts that no dictionary has seen.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .scratch import fresh


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    raw: bool
    level: int
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


def _dictionary(samples: list[bytes], size: int) -> tuple[bytes, bool]:
    """A trained dictionary; for too few samples to train on, their text itself."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes(), False
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:] or b"\n" * 8, True


def _compressor(content: bytes, raw: bool, level: int) -> Callable[[bytes], int]:
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
    held = zstandard.ZstdCompressionDict(content, dict_type=kind)
    held.precompute_compress(level=level)
    compress = zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress
    return lambda text: len(compress(text))


def features(good: bytes, bad: bytes, raw: bool, level: int) -> Callable[[bytes], tuple[float, float, float, float]]:
    """Normalised size difference, that of longer texts, compressed share, and log length; no text: no difference."""
    with_good, with_bad = _compressor(good, raw, level), _compressor(bad, raw, level)

    def of(text: bytes) -> tuple[float, float, float, float]:
        if not text:
            return 0.0, 0.0, 1.0, 0.0
        g, b = with_good(text), with_bad(text)
        share, size = min(2.0, min(g, b) / len(text)), np.log1p(len(text))
        return (b - g) / (b + g), (b - g) / len(text), min(share, 0.3), size

    return of


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights by Newton's method, the last one for the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 1500, sample_bytes: int = 8 << 20, dictionary_bytes: int = 64 << 10, level: int = 3) -> Model:
    """A model from a bounded sample of labelled rows: by label at most ``sample_rows`` rows and ``sample_bytes`` bytes.

    The sample is that of the least hashes of the ids, whole texts; one that doesn't fit into what is left of the bytes is
    passed over.  Two thirds make the dictionaries, one third fits the curve.  A label without texts gives an
    empty dictionary and a flat curve, and so do empty tables.  Null ids, null or empty texts and other labels
    than 0 and 1 are not learnt from; an id with several labels has the larger one, an id with several texts
    the first in order of bytes; other columns are ignored.
    """
    mark, size = fresh("_label", docs, labels), fresh("_size", docs, labels)
    narrow = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias(mark))
    sized = docs.where(F.coalesce(F.octet_length(text_col), F.lit(0)) > 0).select(id_col, F.octet_length(text_col).alias(size)).join(narrow, id_col)
    order = F.xxhash64(F.lit(11), F.col(id_col))
    chosen: dict = {}
    for label in (0, 1):
        left = sample_bytes
        for r in sized.where((F.col(mark) == label) & (F.col(size) <= sample_bytes)).orderBy(order, id_col, size).limit(sample_rows).collect():
            if r[size] <= left:  # a text that doesn't fit leaves room for the next ones
                left -= r[size]
                chosen.setdefault(r[id_col], label)
    # Of rows that share an id the text that comes first in order is read, whatever the order of files.
    own = docs.where(F.col(id_col).isin(list(chosen)) & (F.octet_length(text_col).between(1, sample_bytes)))
    got = {r[0]: bytes(r[1]) for r in own.groupBy(id_col).agg(F.min(F.col(text_col).cast("binary"))).collect()} if chosen else {}
    samples = [(got[i], y, k) for k, (i, y) in enumerate(chosen.items()) if i in got]
    train = [[t for t, y, k in samples if y == label and k % 3] for label in (1, 0)]
    (good, raw_good), (bad, raw_bad) = (_dictionary(t, dictionary_bytes) for t in train)
    raw = raw_good or raw_bad
    if raw:
        good, bad = (b"\n".join(t)[-dictionary_bytes:] or b"\n" * 8 for t in train)
    measure = features(good, bad, raw, level)
    rest = [(measure(t), y) for t, y, k in samples if k % 3 == 0] or [((0.0, 0.0, 1.0, 0.0), 1)]
    x, y = np.array([f for f, _ in rest]), np.array([v for _, v in rest], float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    return Model(good, bad, raw, level, tuple(mean), tuple(scale), tuple(_logistic((x - mean) / scale, y)))


def scorer(m: Model) -> Callable[[bytes], float]:
    """A text's score, worked out text by text, so that equal texts score alike in any batch."""
    measure, parts = features(m.good, m.bad, m.raw, m.level), list(zip(m.mean, m.scale, m.weights))

    def of(text: bytes) -> float:
        z = sum(((v - mean) / scale * w for v, (mean, scale, w) in zip(measure(text), parts)), m.weights[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    return of


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score double) for every row: nearer 1 for text like the good one; whole texts, null as empty.

    Repeated rows get a row each; an empty table gives an empty result; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer(Model(*sent.value))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([of(t or b"") for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary"))).mapInArrow(rows, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more; null texts are scored as empty ones.

    Repeated rows stay or go together, a score of just ``threshold`` stays; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(astuple(model))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = scorer(Model(*sent.value))
        for texts in batches:
            yield pd.Series([of(t or b"") for t in texts], dtype="float64")

    return docs.where(scored(F.col(text_col).cast("binary")) >= threshold)


def in_training(id_col: str = "doc_id", parts: int = 5) -> Column:
    """Ids whose decimal text's CRC-32 isn't divisible by ``parts``; null ids are never trained on."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts != 0, F.lit(False))
