"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by documents, as a search cluster's is: each shard holds, for the terms of its
documents, the ascending positions at which they have that term.  It is written once; where it is built for one
test set, a bitmap of fixed size leaves out most terms that the test set doesn't have.  A test set is asked
by joins: the windows of its items, each word with its offset and its frequency in the whole corpus, go to
the shards that hold their rarest term; there the lists are shifted by the offsets and intersected, rarest first.
Neither the index's terms nor the windows pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .scratch import Rows, fresh, write_table

#: Words are runs of [0-9a-z] and of characters beyond ASCII, after A-Z are lower-cased.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SLOTS = 1 << 22
GAP = 128  # free positions between documents, so that nothing reaches from one into the next

INDEX = "shard long, doc_id long, file long, at long, base int, n_words long, term string, places array<int>"
_ARROW = pa.schema([("shard", pa.int64()), ("doc_id", pa.int64()), ("file", pa.int64()), ("at", pa.int64()), ("base", pa.int32()), ("n_words", pa.int64()), ("term", pa.string()), ("places", pa.list_(pa.int32()))])
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def term_bitmap(terms: DataFrame) -> np.ndarray:
    """Which of 2^22 hash slots the terms (term string) take; 4 MB, however many terms there are."""
    slots = terms.select(F.xxhash64("term").bitwiseAND(SLOTS - 1).cast("int").alias("slot")).distinct().toArrow()["slot"].to_numpy()
    taken = np.zeros(SLOTS, bool)
    taken[slots] = True
    return taken


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 16 << 20, name: Column | None = None, wanted: np.ndarray | None = None) -> DataFrame:
    """The index as a written table: a row for each document, and one for each shard and term in it.

    ``name`` is a struct of file and at that names each row; without one both are null.  ``wanted``, from
    ``term_bitmap``, leaves out terms whose slot no wanted term takes; without it the index serves any test set.
    """
    sent = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def batch(size: int, shard: int, **columns: pa.Array) -> pa.RecordBatch:
        columns["shard"] = pa.array(np.full(size, shard, np.int64))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _ARROW], schema=_ARROW)

    def out(shard: int, documents: list[tuple], code_of: dict[bytes, int], terms: list[np.ndarray], places: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids, files, ats, bases, counts = zip(*documents)
        yield batch(len(ids), shard, doc_id=pa.array(ids, pa.int64()), file=pa.array(files, pa.int64()), at=pa.array(ats, pa.int64()), base=pa.array(bases, pa.int32()), n_words=pa.array(counts, pa.int64()))
        code, place, listed = np.concatenate(terms), np.concatenate(places), list(code_of)
        if sent is not None:
            keep = sent.value[np.fromiter((xxhash.xxh64_intdigest(t, 42) & (SLOTS - 1) for t in listed), np.int64, len(listed))]
            place, code = place[keep[code]], (np.cumsum(keep) - 1)[code[keep[code]]]
            listed = [t for t, k in zip(listed, keep.tolist()) if k]
        place = place[np.argsort(code, kind="stable")].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(listed)))])
        for at in range(0, len(listed), 50_000):
            part = listed[at : at + 50_000]
            cut = ends[at : at + len(part) + 1]
            lists = pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), pa.array(place[cut[0] : cut[-1]]))
            yield batch(len(part), shard, term=pa.array(part, pa.binary()).cast(pa.string()), places=lists)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 24
        documents: list[tuple] = []
        for b in batches:
            for doc_id, text, file, at in zip(*[c.to_pylist() for c in b.columns]):
                if not documents:
                    size, base, code_of, terms, places = 0, GAP, {}, [], []
                words, place = words_of(text or b""), code_of
                terms.append(np.fromiter((place.setdefault(w, len(place)) for w in words), np.int32, len(words)))
                places.append(np.arange(base, base + len(words)))
                documents.append((doc_id, file, at, base, len(words)))
                base += len(words) + GAP
                size += len(text or b"")
                if size >= shard_bytes:
                    yield from out(shard, documents, code_of, terms, places)
                    shard, documents = shard + 1, []
        if documents:
            yield from out(shard, documents, code_of, terms, places)

    name = F.lit(None).cast("struct<file:long,at:long>") if name is None else name
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), name["file"].alias("file"), name["at"].alias("at"))
    table = spread(table).mapInArrow(rows, INDEX)
    return write_table(table, "positional-index")


def windows_of(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(window long, words) of the distinct windows of ``size`` consecutive words, and (window, item) of the items that hold them; a shorter item is one window."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(*[c.to_pylist() for c in b.columns]):
                words = words_of(text or b"")
                found = sorted({b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1) if words else 0)})
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string())], ["item", "words"])

    held = write_table(benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("binary")).mapInArrow(rows, "item string, words string"), "item-windows")
    windows = write_table(held.select("words").distinct().select(F.monotonically_increasing_id().alias("window"), "words"), "windows")
    return windows, write_table(held.join(windows, "words").select("window", "item").distinct(), "window-items")


def matches(index: DataFrame, windows: DataFrame, slop: int, near_terms: int, windows_at_once: int) -> DataFrame:
    """(shard, base, spans, exact, near): the documents with matches, the disjoint stretches of their words inside windows, and the windows found."""
    placed = windows.select("window", F.posexplode(F.split("words", " ")).alias("offset", "term"))
    terms = write_table(placed.select("term").distinct().select("term", F.monotonically_increasing_id().alias("id")), "terms")
    postings = write_table(index.where("term is not null").select("shard", "term", "places").join(terms, "term").select("shard", "id", "places"), "postings")
    frequency = postings.groupBy("id").agg(F.sum(F.size("places")).alias("n"))
    ranked = placed.join(terms.join(frequency, "id"), "term", "left").select("window", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset", "id").alias("t"))
    # A window has at most ``size`` words; one with a word that no document has occurs nowhere.
    plan = ranked.groupBy("window").agg(F.array_sort(F.collect_list("t")).alias("t")).where("t[0].n > 0")
    chunks = max(1, -(-windows.count() // windows_at_once))
    plan = plan.select("window", F.col("t")[0]["id"].alias("id"), F.transform("t", lambda t: t["id"]).alias("ids"), F.transform("t", lambda t: t["offset"]).alias("offsets"), F.pmod("window", F.lit(chunks)).alias("chunk"))
    routed = plan.join(postings.select("shard", "id"), "id").select(F.col("shard").alias("s"), F.col("chunk").alias("c"), "window", "ids", "offsets")
    documents = index.where("term is null").select("shard", F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<int>").alias("places"), "base", "n_words")
    lists = postings.select("shard", "id", "places", F.lit(None).cast("int").alias("base"), F.lit(None).cast("long").alias("n_words"))
    asked = documents.unionByName(lists).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"))

    def shard(held: pa.Table, asked: pa.Table) -> pa.Table:
        if not held.num_rows or not asked.num_rows:
            return pa.table({"shard": pa.array([], pa.int64()), "base": pa.array([], pa.int32()), "spans": pa.array([], _SPANS), "exact": pa.array([], pa.list_(pa.int64())), "near": pa.array([], pa.list_(pa.int64()))})
        of_term = held["id"].is_valid()
        documents, lists = held.filter(held["id"].is_null()), held.filter(of_term)
        bases = np.sort(documents["base"].to_numpy())
        column = lists["places"].combine_chunks()
        flat, ends = column.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        places = {t: flat[ends[i] : ends[i + 1]] for i, t in enumerate(lists["id"].to_pylist())}
        steps: list[np.ndarray] = []
        exact: dict[int, set[int]] = {}
        near: dict[int, set[int]] = {}
        for window, terms, offsets in zip(asked["window"].to_pylist(), asked["ids"].to_pylist(), asked["offsets"].to_pylist()):
            first = places[terms[0]]
            starts = first - offsets[0]
            for t, offset in zip(terms[1:], offsets[1:]):
                if not len(starts) or t not in places:
                    starts = starts[:0]
                    break
                starts = starts[_among(starts + offset, places[t])]
            if len(starts):
                steps.append(np.stack([starts, starts + len(terms)]))
                for d in np.unique(np.searchsorted(bases, starts, "right") - 1).tolist():
                    exact.setdefault(d, set()).add(window)
            close = first
            for t, offset in zip(terms[1:near_terms], offsets[1:near_terms]):
                if not len(close) or t not in places:
                    close = close[:0]
                    break
                reach = abs(offset - offsets[0]) + slop
                close = close[np.searchsorted(places[t], close + reach, "right") > np.searchsorted(places[t], close - reach)]
            for d in np.unique(np.searchsorted(bases, close, "right") - 1).tolist():
                near.setdefault(d, set()).add(window)
        spans: dict[int, list[dict]] = {}
        for a, b in zip(*_joined(steps)):
            spans.setdefault(int(np.searchsorted(bases, a, "right")) - 1, []).append({"first": a, "end": b})
        found = sorted(exact.keys() | near.keys())
        return pa.table({
            "shard": pa.array([held["shard"][0].as_py()] * len(found), pa.int64()), "base": pa.array(bases[found] if found else [], pa.int32()), "spans": pa.array([spans.get(d, []) for d in found], _SPANS),
            **{n: pa.array([sorted(x.get(d, ())) for d in found], pa.list_(pa.int64())) for n, x in (("exact", exact), ("near", near))}})

    return asked.groupBy("shard", "chunk").cogroup(routed.groupBy("s", "c")).applyInArrow(shard, "shard long, base int, spans array<struct<first:int,end:int>>, exact array<long>, near array<long>")


def _among(wanted: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = np.searchsorted(places, wanted)
    return (at < len(places)) & (places[np.minimum(at, len(places) - 1)] == wanted)


def _joined(steps: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of stretches."""
    if not steps:
        return [], []
    first, end = np.concatenate(steps, axis=1)
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], first[1:] > reach[:-1]])
    return first[new].tolist(), reach[np.concatenate([new[1:], [True]])].tolist()


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 13, slop: int = 8, near_terms: int = 4, shard_bytes: int = 16 << 20, windows_at_once: int = 100_000, name: Column | None = None) -> DataFrame:
    """One row for every row of ``docs``: (doc_id, n_words, n_hit, items, near_items, file, at).

    ``n_hit`` counts the words inside any occurrence of a window of test words; ``items`` are the ids,
    as strings and sorted so, of items with an occurring window; ``near_items`` those with a window
    whose ``near_terms`` rarest words occur within ``slop`` of their distances.  Null and empty texts,
    and items without words, match nothing; a null item_id is no item of the lists, but its windows hit; repeated rows get a row each; an empty table on either
    side gives no matches; other columns are ignored.  The test set may have any size: a shard is asked
    ``windows_at_once`` windows at a time.
    """
    windows, items = windows_of(benchmark, item_col, item_text, window)
    index = build_index(docs, id_col, text_col, shard_bytes, name, term_bitmap(windows.select(F.explode(F.split("words", " ")).alias("term"))))
    found = write_table(matches(index, windows, slop, near_terms, windows_at_once), "matches")
    # Disjoint stretches of each question, then of all: no more than the document has words.
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(spans, start, lambda s, x: F.struct(F.greatest(s["reach"], x["end"]).alias("reach"), (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["reach"], x["first"]))).alias("n")))["n"]
    hits = found.groupBy("shard", "base").agg(covered.alias("n_hit"))
    pairs = found.select("shard", "base", F.explode("exact").alias("window"), F.lit(True).alias("exact")).unionByName(found.select("shard", "base", F.explode("near").alias("window"), F.lit(False).alias("exact")))
    owners = pairs.join(items, "window").groupBy("shard", "base").agg(*[F.array_sort(F.collect_set(F.when(F.col("exact") == e, F.col("item")))).alias(c) for e, c in ((True, "items"), (False, "near_items"))])
    told = index.where("term is null").select("shard", "base", "doc_id", "n_words", "file", "at").join(hits.join(owners, ["shard", "base"], "left"), ["shard", "base"], "left")
    none = F.array().cast("array<string>")
    return told.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"), "file", "at")


def is_contaminated(n_hit="n_hit", n_words="n_words"):
    """A twentieth of the words or more inside occurring windows, and at least one."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't contaminated.

    Null and empty texts stay, and so do all rows of an empty test set; repeated rows stay or go together;
    columns of any names stay as they are.  What isn't a plain read of Parquet files is written first.
    """
    rows = Rows(docs)
    found = find_contamination(rows.docs, benchmark, id_col, text_col, name=rows.name(), **options)
    file, at = fresh("_file", docs), fresh("_at", docs)
    dirty = found.where(is_contaminated()).select(F.col("file").alias(file), F.col("at").alias(at))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return rows.docs.select(*own, rows.file().alias(file), rows.at().alias(at)).join(dirty, [file, at], "left_anti").select(*own)
