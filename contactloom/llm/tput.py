"""Ranked search by three passes with a uniform threshold over term-partitioned postings.

The index holds a list of postings for each term, best impact first; ranges of (term, impact) are its parts,
so a frequent term's list is several parts and a list's head stands at their start.  Documents that no
question can tell apart, because they have the same length and the same asked terms, are one entry.

A batch of questions then takes three passes.  The heads of its lists give each question a lower bound of its k-th
score.  A fraction of the bound gives a threshold, one for all lists of the question, under which an entry that is in none of
the fetched parts can't reach that fraction; postings from the threshold on go to blocks of entries, which sum them, bound
what is missing from above and keep what may still be among the best.  These candidates' exact
scores are then looked up in all lists.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import spread
from .decontam import SLOTS, term_bitmap, words_of
from .scratch import write_table

BLOCK_BITS = 14  # entries that are summed together
SMALL = 1_000_000  # rows of a table that is sent to every task; a larger one is joined by exchange
SLACK = 16  # what no fetched part holds of an entry is no more than one in so many of the bound
PAIRS_AT_ONCE = 100_000  # (question, term) pairs of a batch, 24 bytes each in every task

_ENTRIES = "row long, doc_id long, n long, alike binary, terms array<string>, times array<int>"
_ENTRIES_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("alike", pa.binary()), ("terms", pa.list_(pa.string())), ("times", pa.list_(pa.int32()))])


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


def questions(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, q, term, times): the terms of every row of ``items`` and how often each occurs in it; ``q`` is the row's number."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = TaskContext.get().partitionId() << 33
        for b in batches:
            for item, text in zip(*[c.to_pylist() for c in b.columns]):
                counted = Counter(words_of(text or b""))
                if counted:
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(counted), pa.string()), pa.array([q] * len(counted), pa.int64()), pa.array(list(counted), pa.binary()).cast(pa.string()), pa.array(list(counted.values()), pa.int64())], ["item_id", "q", "term", "times"])
                q += 1

    return write_table(items.select(F.col(item_col).cast("string"), F.col(text_col).cast("binary")).mapInArrow(rows, "item_id string, q long, term string, times long"), "questions")


class Index:
    """Postings of the asked terms: ``postings`` (term, impact, row, place), ``entries`` and what the weights need.

    ``place`` counts a term's postings inside a part of the index; the first ``depth`` of each part hold the list's head.
    """

    def __init__(self, docs: DataFrame, asked: DataFrame, id_col: str, text_col: str) -> None:
        terms = asked.select("term").distinct()
        self.terms = write_table(terms.select("term", F.monotonically_increasing_id().alias("id")), "search-terms")
        self.n_terms = self.terms.count()
        self.entries = write_table(self._entries(docs, id_col, text_col, term_bitmap(self.terms)), "search-entries")
        self.n, self.length = self.entries.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        self._postings()

    def _entries(self, docs: DataFrame, id_col: str, text_col: str, wanted: np.ndarray) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(wanted)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            row, known, slots = TaskContext.get().partitionId() << 33, {}, sent.value
            for b in batches:
                for at in range(0, b.num_rows, 500):
                    part = b.slice(at, 500)
                    made = []
                    for doc_id, text in zip(*[c.to_pylist() for c in part.columns]):
                        words = words_of(text or b"")
                        counted = Counter(words)
                        for w in counted:
                            if w not in known:
                                known[w] = bool(slots[xxhash.xxh64_intdigest(w, 42) & (SLOTS - 1)])
                        kept = sorted((w, c) for w, c in counted.items() if known[w])
                        if len(known) > 500_000:
                            known.clear()
                        terms, times = [w for w, _ in kept], np.fromiter((c for _, c in kept), np.int32, len(kept))
                        alike = xxhash.xxh3_128_digest(b"%d " % len(words) + b" ".join(terms) + b"\0" + times.tobytes()) if kept else None
                        made.append((row, doc_id, len(words), alike, pa.array(terms, pa.binary()).cast(pa.string()), times))
                        row += 1
                    columns = list(zip(*made))
                    offsets = np.concatenate([[0], np.cumsum([len(t) for t in columns[5]])])
                    lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), v) for v in (pa.concat_arrays(columns[4]), pa.array(np.concatenate(columns[5])))]
                    yield pa.RecordBatch.from_arrays([pa.array(columns[k], f.type) for k, f in enumerate(_ENTRIES_ARROW) if k < 4] + lists, schema=_ENTRIES_ARROW)

        return spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))).mapInArrow(rows, _ENTRIES)

    def _postings(self) -> None:
        place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
        groups = self.entries.where("alike is not null").groupBy("alike").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
        #: One entry for all documents alike: that of the least doc_id.
        self.groups = write_table(groups.select("alike", F.col("first")["row"].alias("row"), F.col("first")["doc_id"].alias("doc_id"), "copies"), "search-groups")
        repeated = self.groups.where("copies > 1").select("alike", F.col("row").alias("own"))
        others = write_table(self.entries.select("alike", "row").join(repeated, "alike").where("row <> own").select("row"), "search-copies")
        single = self.entries.where("alike is not null").join(small(others, others.count()), "row", "left_anti")
        known = small(self.terms, self.n_terms)
        frequency = self.entries.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).join(known, "term").select("id", "df")
        weight = F.floor(1000 * F.log((2 * F.lit(self.n) + 2).cast("double") / (2 * F.col("df") + 1)))
        self.weights = write_table(frequency.select("id", weight.cast("long").alias("weight")), "search-weights")
        size = F.lit(75) + (F.expr(f"(25 * n * {self.n}L) div {max(self.length, 1)}L") if self.length else 0)
        spots = single.select("row", size.cast("long").alias("m"), F.explode(F.arrays_zip("terms", "times")).alias("t")).select("row", "m", F.col("t.terms").alias("term"), F.col("t.times").cast("long").alias("tf"))
        impact = F.expr("cast((1000000000 * tf) div (1000 * tf + 12 * m) as int)")
        listed = write_table(spots.join(known, "term").select(F.col("id").alias("term"), impact.alias("impact"), "row"), "search-postings")
        laid = listed.repartitionByRange("term", F.col("impact").desc(), "row").sortWithinPartitions("term", F.col("impact").desc(), "row")
        self.postings = write_table(laid.mapInArrow(_placed, "term long, impact int, row long, place long"), "search-lists")
        self.best = write_table(self.postings.where("place = 0").groupBy("term").agg(F.max("impact").cast("long").alias("best")), "search-best")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts the rows of a term as they come, over the batches of a part."""
    last, seen = None, 0
    for b in batches:
        term = b.column("term").to_numpy()
        if not len(term):
            continue
        starts = np.concatenate([[0], np.flatnonzero(np.diff(term)) + 1])
        sizes = np.diff(np.concatenate([starts, [len(term)]]))
        place = np.arange(len(term)) - np.repeat(starts, sizes)
        if term[0] == last:
            place[: sizes[0]] += seen
        last, seen = term[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.int64())], ["term", "impact", "row", "place"])


def level(best: np.ndarray, bound: int) -> int:
    """The largest score such that entries with no more than that in any list stay under ``bound``.

    ``best`` are the lists' best scores: a list adds no more than its own best.
    """
    rest, n = bound - 1, len(best)
    for i, most in enumerate(np.sort(best).tolist()):
        if (even := rest // (n - i)) < most:
            return even
        rest -= most
    return int(best.max(initial=0))


def best_first(k: int, low: np.ndarray, high: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    """What may still be among the ``k`` best, by sums known so far, sums possible, and ids: all that isn't behind k others in any case."""
    if len(low) <= k:
        return np.arange(len(low))
    near = np.flatnonzero(low >= np.partition(low, len(low) - k)[len(low) - k])
    order = near[np.lexsort([doc_id[near], -low[near]])]
    last = order[k - 1]
    return np.flatnonzero((high > low[last]) | (high == low[last]) & (doc_id <= doc_id[last]))


def _answers(index: Index, pairs: DataFrame, k: int, depth: int) -> DataFrame:
    """(q, row, doc_id, score): the ``k`` best entries of a batch's questions; ``pairs`` is (q, term, weight, best), at most some hundred thousand rows."""
    spark = pairs.sparkSession
    of = pairs.toArrow().sort_by([("q", "ascending"), ("term", "ascending")])
    asked = F.broadcast(pairs)
    # First pass: lists' heads, and the k-th best of the sums of these.
    top = F.row_number().over(Window.partitionBy("term").orderBy(F.col("impact").desc(), "row"))
    heads = index.postings.where(F.col("place") < depth).withColumn("r", top).where(F.col("r") <= depth)
    sums = heads.join(asked, "term").groupBy("q", "row").agg(F.sum(F.col("weight") * F.col("impact")).alias("low"))
    kth = sums.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.col("low").desc()))).where(F.col("r") <= k)
    bound = {r["q"]: r["low"] for r in kth.where(F.col("r") == k).collect()}
    # Second pass: a uniform threshold for each question, and for each list the least impact that any question asks for.
    q, term, weight, best = (of[c].to_numpy().astype(np.int64) for c in ("q", "term", "weight", "best"))
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(q)) + 1, [len(q)]]) if len(q) else np.zeros(1, np.int64)
    limit = np.empty(len(q), np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        limit[a:b] = max(0, level(weight[a:b] * best[a:b], bound.get(int(q[a]), 0) // SLACK))
    least = limit // weight + 1
    order = np.argsort(term, kind="stable")
    listed, first = np.unique(term[order], return_index=True)
    bars = np.minimum.reduceat(least[order], first) if len(order) else least
    sent = spark.sparkContext.broadcast((cuts, q, term, weight, least, np.minimum(limit, weight * best)))
    barred = F.broadcast(spark.createDataFrame([(int(t), int(x)) for t, x in zip(listed, bars)], "term long, bar long"))
    fetched = index.postings.join(barred, "term").where("impact >= bar").select(F.shiftright("row", BLOCK_BITS).alias("block"), "row", "term", "impact")
    held = index.groups.select(F.shiftright("row", BLOCK_BITS).alias("block"), "row", "doc_id")

    def block(postings: pa.Table, entries: pa.Table) -> pa.Table:
        cuts, q, term, weight, least, most = sent.value
        names = ["q", "row", "doc_id", "low", "high"]
        if not postings.num_rows:
            return pa.table([pa.array([], pa.int64())] * 5, names)
        base = postings["block"][0].as_py() << BLOCK_BITS
        size = 1 << BLOCK_BITS
        ids = np.full(size, np.iinfo(np.int64).max)
        ids[entries["row"].to_numpy() - base] = entries["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        of, place, impact = postings["term"].to_numpy(), (postings["row"].to_numpy() - base).astype(np.int32), postings["impact"].to_numpy()
        order = np.lexsort([-impact, of])
        of, place, impact = of[order], place[order], impact[order].astype(np.int64)
        falling = -impact
        lists, first = np.unique(of, return_index=True)
        ends = np.append(first[1:], len(of))
        spot = np.searchsorted(lists, term)
        there = (spot < len(lists)) & (lists[np.minimum(spot, len(lists) - 1)] == term)
        out = []
        low, missing = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            low[:] = 0
            missing[:] = 0
            for i in np.flatnonzero(there[a:b]) + a:
                s, e = first[spot[i]], ends[spot[i]]
                e = s + int(np.searchsorted(falling[s:e], -least[i], "right"))
                # A list has an entry once at most.
                low[place[s:e]] += weight[i] * impact[s:e]
                missing[place[s:e]] += most[i]
            rows = np.flatnonzero(low)
            found = low[rows]
            kept = best_first(k, found, found + most[a:b].sum() - missing[rows], ids[rows])
            rows = rows[kept]
            out.append((np.full(len(rows), q[a]), rows + base, ids[rows], found[kept], found[kept] + most[a:b].sum() - missing[rows]))
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names)

    schema = "q long, row long, doc_id long, low long, high long"
    near = write_table(fetched.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(block, schema), "search-near")
    last = near.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.col("low").desc(), "doc_id"))).where(F.col("r") <= k).where(F.col("r") == k)
    bars = F.broadcast(last.select("q", F.col("low").alias("bar"), F.col("doc_id").alias("last")))
    candidates = write_table(near.join(bars, "q", "left").where("bar is null or high > bar or (high = bar and doc_id <= last)").select("q", "row", "doc_id"), "search-candidates")
    # Third pass: the candidates' exact scores, from all lists.
    n = candidates.count()
    spots = index.postings.join(small(candidates.select("row").distinct(), n), "row").select("row", "term", "impact")
    scored = spots.join(small(candidates, n), "row").join(asked, ["q", "term"]).groupBy("q", "row", "doc_id").agg(F.sum(F.col("weight") * F.col("impact")).alias("score"))
    best_k = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "doc_id", "row"))
    return write_table(scored.where("score > 0").withColumn("r", best_k).where(F.col("r") <= k).drop("r"), "search-best-entries")


def search(docs: DataFrame, items: DataFrame, k: int = 20, depth: int = 100, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """(item_id, rank, doc_id, score): for every row of ``items`` the ``k`` best rows of ``docs`` with a score above 0, best first.

    Equal scores go by ascending doc_id, null ids last, then in any order.  Null and empty texts, and an empty table on either side, give
    no rows; repeated documents are ranked each, repeated items are asked each; a null item_id is an id like
    others; other columns are ignored.  ``depth`` is the length of the lists' heads and changes no result.
    Questions are asked in batches of about ``pairs_at_once`` terms, so there may be any number of them.
    """
    asked = questions(items, item_col, item_text)
    index = Index(docs, asked, id_col, text_col)
    known = small(index.terms, index.n_terms)
    pairs = asked.join(known, "term").join(index.weights, "id").join(index.best.withColumnRenamed("term", "id"), "id").select("q", F.col("id").alias("term"), (F.col("weight") * F.col("times")).alias("weight"), "best")
    pairs = write_table(pairs.where("weight > 0"), "search-pairs")
    batches = max(1, -(-pairs.count() // pairs_at_once))
    answers = [_answers(index, pairs.where(F.pmod(F.xxhash64("q"), F.lit(batches)) == b), k, depth) for b in range(batches)]
    entries = reduce(DataFrame.unionByName, answers)
    # All documents of an entry have its score; no more than k of them are asked for.
    won = entries.select(F.col("row").alias("entry")).distinct()
    n = won.count()
    own = index.groups.select("alike", F.col("row").alias("entry")).join(small(won, n), "entry")
    first = F.row_number().over(Window.partitionBy("entry").orderBy(F.col("doc_id").asc_nulls_last(), "row"))
    members = index.entries.select("alike", "row", "doc_id").join(small(own, n), "alike").withColumn("r", first).where(F.col("r") <= k).select("entry", "row", "doc_id")
    told = members.join(entries.select("q", F.col("row").alias("entry"), "score"), "entry")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"))
    return told.withColumn("rank", rank).where(F.col("rank") <= k).join(asked.select("q", "item_id").distinct(), "q").select(F.col("item_id").cast(items.schema[item_col].dataType).alias("item_id"), "rank", "doc_id", "score")
