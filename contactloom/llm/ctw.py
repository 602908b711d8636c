"""Context-tree weighting over bytes, each byte as eight binary decisions.

A node is a context (the last ``d`` bytes, d from 0 to ``depth``) with the bits of the next byte so
far.  Its Krichevsky-Trofimov estimate comes from the counts of its next bit; its weighted
probability is half that estimate's block probability and half the product over its children one
byte longer.  Every node then has an estimate and the posterior weight of stopping there; a bit's
probability mixes the estimates along its path by these weights.

A gram is a context of ``depth`` bytes, the last one first, and the byte after it.  The corpus's distinct grams
stand in order, cut into parts of bounded size, so a part holds whole subtrees but for those of its first
and its last context at every depth.  Parts weigh their own subtrees; the nodes of the cut contexts, a few
for each part, are summed and weighted by Spark level by level and go back to the parts, which then know
the cost of every gram.  Costs are joined to the grams of each block of documents.  No node is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .scratch import drop_table, write_table

EDGE = 0xFF  # never in UTF-8: stands before a text's start and is its last symbol
AT_ONCE = 1 << 18  # grams that a task works on at once
RUN_BYTES = 4 << 20  # text whose words stand apart at once
BITS_AT = 48  # a node's key: the bits so far, then up to six bytes of context


def normal(text: bytes) -> bytes:
    """ASCII letters lower-cased, words joined by single spaces."""
    return b" ".join(text.lower().split())


def grams(text: bytes, depth: int) -> Iterator[np.ndarray]:
    """For every byte of the text and its end: the ``depth`` bytes before it, the last one first, and itself, as one number.

    A shorter context is so a prefix of a longer one.  Parts are bounded, whatever the text's length.
    """
    kind = np.uint32 if depth <= 3 else np.uint64
    joined = bytes([EDGE]) * depth + text + bytes([EDGE])
    for at in range(0, len(text) + 1, AT_ONCE):
        part = np.frombuffer(joined[at : at + AT_ONCE + depth], np.uint8)
        n = len(part) - depth
        out = part[depth - 1 : depth - 1 + n].astype(kind)
        for k in [*range(depth - 2, -1, -1), depth]:
            out = (out << kind(8)) | part[k : k + n]
        yield out


def packed_grams(texts: Iterator[tuple[int, bytes]], depth: int, at_once: int = AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of numbered or marked texts that ``normal`` has been through, and the numbers or marks of their texts, in parts of bounded size."""
    held: list[np.ndarray] = []
    owners: list[int] = []
    size = 0
    for owner, text in texts:
        for part in grams(text, depth):
            held.append(part)
            owners.append(owner)
            size += len(part)
            if size >= at_once:
                yield np.concatenate(held), np.repeat(owners, [len(h) for h in held])
                held, owners, size = [], [], 0
    if held:
        yield np.concatenate(held), np.repeat(owners, [len(h) for h in held])


def counted(values: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, of under 63 bits, in order, and how often each is marked; sorting numbers alone takes no hash table and no places."""
    key = values.astype(np.uint64)
    key <<= 1
    key |= marked
    key.sort()
    value = key >> 1
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    return value[first].astype(np.int64), np.add.reduceat((key & 1).astype(np.int64), first)


def added(value: np.ndarray, count: np.ndarray, more: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending values and their counts, with further ones of the same kind; ``count`` is written to."""
    at = np.searchsorted(value, more)
    known = np.append(value, -1)[at] == more
    count[at[known]] += counts[known]
    return np.insert(value, at[~known], more[~known]), np.insert(count, at[~known], counts[~known])


def costs_at(gram: np.ndarray, cost: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The cost of each gram of a part; ``gram`` ascends.  Each distinct one is looked up once, in order, so the places read lie near each other."""
    order = np.argsort(part)
    ordered = part[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    out = np.empty(len(part))
    out[order] = np.repeat(cost[np.searchsorted(gram, ordered[first].astype(np.int64))], np.diff(first, append=len(part)))
    return out


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of texts that ``normal`` has been through, one after another, and how many every text has."""
    full = pc.greater(pc.binary_length(texts), 0)
    split = pc.split_pattern(texts.filter(full), " ")
    lengths = np.zeros(len(texts), np.int64)
    lengths[full.to_numpy(zero_copy_only=False)] = pc.list_value_length(split).to_numpy()
    return split.flatten().dictionary_encode(), lengths


def in_runs(documents: list[tuple]) -> Iterator[list[tuple]]:
    """Documents (doc_id, text, held_out) in runs of at most 1,000 and about ``RUN_BYTES`` of text."""
    run, size = [], 0
    for d in documents:
        run.append(d)
        size += len(d[1])
        if len(run) == 1000 or size >= RUN_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


GATHERED = "block long, documents binary, learns long, word binary, gram long, n long"
_ARROW = pa.schema([("block", pa.int64()), ("documents", pa.binary()), ("learns", pa.int64()), ("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64())])
_DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])


def packed(documents: list[tuple]) -> bytes:
    """Documents (doc_id, text, held_out) as a compressed Arrow stream: exchanges compress far less."""
    ids, texts, outs = zip(*documents)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _DOCUMENTS, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(outs, pa.bool_()), pa.array(texts, pa.binary())], schema=_DOCUMENTS))
    return sink.getvalue().to_pybytes()


def unpacked(streams: pa.ChunkedArray) -> pa.Table:
    """(doc_id, held_out, text) of what ``packed`` made."""
    return pa.concat_tables([pa.ipc.open_stream(s.as_buffer()).read_all() for s in streams])


def gathered(docs: DataFrame, depth: int, block_bytes: int) -> DataFrame:
    """Documents (doc_id, text, held_out) in blocks of bounded text, as rows of three kinds.

    (block, documents, learns) for each run of a block's documents, their texts as ``normal`` leaves them and packed, and
    how many of them are training texts; (block, word, n) and (block, gram, n) for each distinct word and gram of a
    block, with their counts in its training texts.
    """
    def batch(size: int, number: int, **columns: pa.Array) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(size, number, np.int64))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _ARROW], schema=_ARROW)

    def block_rows(number: int, documents: list[tuple]) -> Iterator[pa.RecordBatch]:
        found: list[pa.Array] = []
        learnt: list[np.ndarray] = []
        for run in in_runs(documents):
            learns = ~np.array([out for *_, out in run], bool)
            yield batch(1, number, documents=pa.array([packed(run)], pa.binary()), learns=pa.array([learns.sum()], pa.int64()))
            words, lengths = words_of(pa.array([text for _, text, _ in run], pa.binary()))
            found.append(words.dictionary)
            learnt.append(np.bincount(words.indices.to_numpy()[np.repeat(learns, lengths)], minlength=len(words.dictionary)))
            del words
        coded = pa.concat_arrays(found).dictionary_encode()
        if len(coded):
            n = np.bincount(coded.indices.to_numpy(), weights=np.concatenate(learnt)).astype(np.int64)
            yield batch(len(n), number, word=coded.dictionary, n=pa.array(n))
        del coded, found, learnt
        pa.default_memory_pool().release_unused()
        gram, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part, learn in packed_grams(((not out, t) for _, t, out in documents), depth, 2 * AT_ONCE):
            gram, count = added(gram, count, *counted(part, learn))
        for at in range(0, len(gram), 100_000):
            own = gram[at : at + 100_000]
            yield batch(len(own), number, gram=pa.array(own), n=pa.array(count[at : at + 100_000]))
        pa.default_memory_pool().release_unused()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what an earlier task of this worker left
        number, held, size = TaskContext.get().partitionId() << 24, [], 0
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                for doc_id, text, out in zip(*[c.to_pylist() for c in b.slice(at, 1000).columns]):
                    held.append((doc_id, normal(text or b""), out))
                    size += len(held[-1][1]) + 1
                    if size >= block_bytes:
                        yield from block_rows(number, held)
                        number, held, size = number + 1, [], 0
        if held:
            yield from block_rows(number, held)

    return docs.mapInArrow(rows, GATHERED)


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x > 0, by Stirling's series at x + 6."""
    y = x + 6
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
    return series - F.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


class Level:
    """A part's nodes with the same number of bytes and bits, by key; ``edge`` marks those of its first and last context, which other parts may share."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None, edge: np.ndarray) -> None:
        self.key, self.zeros, self.ones, self.edge = key, zeros, ones, edge
        self.below = np.zeros(len(key)) if below is None else below
        estimate = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)
        self.weighted = estimate if below is None else np.logaddexp(estimate, below) - math.log(2)
        self.stop = np.ones(len(key)) if below is None else np.exp(estimate - math.log(2) - self.weighted)
        self.p1 = (ones + 0.5) / (zeros + ones + 1.0)

    def passed(self, p: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mixture down to these nodes and what of it is left for those below, from the same for their parents."""
        return p + left * self.stop * self.p1, left * (1 - self.stop)


def levels_of(gram: np.ndarray, count: np.ndarray, k: int, depth: int) -> tuple[list[Level], list[np.ndarray]]:
    """Levels from ``depth`` bytes to none of the nodes with ``k`` bits over distinct ascending grams; the places of the grams, then of each level's nodes, in the next.

    Keys are ordered by bits, then context; so parents, one byte shorter, come in order too.
    """
    mask = (1 << BITS_AT) - 1
    byte = gram & 255
    bits = (1 << k) + (byte >> (8 - k))
    order = np.argsort(bits.astype(np.uint8), kind="stable")
    key = (bits << BITS_AT | gram >> 8)[order]
    one = (count * ((byte >> (7 - k)) & 1))[order].astype(float)
    zero = count[order] - one
    ends = int(gram[0]) >> 8, int(gram[-1]) >> 8
    levels: list[Level] = []
    places: list[np.ndarray] = []
    below, climbing = None, None
    for d in range(depth, -1, -1):
        new = np.diff(key, prepend=-1) != 0
        first, of = np.flatnonzero(new), np.cumsum(new) - 1
        key, zero, one = key[first], np.add.reduceat(zero, first), np.add.reduceat(one, first)
        if climbing is not None:
            below = np.add.reduceat(climbing, first)
        context = key & mask
        edge = (context == ends[0] >> 8 * (depth - d)) | (context == ends[1] >> 8 * (depth - d))
        level = Level(key, zero, one, below, edge)
        levels.append(level)
        if d == depth:
            places.append(np.empty(len(order), np.int64))
            places[0][order] = of
        else:
            places.append(of)
        climbing = np.where(edge, 0.0, level.weighted)
        key = key >> BITS_AT << BITS_AT | context >> 8
    return levels, places


def cut_nodes(parts: DataFrame, depth: int) -> DataFrame:
    """(part, d, key, zeros, ones, below) of each part's first and last context at every depth; ``below`` sums the children that no other part shares."""
    def part(group: pa.Table) -> pa.Table:
        order = np.argsort(group["gram"].to_numpy())
        gram, count = group["gram"].to_numpy()[order], group["n"].to_numpy()[order]
        found: list[tuple] = []
        for k in range(8):
            for d, level in zip(range(depth, -1, -1), levels_of(gram, count, k, depth)[0]):
                at = level.edge
                found.append((np.full(at.sum(), d, np.int32), level.key[at], level.zeros[at], level.ones[at], level.below[at]))
        d, key, zeros, ones, below = (np.concatenate(c) for c in zip(*found))
        return pa.table({"part": pa.array(np.full(len(key), group["part"][0].as_py(), np.int32)), "d": d, "key": key, "zeros": zeros, "ones": ones, "below": below})

    return parts.groupBy("part").applyInArrow(part, "part int, d int, key long, zeros double, ones double, below double")


def _parent(key: Column) -> Column:
    context = key.bitwiseAND(F.lit((1 << BITS_AT) - 1).cast("long"))
    return F.shiftleft(F.shiftright(key, BITS_AT), BITS_AT).bitwiseOR(F.shiftright(context, 8))


def weighted_cut_nodes(nodes: DataFrame, depth: int) -> DataFrame:
    """(d, key, p, left) of the cut contexts' nodes: the mixture down to each, and what of it is left for those below.

    Counts of all parts are summed, then levels are weighted from the longest contexts up and passed down again.
    """
    levels: dict[int, DataFrame] = {}
    risen = None
    for d in range(depth, -1, -1):
        own = nodes.where(F.col("d") == d).select("key", "zeros", "ones", "below")
        own = own if risen is None else own.unionByName(risen)
        level = own.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
        estimate = log_gamma(F.col("zeros") + 0.5) + log_gamma(F.col("ones") + 0.5) - log_gamma(F.col("zeros") + F.col("ones") + 1.0) - math.log(math.pi)
        level = level.withColumn("estimate", estimate)
        top = F.greatest("estimate", "below")
        mixed = top + F.log(F.exp(F.col("estimate") - top) + F.exp(F.col("below") - top)) - math.log(2)
        level = level.withColumn("weighted", F.col("estimate") if d == depth else mixed)
        stop = F.lit(1.0) if d == depth else F.exp(F.col("estimate") - math.log(2) - F.col("weighted"))
        p1 = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
        levels[d] = write_table(level.select("key", _parent(F.col("key")).alias("parent"), "weighted", stop.alias("stop"), p1.alias("p1")), f"cut-level-{d}")
        zero = F.lit(0.0)
        risen = levels[d].select(F.col("parent").alias("key"), zero.alias("zeros"), zero.alias("ones"), F.col("weighted").alias("below"))
    found, above = None, None
    for d in range(depth + 1):
        if above is None:
            level = levels[d].withColumn("p_", F.lit(0.0)).withColumn("left_", F.lit(1.0))
        else:
            level = levels[d].join(above.select(F.col("key").alias("parent"), F.col("p").alias("p_"), F.col("left").alias("left_")), "parent")
        passed = level.select("key", (F.col("p_") + F.col("left_") * F.col("stop") * F.col("p1")).alias("p"), (F.col("left_") * (1 - F.col("stop"))).alias("left"))
        above = write_table(passed, f"cut-passed-{d}")
        found = above.select(F.lit(d).alias("d"), "*") if found is None else found.unionByName(above.select(F.lit(d).alias("d"), "*"))
    return found


def gram_costs(grams: DataFrame, depth: int, part_grams: int) -> DataFrame:
    """(gram, cost) of distinct grams (gram long, n long): log10 of each gram's byte given its context.

    A node without counts estimates one half, and so do all below it.
    """
    distinct = write_table(grams, "grams")
    count = max(1, -(-distinct.count() // part_grams))
    parts = write_table(distinct.repartitionByRange(count, "gram").select(F.spark_partition_id().alias("part"), "gram", "n"), "gram-parts")
    drop_table(distinct)
    cut = write_table(cut_nodes(parts, depth), "cut-nodes")
    known = weighted_cut_nodes(cut, depth)
    given = cut.select(F.col("part").alias("of"), "d", "key").join(known, ["d", "key"])

    def part(group: pa.Table, edges: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"gram": pa.array([], pa.int64()), "cost": pa.array([], pa.float64())})
        order = np.argsort(group["gram"].to_numpy())
        gram, n = group["gram"].to_numpy()[order], group["n"].to_numpy()[order]
        depths, keys, ps, lefts = (edges[c].to_numpy() for c in ("d", "key", "p", "left"))
        table = []
        for d in range(depth + 1):
            at = np.flatnonzero(depths == d)
            at = at[np.argsort(keys[at])]
            table.append((keys[at], ps[at], lefts[at]))
        total = np.zeros(len(gram))
        for k in range(8):
            levels, places = levels_of(gram, n, k, depth)
            p, left = np.zeros(1), np.ones(1)
            for d in range(depth + 1):
                level = levels[depth - d]
                if d:
                    of = places[depth - d + 1]
                    p, left = level.passed(p[of], left[of])
                else:
                    p, left = np.zeros(len(level.key)), np.ones(len(level.key))
                at = np.flatnonzero(level.edge)
                place = np.searchsorted(table[d][0], level.key[at])
                p[at], left[at] = table[d][1][place], table[d][2][place]
            one = p[places[0]]
            total += np.log10(np.where((gram >> (7 - k)) & 1 == 1, one, 1 - one))
        return pa.table({"gram": pa.array(gram), "cost": pa.array(total)})

    return parts.groupBy("part").cogroup(given.groupBy("of")).applyInArrow(part, "gram long, cost double")


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = 5, block_bytes: int = 32 << 20, part_grams: int = 1 << 19) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) for every row of ``docs``.

    The tree and the add-one word model learn from all whole texts whose ``held_out`` isn't true; the
    tree is whole, whatever its size; ``depth`` is at most 6.
    ``score`` is the log10 probability that the tree gives to the lower-cased words, joined by single
    spaces, and the end; ``bits_per_byte`` is its code length over ``n_bytes``, the end counted as one.  ``base_score`` sums log10((c+1)/(N+V+1)) over words
    and one end.  Null and empty texts have only the end; repeated rows get a row each; an empty table
    gives an empty result; other columns are ignored.  Without training rows every count is 0.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    table = write_table(gathered(spread(narrow), depth, block_bytes), "gathered")
    documents = table.where("documents is not null").select("block", "documents", "learns")
    words, grams = (table.where(f"{c} is not null").select("block", c, "n") for c in ("word", "gram"))
    counts = write_table(words.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    told = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count_if(F.col("c") > 0).alias("distinct")).first()
    ends = documents.agg(F.coalesce(F.sum("learns"), F.lit(0)).alias("n")).first()["n"]
    tokens, distinct = told["tokens"] + ends, told["distinct"] + (ends > 0)
    total = math.log10(tokens + distinct + 1)
    costs = gram_costs(grams.groupBy("gram").agg(F.sum("n").alias("n")), depth, part_grams)
    # The distinct side is hashed by partition, so the blocks' many rows need no sorting.
    of_grams = grams.join(costs.hint("shuffle_hash"), "gram").select(F.col("block").alias("of"), F.lit(None).cast("binary").alias("word"), "gram", "cost")
    of_words = words.join(counts.hint("shuffle_hash"), "word").select(F.col("block").alias("of"), "word", F.lit(None).cast("long").alias("gram"), F.col("c").cast("double").alias("cost"))

    def block(documents: pa.Table, values: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        documents = unpacked(documents["documents"])
        of_gram, cost = values["gram"].is_valid().to_numpy(), values["cost"].to_numpy()
        coded = [words_of(run) for run in documents["text"].chunks]
        place = pc.index_in(pa.chunked_array([words.dictionary for words, _ in coded]), value_set=values["word"].drop_null().cast(pa.binary())).to_numpy()
        count = cost[~of_gram]
        logs = np.log10(count + 1)
        n, seen, base, at = [], [], [], 0
        for words, lengths in coded:
            own = place[at : at + len(words.dictionary)][words.indices.to_numpy()]
            owner, at = np.repeat(np.arange(len(lengths)), lengths), at + len(words.dictionary)
            n.append(lengths + 1)
            seen.append(np.bincount(owner[count[own] > 0], minlength=len(lengths)) + (ends > 0))
            base.append(np.bincount(owner, weights=logs[own], minlength=len(lengths)) + math.log10(ends + 1) - n[-1] * total)
        n, seen, base = np.concatenate(n), np.concatenate(seen), np.concatenate(base)
        del coded, words, place, own, owner, count, logs
        pa.default_memory_pool().release_unused()
        gram, cost = values["gram"].drop_null().to_numpy(), cost[of_gram]
        del values, of_gram
        order = np.argsort(gram)
        gram, cost, score = gram[order], cost[order], np.zeros(len(n))
        del order
        texts = (text for run in documents["text"].chunks for text in run.to_pylist())
        for part, owner in packed_grams(enumerate(texts), depth):
            score += np.bincount(owner, weights=costs_at(gram, cost, part), minlength=len(n))
        del gram, cost
        size = pc.binary_length(documents["text"]).to_numpy().astype(np.int64) + 1
        return pa.table({
            "doc_id": documents["doc_id"], "held_out": documents["held_out"], "n_tokens": n, "n_known": seen, "train_tokens": np.full(len(n), tokens, np.int64), "base_score": base, "score": score, "n_bytes": size,
            "bits_per_byte": -score / math.log10(2) / size})

    return documents.select("block", "documents").groupBy("block").cogroup(of_grams.unionByName(of_words).groupBy("of")).applyInArrow(block, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double")
