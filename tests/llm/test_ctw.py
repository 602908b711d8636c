import math
import time
from collections import Counter, defaultdict
from functools import lru_cache

import brute
import numpy as np
import pyarrow as pa
from brute import AWKWARD
from pyspark.sql import functions as F

from contactloom.llm import ctw, queries


def tree_cost(train: list[bytes], depth: int):
    """log10 probability of a text by a context tree built node by node."""
    counts: dict = defaultdict(lambda: [0, 0])
    below: dict = defaultdict(set)
    for text in train:
        data = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                context = data[i - d : i]
                for k in range(8):
                    node = (context, (1 << k) + (data[i] >> (8 - k)))
                    counts[node][data[i] >> (7 - k) & 1] += 1
                    if d < depth:
                        below[node].add((data[i - d - 1 : i], node[1]))

    def kt(node):
        a, b = counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(node):
        if len(node[0]) == depth:
            return kt(node)
        e, c = kt(node), sum(weighted(x) for x in below[node])
        return max(e, c) + math.log(0.5 * math.exp(e - max(e, c)) + 0.5 * math.exp(c - max(e, c)))

    def one(data, i, bits, d=0):
        node = (data[i - d : i], bits)
        if node not in counts:
            return 0.5
        a, b = counts[node]
        p = (b + 0.5) / (a + b + 1)
        if d == depth:
            return p
        stop = math.exp(kt(node) - math.log(2) - weighted(node))
        return stop * p + (1 - stop) * one(data, i, bits, d + 1)

    def cost(text: bytes) -> float:
        data, total = b"\xff" * depth + text + b"\xff", 0.0
        for i in range(depth, len(data)):
            for k in range(8):
                p = one(data, i, (1 << k) + (data[i] >> (8 - k)))
                total += math.log10(p if data[i] >> (7 - k) & 1 else 1 - p)
        return total

    return cost


def base_scores(docs):
    train = Counter()
    ends = 0
    for d, t in docs:
        if d is None or brute.crc(d) % 7 != 2:
            train.update(brute.WORD.findall(brute.lower(t)))
            ends += 1
    n, v = train.total() + ends, len(train) + (ends > 0)
    out = []
    for d, t in docs:
        words = brute.WORD.findall(brute.lower(t))
        seen = [train[w] for w in words] + [ends]
        out.append((d, len(seen), sum(c > 0 for c in seen), n, sum(math.log10((c + 1) / (n + v + 1)) for c in seen)))
    return out


def test_query_base_and_held_out(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {d: rest for d, *rest in base_scores(docs)}
    rows = queries.QUERIES["op3_context_tree_scores"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.held_out == (brute.crc(r.doc_id) % 7 == 2)
    size = {d: len(ctw.normal((t or "").encode())) + 1 for d, t in docs}
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > -0.35 * math.log10(256) * sum(size[r.doc_id] for r in held)


def test_held_out_text_is_likelier_than_by_words(spark):
    rows = queries.QUERIES["op3_context_tree_scores"](spark, "/root/testdata/sf0.1").where("held_out").select("score", "base_score").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_scores_are_those_of_a_tree_built_by_hand(spark):
    texts = {1: "abracadabra", 2: "Abra  cad", 3: None, 4: "xyz ünï", 5: "the cat the hat", 6: "the bat"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    rows = ctw.score_texts(docs, F.col("doc_id") % 2 == 0, depth=2).collect()
    cost = tree_cost([ctw.normal((t or "").encode()) for i, t in texts.items() if i % 2], 2)
    for r in rows:
        assert math.isclose(r.score, cost(ctw.normal((texts[r.doc_id] or "").encode())), rel_tol=1e-4, abs_tol=1e-4), r


def test_scores_are_the_same_however_the_grams_are_cut(spark):
    """Parts of a few grams, so that most contexts are cut at every depth."""
    texts = {i: " ".join(f"word{i * k % 7} {'ab' * (k % 4)}é" for k in range(12)) for i in range(1, 9)} | {9: "", 10: "zz top"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    cost = tree_cost([ctw.normal(t.encode()) for i, t in texts.items() if i % 2], 4)
    for parts in (7, 60, 1 << 19):
        rows = ctw.score_texts(docs, F.col("doc_id") % 2 == 0, depth=4, part_grams=parts, block_bytes=150).collect()
        assert len(rows) == 10
        for r in rows:
            assert math.isclose(r.score, cost(ctw.normal(texts[r.doc_id].encode())), rel_tol=1e-7), (parts, r)


def test_depth_six_is_the_longest(spark):
    texts = {1: "abcdefgh abcdefgh ünï", 2: "abcdefgz ü"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    cost = tree_cost([texts[1].encode()], 6)
    for r in ctw.score_texts(docs, F.col("doc_id") == 2, depth=6, part_grams=5).collect():
        assert math.isclose(r.score, cost(texts[r.doc_id].encode()), rel_tol=1e-7)


def test_awkward_rows(awkward, empty):
    rows = ctw.score_texts(awkward, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, depth=2, block_bytes=100).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == sorted((d or -1, n, k, t, round(b, 5)) for d, n, k, t, b in base_scores(AWKWARD))
    assert all(r.score < 0 for r in rows)
    assert ctw.score_texts(empty, F.lit(False), depth=2).collect() == []


def test_documents_travel_packed(spark):
    """What a block's documents take in the exchange is a part of their texts, and comes out as it went in."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "cast(text as binary) text", "doc_id % 3 = 0 held_out")
    rows = ctw.gathered(docs, 2, 1 << 16).where("documents is not null").toArrow()
    found = [r for d in ctw.unpacked(rows["documents"]).to_pylist() for r in [(d["doc_id"], d["held_out"], d["text"])]]
    want = [(r.doc_id, r.held_out, ctw.normal(bytes(r.text or b""))) for r in docs.collect()]
    assert sorted(found) == sorted(want) and sum(rows["learns"].to_pylist()) == sum(not out for _, out, _ in want)
    assert 2 * sum(len(d) for d in rows["documents"].to_pylist()) < sum(len(t) for *_, t in want)


def block_of(texts: dict[int, bytes], held_out: set[int], spark, depth: int) -> tuple[dict, dict]:
    docs = spark.createDataFrame([(i, bytearray(t), i in held_out) for i, t in texts.items()], "doc_id long, text binary, held_out boolean").coalesce(1)
    rows = ctw.gathered(docs, depth, 32 << 20).toArrow()
    words, grams = ([(r[c], r["n"]) for r in rows.select([c, "n"]).to_pylist() if r[c] is not None] for c in ("word", "gram"))
    assert len(dict(words)) == len(words) and len(dict(grams)) == len(grams)
    return dict(words), dict(grams)


def test_words_and_grams_of_a_block_are_counted_once_each_over_runs_and_parts(spark):
    """A block of several runs of words and parts of grams, with a text longer than both, held-out words and empty texts; depth 6 takes the most bits."""
    texts = {i: b" ".join(b"w%d" % (i * k % 97) for k in range(20)) for i in range(1, 2501)} | {2501: b"", 2502: b"\x00 a\x00 " + b"ab cd " * 200_000, 2503: b" \n", 2504: "ünï only here".encode()}
    held_out = {i for i in texts if i % 5 == 0} | {2504}
    for depth in (2, 3, 6):
        words, grams = block_of(texts, held_out, spark, depth)
        want: Counter = Counter()
        for i, t in texts.items():
            for w in ctw.normal(t).split():
                want[w] += i not in held_out
        assert words == dict(want) and words["ünï".encode()] == 0
        want = Counter()
        for i, t in texts.items():
            data = b"\xff" * depth + ctw.normal(t) + b"\xff"
            for at in range(depth, len(data)):
                want[int.from_bytes(data[at - depth : at][::-1] + data[at : at + 1])] += i not in held_out
        assert grams == dict(want)


def cpu_of(work) -> float:
    times = []
    for _ in range(5):
        began = time.thread_time()
        work()
        times.append(time.thread_time() - began)
    return min(times)


def test_costs_of_a_part_take_a_fraction_of_a_search_for_each_byte():
    """As many distinct grams as a block of 32 MB had, a part in which they recur as in texts."""
    rng = np.random.default_rng(1)
    gram = np.unique(rng.integers(0, 1 << 48, 700_000))
    cost, part = rng.random(len(gram)), rng.permutation(gram)[(rng.random(1 << 18) ** 4 * len(gram)).astype(int)].astype(np.uint64)
    plain = lambda: cost[np.searchsorted(gram, part.astype(np.int64))]
    assert (ctw.costs_at(gram, cost, part) == plain()).all()
    assert cpu_of(lambda: ctw.costs_at(gram, cost, part)) < 0.7 * cpu_of(plain)


def test_words_of_a_run_take_a_fraction_of_a_dictionary_of_objects():
    rng = np.random.default_rng(2)
    names = [b"w%x" % n for n in rng.integers(0, 1 << 40, 200_000)]
    texts = [b" ".join(names[k] for k in (rng.random(500) ** 4 * len(names)).astype(int)) for _ in range(1000)] + [b""]

    def plain():
        counts: dict[bytes, int] = {}
        for t in texts:
            for w in t.split():
                counts[w] = counts.get(w, 0) + 1
        return counts

    words, lengths = ctw.words_of(pa.array(texts, pa.binary()))
    assert words.to_pylist() == [w for t in texts for w in t.split()] and lengths.tolist() == [500] * 1000 + [0]
    assert cpu_of(lambda: ctw.words_of(pa.array(texts, pa.binary()))) < 0.7 * cpu_of(plain)
