import math
from collections import Counter

import brute
import numpy as np
from brute import AWKWARD

from contactloom.llm import queries, tput

ITEMS = [("b1", "The quick brown fox"), ("b2", "again line end"), ("b3", None), ("b4", ""), ("b5", "word"), ("b6", "nowhere at all"), ("b2", "again line end"), (None, "two words"), ("b7", "naïve ünïcode word word")]


def plain(docs, items, k):
    """The ranked rows by brute force, equal (score, doc_id) in any order."""
    words = [(i, Counter(brute.BENCH.findall(brute.lower(t)))) for i, t in docs]
    N, L = sum(bool(c) for _, c in words), sum(sum(c.values()) for _, c in words)
    df = Counter(w for _, c in words for w in c)
    out = []
    for item, text in items:
        asked = Counter(brute.BENCH.findall(brute.lower(text)))
        found = []
        for i, c in words:
            m = 75 + (25 * sum(c.values()) * N) // L if L else 75
            score = sum(n * math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w, n in asked.items() if c[w])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def rows(table):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in table.collect()], key=repr)


def frame(spark, docs):
    names = ["term", "impact", "row", "place", "q", "alike"]
    return spark.createDataFrame([(i, t, *[1] * len(names)) for i, t in docs], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names)).repartition(3)


def test_query_is_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{folder}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows(queries.QUERIES["op11_tput_search"](spark, folder)) == plain(docs, items, 20)


def test_awkward_rows_and_short_lists(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    for k, depth in ((1, 1), (2, 1), (3, 100), (50, 2)):
        assert rows(tput.search(frame(spark, AWKWARD), items, k=k, depth=depth)) == plain(AWKWARD, ITEMS, k)


def test_batches_of_questions_give_the_same_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert rows(tput.search(frame(spark, AWKWARD), items, k=3, pairs_at_once=2)) == plain(AWKWARD, ITEMS, 3)


def test_many_copies_and_ties(spark):
    """Copies of one text by the hundred, texts of one score, and a word that all of them have."""
    docs = [(1000 - i, "common rare passage of text") for i in range(600)] + [(2000 + i, f"common w{i}") for i in range(300)] + [(i, f"common w{i} passage w{i % 7}") for i in range(300)]
    asked = [("a", "common"), ("b", "rare passage"), ("c", "common passage w3 w5 w5"), ("d", "w7 w8 absent")]
    items = spark.createDataFrame(asked, "item_id string, text string")
    assert rows(tput.search(frame(spark, docs), items, k=20, depth=5)) == plain(docs, asked, 20)


def test_empty_sides(spark, empty):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert tput.search(empty, items).collect() == [] and tput.search(frame(spark, AWKWARD), items.limit(0)).collect() == []
    assert tput.search(frame(spark, [(1, None), (2, "")]), items).collect() == []


def test_level_is_the_largest_that_keeps_the_rest_under_the_bound():
    rng = np.random.default_rng(3)
    for _ in range(300):
        best = rng.integers(1, 50, rng.integers(1, 8))
        bound = int(rng.integers(1, best.sum() + 1))
        under = [t for t in range(0, 60) if np.minimum(best, t).sum() <= bound - 1]
        got = tput.level(best, bound)
        assert np.minimum(best, got).sum() <= bound - 1 and np.minimum(best, max(under)).sum() == np.minimum(best, got).sum()


def test_nothing_among_the_best_is_left_out():
    """Whatever the exact scores between the bounds are, the k best are among what stays."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, k = int(rng.integers(1, 40)), int(rng.integers(1, 6))
        low = rng.integers(0, 12, n)
        high, ids = low + rng.integers(0, 4, n), rng.permutation(n)
        kept = set(tput.best_first(k, low, high, ids).tolist())
        for exact in (low, high, rng.integers(low, high + 1)):
            assert set(sorted(range(n), key=lambda i: (-exact[i], ids[i]))[:k]) <= kept
