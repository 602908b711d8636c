import math

import brute
import numpy as np
from brute import AWKWARD

from contactloom.llm import queries, toxicity


def test_held_out_labels_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.QUERIES["op13_ftrl_toxicity"](spark, folder).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (brute.crc(r.doc_id) % 4 == 2) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) in (0, 1)]
    bad, good = np.array([s for s, y in held if y]), np.sort([s for s, y in held if not y])
    assert len(bad) > 100 and np.searchsorted(good, bad).sum() / (len(bad) * len(good)) > 0.97
    assert (bad >= 0.3).mean() > 0.85 and (good >= 0.3).mean() < 0.01


def test_held_out_labels_are_not_read(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    one, two = (toxicity.fit(docs, x.where(toxicity.in_training())) for x in (labels, turned))
    assert same(one, two) and len(one.slots)


def same(one, two):
    return one.constant == two.constant and np.array_equal(one.slots, two.slots) and np.array_equal(one.weights, two.weights)


def plain_slots(text: bytes):
    """Features one by one, in plain integers."""
    import xxhash

    def slot(h):
        return (((h ^ h >> 32) * 0x9E3779B97F4A7C15) % 2**64) >> 44

    words = brute.BENCH.findall(brute.lower(text.decode()))
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    out = {slot(x) for x in h} | {slot(xxhash.xxh64_intdigest(w[:k].encode(), k)) for w in words for k in toxicity.HEADS}
    return sorted(out | {slot((h[i] * (0xC2B2AE3D27D4EB4F + 2 * d) + h[i + d]) % 2**64) for d in (1, 2, 3) for i in range(len(h) - d)})


def test_features_are_those_of_a_plain_loop():
    words = toxicity.Words()
    for _, text in AWKWARD:
        assert words.features((text or "").encode()).tolist() == plain_slots((text or "").encode())
    for i in range(3000):  # the table of words grows
        words.features(f"w{i} x{i} again".encode())
    assert words.features(b"w7 naive x9 again").tolist() == plain_slots(b"w7 naive x9 again")


def test_the_table_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "WORDS_KEPT", 50)
    words = toxicity.Words()
    for i in range(300):
        text = f"w{i} x{i} y{i}".encode()
        assert words.features(text).tolist() == plain_slots(text)
    assert len(words.code_of) <= 60


def test_training_is_the_published_update():
    """Against scalar FTRL-proximal, coordinate by coordinate."""
    texts, labels, (a, b, l1, l2) = [[1, 2], [2, 3], [1, 3, 4], [5]] * 5, [1, 0, 1, 0] * 5, (0.5, 1.0, 0.2, 0.1)
    z, n = {}, {}

    def weight(i):
        strength, ridge, base = (0, 0, b) if i == "all" else (l1, l2, b)
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        return 0.0 if abs(zi) <= strength else -(zi - math.copysign(strength, zi)) / ((base + math.sqrt(ni)) / a + ridge)

    for _ in range(3):
        for own, y in zip(texts, labels):
            w = {i: weight(i) for i in [*own, "all"]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i, wi in w.items():
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / a
                z[i], n[i] = z.get(i, 0.0) + g - sigma * wi, n.get(i, 0.0) + g * g
    m = toxicity.train([np.array(t) for t in texts], labels, a, b, l1, l2, 3)
    want = {i: weight(i) for i in z if i != "all" and weight(i)}
    assert m.slots.tolist() == sorted(want) and np.allclose(m.weights, [want[i] for i in sorted(want)]) and math.isclose(m.constant, weight("all"))


def test_awkward_rows_and_few_labels(spark, awkward, empty):
    labels = spark.createDataFrame([(6, 1), (10, 0), (None, 1), (99, 0), (4, None), (1, 0), (8, 1), (8, 0)], "doc_id long, toxic int")
    model = toxicity.fit(awkward, labels, l1=0.0)
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows) and len(model.slots)
    assert toxicity.score(empty, model).collect() == []
    bare = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(awkward, bare).collect()} == {0.5}
    kept = toxicity.without_toxic(awkward, bare, threshold=0.6)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) and toxicity.without_toxic(awkward, bare, threshold=0.5).count() == 0


def test_one_model_whatever_the_order(spark):
    texts = [(i % 20, f"{'some good prose about things' if i % 2 else 'you awful thing'} number {i} " * 8) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] * 2 + [(3, 0)], "doc_id long, toxic int")
    one, two = (toxicity.fit(spark.createDataFrame(t, "doc_id long, text string").repartition(n), labels, l1=0.5) for t, n in ((texts, 1), (texts[::-1], 5)))
    assert same(one, two)


def test_a_text_too_long_for_the_sample_leaves_room(spark):
    texts = [(i, ("plain words of prose " if i % 2 else "you utter fool ") * (40_000 if i in (0, 1) else 5)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, toxic int"), sample_bytes=20_000, l1=1.0)
    assert all((r.score > 0.5) == (r.doc_id % 2 == 0) for r in toxicity.score(docs, model).collect())
