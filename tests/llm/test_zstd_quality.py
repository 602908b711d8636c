import brute
from brute import AWKWARD

from contactloom.llm import queries, zstd_quality


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_labels_are_told_apart(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.QUERIES["op10_compression_quality"](spark, folder).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (brute.crc(r.doc_id) % 5 == 0) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) in (0, 1)]
    assert len(held) > 200 and auc(held) > 0.9
    right = sum((s >= 0.3) == bool(y) for s, y in held) / len(held)
    assert right > 0.8, right


def test_held_out_labels_are_not_read(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    one, two = (zstd_quality.fit(docs, x.where(zstd_quality.in_training())) for x in (labels, turned))
    assert one == two


def test_awkward_rows_and_few_labels(spark, awkward, empty):
    labels = spark.createDataFrame([(6, 1), (10, 0), (None, 1), (99, 0), (4, None)], "doc_id long, quality int")
    model = zstd_quality.fit(awkward, labels)
    rows = zstd_quality.score(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert zstd_quality.score(empty, model).collect() == []
    bare = zstd_quality.fit(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert len(zstd_quality.score(awkward, bare).collect()) == len(AWKWARD)
    assert zstd_quality.keep_good(awkward, model, threshold=0.0).count() == len(AWKWARD)
    for table in (empty, awkward):
        kept = zstd_quality.keep_good(table, model, threshold=0.0)
        assert kept.columns == table.columns and kept.count() == table.count()


def test_a_text_too_long_for_the_sample_leaves_room(spark):
    texts = [(i, ("good plain words of prose " if i % 2 else "###$$$ %%% junk &&& ") * (40_000 if i in (0, 1) else 20)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = zstd_quality.fit(docs, labels, sample_bytes=20_000)
    scores = {r.doc_id: r.score for r in zstd_quality.score(docs, model).collect()}
    assert all((scores[i] > 0.5) == bool(i % 2) for i in range(2, 60))


def test_repeated_ids_and_ties_give_one_model_whatever_the_order(spark):
    texts = [(i % 20, f"{'some good prose about things' if i % 2 else '### %%% $$$'} number {i} " * 8) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] * 2 + [(3, 0)], "doc_id long, quality int")
    one, two = (zstd_quality.fit(spark.createDataFrame(t, "doc_id long, text string").repartition(n), labels) for t, n in ((texts, 1), (texts[::-1], 5)))
    assert one == two
    same = zstd_quality.score(spark.createDataFrame([(1, "alike"), (2, "alike"), (1, "alike")], "doc_id long, text string"), one).collect()
    assert len(same) == 3 and len({r.score for r in same}) == 1


def test_scores_are_those_of_compressing_by_hand(spark):
    """The operator's scores against a plain loop over zstandard itself."""
    import math

    import zstandard

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    m = zstd_quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet").where(zstd_quality.in_training()))
    kind = zstandard.DICT_TYPE_RAWCONTENT if m.raw else zstandard.DICT_TYPE_FULLDICT
    tools = [zstandard.ZstdCompressor(level=m.level, dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (m.good, m.bad)]
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    close = 0
    for r in zstd_quality.score(docs, m).collect():
        text = texts[r.doc_id]
        g, b = (len(t.compress(text)) for t in tools) if text else (1, 1)
        x = [(b - g) / (b + g), (b - g) / len(text), min(min(g, b) / len(text), 0.3), math.log1p(len(text))] if text else [0, 0, 0.3, 0]
        z = sum((v - a) / s * w for v, a, s, w in zip(x, m.mean, m.scale, m.weights)) + m.weights[-1]
        close += abs(1 / (1 + math.exp(-max(-30, min(30, z)))) - r.score) < 0.02
    assert close > 0.97 * len(texts), close
