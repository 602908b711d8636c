import brute
from brute import AWKWARD

from contactloom.llm import decontam, queries

ITEMS = [("b1", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), ("b2", "Short item here"), ("b3", ""), ("b4", None), ("b5", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), ("b6", "again and again"), ("b7", "naïve ünïcode")]
DOCS = [*AWKWARD[:7], (20, "pre ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi post"), (21, "short item here, short item-here " + "pad " * 200), (22, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (23, "again and again and again"), (24, "Ünïcode naïve ünïcode naïve ünïcode"), (25, "short item here " * 500)]


def rows(found):
    import hashlib

    return {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in found.collect()}


def test_query_is_brute_force(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
        want = brute.contamination(docs, items)
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.QUERIES["op9_decontamination"](spark, folder).collect()} == want


def test_awkward_rows_and_short_items(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    want = brute.contamination(DOCS, ITEMS)
    for shard_bytes in (16 << 20, 100):
        assert rows(decontam.find_contamination(docs, items, shard_bytes=shard_bytes)) == want


def test_empty_sides(spark, empty):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert decontam.find_contamination(empty, items).collect() == []
    none = spark.createDataFrame([], "item_id string, text string")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert {(r.doc_id, r.n_hit, tuple(r["items"])) for r in decontam.find_contamination(docs, none).collect()} == {(d, 0, ()) for d, _ in DOCS}


def test_proximity_finds_what_an_inserted_word_breaks(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta WORD epsilon zeta eta theta iota kappa lambda mu nu"), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id string, text string")
    found = {r.doc_id: (r.n_hit, r.near_items) for r in decontam.find_contamination(docs, items).collect()}
    assert found == {1: (0, ["b1"]), 2: (0, [])}


def test_filter_keeps_all_columns_and_clean_rows(spark, tmp_path):
    spark.createDataFrame([(i, t, "n") for i, t in DOCS], "doc_id long, text string, n_hit string").write.parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    kept = decontam.without_contaminated(docs, spark.createDataFrame(ITEMS, "item_id string, text string"))
    want = brute.contamination(DOCS, ITEMS)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, v in want.items() if not v[4])


def test_windows_asked_in_parts_and_many_shards(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert rows(decontam.find_contamination(docs, items, shard_bytes=200, windows_at_once=2)) == brute.contamination(DOCS, ITEMS)


def test_a_test_set_of_over_eight_megabytes(spark):
    """Words of twenty letters, so that a large test set has few windows; one item in a hundred has a passage in a document."""
    from pyspark.sql import functions as F

    word = lambda n: F.substring(F.sha2(n.cast("string"), 256), 1, 20)
    passage = lambda item, first, last: F.array_join(F.transform(F.sequence(F.lit(first), F.lit(last)), lambda k: word(item * 100 + k)), " ")
    items = spark.range(10_500).select(F.col("id").cast("string").alias("item_id"), passage(F.col("id"), 0, 39).alias("text"))
    assert items.agg(F.sum(F.length("text"))).first()[0] > 8 << 20
    docs = spark.range(105).select(F.col("id").alias("doc_id"), F.concat(F.lit("before "), passage(F.col("id") * 100, 5, 24), F.lit(" after")).alias("text"))
    found = decontam.find_contamination(docs, items, windows_at_once=50_000).collect()
    assert len(found) == 105 and all((r.n_words, r.n_hit, r["items"]) == (22, 20, [str(r.doc_id * 100)]) for r in found)


def test_rows_that_stay_are_the_same_under_other_splits(spark, tmp_path):
    names = ["_row", "_text", "_file", "_at", "file", "at", "shard", "base", "items"]
    texts = [(i, DOCS[i % len(DOCS)][1], *[i] * len(names)) for i in range(3000)]
    spark.createDataFrame(texts, "doc_id long, text string, " + ", ".join(f"{c} int" for c in names)).repartition(3).write.parquet(f"file://{tmp_path}/docs")
    docs, items = spark.read.parquet(f"file://{tmp_path}/docs"), spark.createDataFrame(ITEMS, "item_id string, text string")
    want = brute.contamination(DOCS, ITEMS)
    stay = {i for i in range(3000) if not want[DOCS[i % len(DOCS)][0]][4]}
    for first, second in (("128m", "9k"), ("9k", "128m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", first)
        try:
            kept = decontam.without_contaminated(docs, items)
            spark.conf.set("spark.sql.files.maxPartitionBytes", second)
            got = kept.collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert kept.columns == docs.columns and {r.doc_id for r in got} == stay and len(got) == len(stay)
        assert all(r[c] == r.doc_id for r in got for c in names)
    assert decontam.without_contaminated(docs.limit(0), items).collect() == [] and decontam.without_contaminated(docs, items.limit(0)).count() == 3000




def test_a_whole_index_gives_the_same_matches(spark):
    """The bitmap only leaves out terms that no window has; false hits of it change nothing."""
    import numpy as np

    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    windows, _ = decontam.windows_of(spark.createDataFrame(ITEMS, "item_id string, text string"), "item_id", "text", 13)
    some = decontam.term_bitmap(windows.selectExpr("explode(split(words, ' ')) term"))
    assert 20 < some.sum() < 30
    told = []
    for wanted in (None, some, np.ones(decontam.SLOTS, bool)):
        index = decontam.build_index(docs, wanted=wanted)
        found = decontam.matches(index, windows, 8, 4, 100)
        told.append(sorted((r.doc_id, [tuple(x) for x in r.spans], r.exact, r.near) for r in found.join(index.where("term is null").select("shard", "base", "doc_id"), ["shard", "base"]).collect()))
        told[-1].append(index.where("term is not null").count() if wanted is not None and wanted is some else 0)
    assert told[0][:-1] == told[1][:-1] == told[2][:-1] and len(told[0]) > 4 and 0 < told[1][-1] < 100
