import brute
import pytest

import corpus_pipeline
from contactloom.llm import queries, scratch, zstd_quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output over the small table."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = scratch.write_table(stage(spark, docs, FOLDER), f"test-{name}")
        out[name] = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()], [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in after.collect()]
        docs = after
    return out


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "secret_scan", "packing"]


def test_quality_stage_keeps_what_the_classifier_keeps(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = zstd_quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet").where(zstd_quality.in_training()))
    good = {r.doc_id for r in zstd_quality.score(docs, model).collect() if r.score >= 0.3}
    before, after = stages["quality_classifier"]
    assert sorted(after) == sorted(r for r in before if r[0] in good) and 0 < len(after) < len(before)


def test_dedup_stage_keeps_the_least_of_each_group(stages):
    before, after = stages["near_dedup"]
    roots = brute.components({r[0]: brute.fingerprint(r[1]) for r in before})
    assert sorted(after) == sorted(r for r in before if roots[r[0]] == r[0])


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    told = brute.contamination([(r[0], r[1]) for r in before], items)
    assert sorted(after) == sorted(r for r in before if not told[r[0]][4])


def test_secrets_stage_changes_only_secrets(stages):
    before, after = stages["secret_scan"]
    texts = {r[0]: r for r in after}
    assert len(after) == len(before)
    for d, text, lang, source, n in before:
        new = texts[d]
        assert brute.secrets(new[1])["base"] == [] and (new[2], new[3]) == (lang, source)
        if not brute.secrets(text)["base"] and "[" not in (new[1] or ""):
            assert new[1] == text
        assert new[4] == (n if text is None else len(new[1]))


def test_run_packs_what_the_stages_kept(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in stages["secret_scan"][1]}
    assert "pipeline" in __import__("__spark_entry__").queries() and set(queries.QUERIES) <= set(__import__("__spark_entry__").queries())


AWKWARD_ROWS = [(i, t, None if k % 3 else "en", None if k % 4 else "web", None if k % 5 else len(t or "")) for k, (i, t) in enumerate(brute.AWKWARD)]
CLASHES = "_row string, _file string, fp string, file string, at string, score string, shard string, base string, ids string, key string, n_hit string"


@pytest.fixture(scope="module", params=["read", "made"])
def awkward_docs(request, spark, tmp_path_factory):
    """Nulls in every column, empty and long texts, repeats, and columns named as those used inside; read from files, and not."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES
    docs = spark.createDataFrame([(*r, *["x"] * len(CLASHES.split(","))) for r in AWKWARD_ROWS], kind).repartition(3)
    if request.param == "made":
        return docs
    path = f"file://{tmp_path_factory.mktemp('awkward')}/docs"
    docs.write.parquet(path)
    return spark.read.parquet(path)


def plain(df):
    return sorted((tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in df.collect()), key=str)


def test_awkward_rows_through_each_filter(spark, awkward_docs):
    stages = dict(corpus_pipeline.STAGES)
    every = sorted(AWKWARD_ROWS, key=str)
    kept = stages["quality_classifier"](spark, awkward_docs, FOLDER)
    assert tuple(kept.columns) == corpus_pipeline.COLUMNS and set(plain(kept)) <= set(every)
    once = stages["near_dedup"](spark, awkward_docs, FOLDER)
    assert tuple(once.columns) == corpus_pipeline.COLUMNS
    assert sorted(r[0] for r in plain(once) if r[0] is not None) == [1, 4, 5, 6, 9, 10, 11, 12] and sum(r[0] is None for r in plain(once)) == 1
    assert plain(stages["decontamination"](spark, awkward_docs, FOLDER)) == every
    assert plain(stages["secret_scan"](spark, awkward_docs, FOLDER)) == sorted(((i, t, lang, source, n if t is None else len(t)) for i, t, lang, source, n in AWKWARD_ROWS), key=str)
    packed = stages["packing"](spark, awkward_docs, FOLDER).collect()
    assert sum(r.start == 0 for r in packed) == len(AWKWARD_ROWS)


def test_empty_table_through_all_stages(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.collect() == [], name
