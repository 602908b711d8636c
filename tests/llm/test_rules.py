import brute
import pytest
from brute import AWKWARD

from contactloom.llm import queries, rules


def test_query_is_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.QUERIES["op7_quality_rules"](spark, folder).collect():
        want = brute.quality(texts[r.doc_id])
        assert {k: r[k] for k in want} == want, r.doc_id
        assert not (r.base_failed and r.kept)


def test_awkward_rows(awkward, empty):
    rows = rules.ledger(awkward).collect()
    assert len(rows) == len(AWKWARD)
    texts = {}
    for i, t in AWKWARD:
        texts[i] = t
    for r in rows:
        want = brute.quality(texts[r.doc_id])
        assert {k: r.measures[k] for k in want if k != "base_failed"} == {k: v for k, v in want.items() if k != "base_failed"}
        assert bool(r.failures & rules.mask_of(rules.BASE)) == want["base_failed"]
    assert rules.ledger(empty).collect() == []


@pytest.mark.parametrize("policy", list(rules.POLICIES))
def test_ablation_counts_bits(spark, policy):
    entries = rules.ledger(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    bits = [r.failures & rules.mask_of(rules.POLICIES[policy]) for r in entries.collect()]
    found = {r.rule: (r.rejected, r.rejected_alone) for r in rules.ablation(entries, policy).collect()}
    assert found == {r.name: (sum(b >> r.bit & 1 for b in bits), bits.count(1 << r.bit)) for r in rules.RULES if r.name in rules.POLICIES[policy]}


def test_main_path_is_native(spark):
    plan = rules.apply_policy(rules.ledger(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
