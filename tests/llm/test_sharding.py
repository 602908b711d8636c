from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import AWKWARD

from contactloom.llm import queries, sharding


def test_query_has_even_counts_and_gapless_slots(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op5_exact_sharding"](spark, folder).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.size == len((docs[r.doc_id] or "").encode()) + 1 and r.law == "rows" and r.grown_shard is None
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_awkward_rows_and_columns(awkward, empty):
    out = sharding.exact_shuffle(awkward, shards=4, cell_rows=2)
    rows = out.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(AWKWARD)
    assert "fp" in out.columns and {r.fp for r in rows} == {"x"}
    assert sorted(Counter(r.shard for r in rows).values()) == [3, 3, 4, 4]
    assert sharding.exact_shuffle(empty).collect() == []


def test_every_row_reaches_every_shard_evenly(spark):
    docs = spark.range(40, numPartitions=3).selectExpr("id doc_id", "cast(id as string) text")
    seen = np.zeros((40, 4))
    for seed in range(30):
        for r in sharding.exact_shuffle(docs, shards=4, seed=seed).collect():
            seen[r.doc_id, r.shard] += 1
    assert (seen > 0).mean() > 0.98 and np.abs(seen.mean(1) - 7.5).max() < 1e-9


@pytest.mark.parametrize("rows_in,rows_out", [([5, 0, 7], [4, 4, 4]), ([1], [1, 0]), ([0], [0, 0])])
def test_matrix_margins(rows_in, rows_out):
    m = sharding.communication_matrix(np.array(rows_in), np.array(rows_out), 3)
    assert m.sum(1).tolist() == rows_in and m.sum(0).tolist() == rows_out


def test_same_shards_under_other_splits_and_clashing_names(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id doc_id", "cast(id as string) text", "id _file", "id _at", "id _cell", "id _key", "id _start", "id n", "id _place", "id shard")
    rows.repartition(3).write.parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    seen = []
    for first, second in (("128m", "128m"), ("128m", "6k"), ("6k", "128m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", first)
        try:
            out = sharding.exact_shuffle(docs, shards=4, cell_rows=300)
            spark.conf.set("spark.sql.files.maxPartitionBytes", second)
            seen.append(sorted((r.doc_id, r.shard, r.slot, r._cell, r._place, r.n) for r in out.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 5000
    assert all(d == c == p == n for d, _, _, c, p, n in seen[0]) and set(docs.columns) <= set(out.columns)
    assert sorted((s, k) for _, s, k, *_ in seen[0]) == [(s, k) for s in range(4) for k in range(1250)]


def test_filtered_read_is_written_first(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 3 = 0")
    rows = sharding.exact_shuffle(docs, shards=3).collect()
    n = docs.count()
    assert sorted(Counter(r.shard for r in rows).values()) == sorted(n // 3 + (k < n % 3) for k in range(3))
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
