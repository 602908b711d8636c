import random

import brute
from brute import AWKWARD

from contactloom.llm import queries, simhash


def groups(df):
    return [(r.doc_id, r.fingerprint, r.component_id) for r in df.collect()]


def test_query_is_brute_force_on_small_table(spark):
    folder = "/root/testdata/sf0.001"
    fps = {r.doc_id: brute.fingerprint(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    roots = brute.components(fps)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op1_simhash_near_dedup"](spark, folder).collect()}
    assert found == {d: (f"{f:016x}", roots[d]) for d, f in fps.items()}


def test_awkward_rows(awkward, empty):
    found = groups(simhash.near_duplicate_groups(awkward))
    assert len(found) == len(AWKWARD)
    by_id = {d: (f, c) for d, f, c in found}
    assert all(by_id[d] == ("0" * 16, 1) for d in (1, 2, 3)) and by_id[7][1] == by_id[8][1] == 6
    assert by_id[9][0] == f"{brute.fingerprint(dict(AWKWARD)[9]):016x}"
    assert groups(simhash.near_duplicate_groups(empty)) == []


def test_links_agree_with_brute_force_in_small_and_large_buckets(spark):
    draw = random.Random(5)
    fps = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(15):
            f = base
            for b in draw.sample(range(64), draw.randint(0, 3)):
                f ^= 1 << b
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute.components({i: f & (2**64 - 1) for i, f in enumerate(signed)})
    for limit in (64, 3):
        edges = simhash.links(table, bucket_limit=limit)
        at = {f: i for i, f in enumerate(signed)}
        pairs = [(at[r.a], at[r.b]) for r in edges.collect()]
        root = list(range(len(signed)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        assert {i: find(i) for i in range(len(signed))} == want


def test_other_radius_is_exact(spark):
    draw = random.Random(9)
    fps = {draw.getrandbits(64)}
    while len(fps) < 60:
        f = draw.choice(sorted(fps))
        for b in draw.sample(range(64), draw.randint(1, 6)):
            f ^= 1 << b
        fps.add(f)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert {(r.a, r.b) for r in simhash.links(table, radius=4).collect()} == want


def test_one_of_each_group_stays(spark, awkward, tmp_path):
    awkward.write.parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 9, 10, 11, 12] and ids.count(None) == 1


def within(signed, radius):
    """All pairs within ``radius`` bits, from the neighbours of each."""
    from itertools import combinations

    at = {f & (2**64 - 1) for f in signed}
    flips = [sum(1 << b for b in c) for n in range(1, radius + 1) for c in combinations(range(64), n)]
    to = lambda f: f - (1 << 64) if f >> 63 else f
    return {tuple(sorted((to(f), to(f ^ x)))) for f in at for x in flips if f ^ x in at}


def test_many_fingerprints_in_one_bucket(spark):
    """10,000 fingerprints that agree on the first 34 bits, most of them near others, and no link is lost."""
    draw = random.Random(3)
    low = draw.getrandbits(34)
    fps = set()
    while len(fps) < 10_000:
        f = draw.getrandbits(30) << 34 | low
        for _ in range(draw.randint(1, 6)):
            fps.add(f)
            f ^= 1 << draw.randint(34, 63) | 1 << draw.randint(34, 63)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {(r.a, r.b) for r in simhash.links(table).collect()}
    assert len(found) > 5_000 and found == within(signed, 2)


def test_full_cube_of_few_bits(spark):
    """All 4,096 values of 12 bits: keys grow down to six free bits."""
    signed = set(range(4096))
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {(r.a, r.b) for r in simhash.links(table, bucket_limit=2).collect()}
    assert found == within(signed, 2)


def test_rows_that_stay_are_the_same_under_other_splits(spark, tmp_path):
    """Rows keep their names where two scans cut the files differently, and names of columns may be those used inside."""
    rows = spark.range(4000).selectExpr("id % 1500 doc_id", "concat('text number ', id % 70, ' with ', id % 13, ' words') text", "id _file", "id _at", "id file", "id at", "id root", "id fp", "id _row")
    rows.repartition(3).write.parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    seen = []
    for size in ("128m", "9k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            kept = simhash.keep_one_of_each_group(docs)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "17k")
            seen.append(sorted(tuple(r) for r in kept.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert kept.columns == docs.columns and seen[0] == seen[1] and seen[0]
    roots = {r.root for r in simhash.near_duplicate_groups(docs).collect()}
    assert len(seen[0]) == len(roots) < 1000
