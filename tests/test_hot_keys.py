"""Ranks, prefixes and samples of sites that hold most rows, and paths with many steps up."""

from pyspark.sql import functions as F

from contactloom.functions import urls
from contactloom.operators import crawl, ledger, models


def test_numbers_within_groups_by_ranges(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 > 0, 'hot', if(id % 2 = 0, null, concat('g', id % 7))) g", "(id * 7919) % 3000 v", "id % 5 w").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ledger.numbered_within(rows, "g", F.col("v") % 100, "v")
        got: dict = {}
        for r in placed.collect():
            got.setdefault(r.g, []).append((r.r, r.v % 100, r.v))
        tasks = placed.where("g = 'hot'").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(map(len, got.values())) == 3000 and None in got and tasks > 1
    for numbers in got.values():
        numbers.sort()
        assert [n for n, *_ in numbers] == list(range(len(numbers))) and [x[1:] for x in numbers] == sorted(x[1:] for x in numbers)
    assert sorted(r.n for r in ledger.numbered(rows, "v").select("n").collect()) == list(range(3000))


def test_ranks_of_a_large_site(spark):
    people = spark.createDataFrame([("big", f"Name {i:04d}", f"k{i}") for i in range(400)] + [("small", "Bo", "b"), ("small", "Al", "a")], "domain string, name string, person_key string").repartition(4)
    found = {(r.domain, r.name): r["rank"] for r in models.by_name(people).collect()}
    assert found == {**{("big", f"Name {i:04d}"): i + 1 for i in range(400)}, ("small", "Bo"): None, ("small", "Al"): None}


def test_pages_meet_prefixes_by_their_folders(spark):
    pages = spark.createDataFrame([("s", f"https://s.test{p}") for p in ("/team/ann", "/team/", "/team", "/Team/a/b/", "/teams/x", "/a//b/c", "/", "/team/ann", "/team//")] + [("t", "https://t.test/team/ann")], "key string, url string")
    prefixes = spark.createDataFrame([("s", "/TEAM"), ("s", "team/a/"), ("s", "/a//b"), ("s", "/"), ("u", "/team")], "key string, prefix string")
    assert sorted(r.url for r in crawl.under_prefixes(pages, prefixes).collect()) == ["https://s.test/Team/a/b/", "https://s.test/a//b/c", "https://s.test/team/ann", "https://s.test/team/ann"]


def test_samples_are_bounded_before_they_are_sent(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', 'cold') g", "concat('v', id % 100) v", "id div 2 pos")
    first = models.first_of_group(rows, "g", "v", "pos", 12)
    assert {(r.g, r.n, r.p) for r in first.groupBy("g").agg(F.count("*").alias("n"), F.max("pos").alias("p")).collect()} == {("hot", 12, 16), ("cold", 12, 8)}
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_steps_up_and_dots(spark):
    base = "https://a.example/x/y/page?q=1"
    cases = {
        "/a/b/c/d/e/f/../../../../../../g": "https://a.example/g", "../../../../z": "https://a.example/z", "./p/./q": "https://a.example/x/y/p/q", "..": "https://a.example/x/", ".": "https://a.example/x/y/", "/a/../..": "https://a.example/",
        "/a/b/.?x=/../y": "https://a.example/a/b/?x=/../y", "/a/..b/c": "https://a.example/a/..b/c", "/a//../b": "https://a.example/a/b", "https://o.test": "https://o.test", "//o.test/a/../b#f": "https://o.test/b", "/a/%2E%2e/b": "https://a.example/b",
    }
    rows = spark.createDataFrame([(k, base) for k in cases], "link string, base string")
    assert {r.link: r.full for r in rows.select("link", urls.resolve(F.col("link"), F.col("base")).alias("full")).collect()} == {**cases, "https://o.test": {r.full for r in rows.where("link = 'https://o.test'").select(urls.resolve(F.col("link"), F.col("base")).alias("full")).collect()}.pop()}
