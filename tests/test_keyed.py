"""Writers that notice each other, upserts by batch, and keyed state over restarts."""

import datetime
import threading

import pytest
from pyspark.sql import functions as F

from contactloom.operators import ledger, people
from contactloom.sources import commits, files, keyed
from contactloom.streaming import keyed as streams


def test_of_two_writers_one_is_refused(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    files.write_versioned(spark.range(1), path, "v1")
    read = commits.latest(spark, path)
    files.write_versioned(spark.range(2), path, "v2", read)
    with pytest.raises(commits.Conflict):
        files.write_versioned(spark.range(3), path, "v3", read)
    with pytest.raises(commits.Conflict):
        files.write_versioned(spark.range(3), path, "v2")
    assert files.read_versioned(spark, path).count() == 2 and commits.latest(spark, path).number == 2


def test_many_writers_at_once_commit_once_each_number(spark, tmp_path):
    path, won, lost = f"file://{tmp_path}/t", [], []

    def write(n):
        try:
            won.append((commits.add(spark, path, None, {"writer": n}).number, n))
        except commits.Conflict:
            lost.append(n)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 7 and commits.latest(spark, path).content == {"writer": won[0][1]}


def test_a_torn_commit_is_passed_over(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = commits.add(spark, path, None, {"n": 1})
    (tmp_path / "t" / "_commits" / f"{2:020d}.json").write_text('{"n": ')
    assert commits.latest(spark, path) == first
    assert commits.add(spark, path, first, {"n": 3}).number == 3 and commits.latest(spark, path).content == {"n": 3}


def test_upserts_touch_their_buckets_and_come_once(spark, tmp_path):
    table = keyed.KeyedTable(f"file://{tmp_path}/t", ("k",), buckets=8)
    rows = lambda pairs: spark.createDataFrame(pairs, "k long, v string")
    merge = keyed.replaced(("k",))
    first = table.upsert(rows([(k, "a") for k in range(100)] + [(None, "n")]), merge, "w", 0)
    second = table.upsert(rows([(3, "b"), (200, "b"), (None, "m")]), merge, "w", 1)
    assert table.upsert(rows([(3, "again")]), merge, "w", 1) is None and table.upsert(rows([(3, "again")]), merge, "w", 0) is None
    assert {r.k: r.v for r in table.read(spark).collect()} == {**dict.fromkeys(range(100), "a"), 3: "b", 200: "b", None: "m"}
    assert {r.k: r.v for r in table.read(spark, first).collect()} == {**dict.fromkeys(range(100), "a"), None: "n"}
    same = [b for b, f in second.content["buckets"].items() if first.content["buckets"].get(b) == f]
    assert len(same) >= 5 and second.number == 2
    assert table.upsert(rows([(3, "other")]), merge, "x", 0).content["batches"] == {"w": 1, "x": 0}


def test_an_upsert_is_done_again_on_what_another_has_committed(spark, tmp_path):
    table, merge = keyed.KeyedTable(f"file://{tmp_path}/t", ("k",), buckets=4), keyed.replaced(("k",))
    rows = lambda pairs: spark.createDataFrame(pairs, "k long, v string")
    table.upsert(rows([(1, "a")]), merge)
    calls = []

    def slowly(old, new):
        calls.append(1)
        if len(calls) == 1:
            table.upsert(rows([(2, "other")]), merge)
        return merge(old, new)

    table.upsert(rows([(3, "mine"), (2, "mine")]), slowly)
    assert len(calls) == 2 and {r.k: r.v for r in table.read(spark).collect()} == {1: "a", 2: "mine", 3: "mine"}
    calls.clear()
    with pytest.raises(commits.Conflict):
        table.upsert(rows([(4, "mine")]), slowly, retries=0)


def arrivals(spark, rows, folder, parts):
    for n in range(parts):
        yield n, lambda n=n: rows.where(F.pmod("pos", F.lit(parts)) == n).write.mode("append").parquet(folder)


def test_three_restarts_equal_the_batch_answer(spark, tmp_path):
    """Records come in three parts, out of order; the second run is lost after its upsert and comes again."""
    schema = "pos long, key string, value long, bad boolean"
    rows = spark.createDataFrame([((i * 7919) % 300, f"k{i % 17}", i, i % 5 == 0) for i in range(300)], schema)
    folder, checkpoint = f"file://{tmp_path}/in", f"file://{tmp_path}/c"
    table = keyed.KeyedTable(f"file://{tmp_path}/t", ("key",), buckets=4)
    each, lost = streams.upserted(table, keyed.replaced(("key",)), "latest"), []

    def loses_itself(df, number):
        each(df, number)
        lost.append(number)
        raise RuntimeError("the driver is lost here")

    for n, arrive in arrivals(spark, rows, folder, 3):
        arrive()
        changes = lambda: ledger.latest_per_key(spark.readStream.schema(schema).parquet(folder), "key", "pos", F.col("bad"))
        if n == 1:
            with pytest.raises(Exception, match="lost here"):
                streams.follow(changes(), checkpoint, loses_itself)
        streams.follow(changes(), checkpoint, each)
        so_far = ledger.latest_per_key(spark.read.parquet(folder), "key", "pos", F.col("bad"))
        assert sorted(map(tuple, table.read(spark).select(*so_far.columns).collect())) == sorted(map(tuple, so_far.collect()))
    assert lost and commits.latest(spark, table.path).content["batches"] == {"latest": 2}


def test_people_merge_over_restarts(spark, tmp_path):
    raw = [("d", "Ann Lee", None, None, "u1", 1), ("d", "ann lee!", "Head", "a@d", "u2", 2), ("e", "Bo Y", "x", None, None, 3), ("d", "Dr Ann Lee", "H", "b@d", "u3", 4), ("e", "", None, None, "u", 5), ("e", "Bo  Y", "long title", "b@e", "u6", 6)]
    schema = "domain string, name string, title string, email string, source_url string, pos long"
    rows, folder = spark.createDataFrame(raw, schema), f"file://{tmp_path}/in"
    table = keyed.KeyedTable(f"file://{tmp_path}/t", ("domain", "person_key"), buckets=4)
    each = streams.upserted(table, keyed.replaced(("domain", "person_key")), "people")
    for _, arrive in arrivals(spark, rows, folder, 3):
        arrive()
        streams.follow(people.dedupe_people(spark.readStream.schema(schema).parquet(folder)), f"file://{tmp_path}/c", each)
    want = people.dedupe_people(rows)
    assert sorted(map(tuple, table.read(spark).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_quiet_keys_are_told_once(spark, tmp_path):
    at = lambda m: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    folder, told = f"file://{tmp_path}/in", []
    batches = [[("a", at(0)), ("a", at(4)), ("b", at(1)), (None, at(2))], [("b", at(9))], [("c", at(30))], [("c", at(31)), ("a", at(31))], [("d", at(90))], [("d", at(91))]]
    for batch in batches:
        spark.createDataFrame(batch, "key string, at timestamp").coalesce(1).write.mode("append").parquet(folder)
        stream = streams.quiet_keys(spark.readStream.schema("key string, at timestamp").parquet(folder), "key", "at", 10)
        stream.writeStream.outputMode("append").foreachBatch(lambda df, n: told.extend(tuple(r) for r in df.collect())).option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert sorted(told) == [("a", 1, at(31), at(31)), ("a", 2, at(0), at(4)), ("b", 2, at(1), at(9)), ("c", 2, at(30), at(31))]
