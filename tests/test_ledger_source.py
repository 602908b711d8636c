"""The ledger as a data source: runs whole or not at all, order, pruning, splits, streams."""

import json

import pytest
from pyspark.sql import functions as F

from contactloom.sources import ledger_source as source

SCHEMA = "domain string, error string, value long, deep array<struct<message:string,n:int>>, share double, ok boolean"


def rows(spark, start, n):
    return spark.range(start, start + n).selectExpr("concat('d', id % 7) domain", "if(id % 3 = 0, 'key sk-abcdef refused', null) error", "id value", "array(struct('token sk-zzzzzz' as message, cast(id as int) as n)) deep", "id / 8 share", "id % 2 = 0 ok")


@pytest.fixture
def ledger(spark, tmp_path):
    source.register(spark)
    path = f"{tmp_path}/ledger"
    for run, n in enumerate((300, 20, 1)):
        source.append(rows(spark, 1000 * run, n).repartition(3).sortWithinPartitions("value"), path)
    return path


def test_runs_keep_their_order_and_lose_secrets(spark, ledger):
    read = spark.read.format("ledger").load(ledger)
    assert read.schema.simpleString() == spark.createDataFrame([], SCHEMA + ", _run long, _at long").schema.simpleString()
    got = read.orderBy("_run", "_at").collect()
    assert [r._run for r in got] == [1] * 300 + [2] * 20 + [3] and sorted(r.value for r in got) == [*range(300), *range(1000, 1020), 2000]
    assert len({(r._run, r._at) for r in got}) == 321
    assert {r.error for r in got} == {None, "key <redacted> refused"} and {r.deep[0].message for r in got} == {"token <redacted>"}
    assert all(r.share == r.value / 8 and r.ok == (r.value % 2 == 0) and r.domain == f"d{r.value % 7}" and r.deep[0].n == r.value for r in got)


def test_fewer_and_further_fields(spark, ledger):
    read = spark.read.format("ledger").schema("value long, nowhere string, _run long").load(ledger)
    assert read.where("nowhere is not null").count() == 0 and read.groupBy("_run").count().orderBy("_run").collect() == [(1, 300), (2, 20), (3, 1)]


def test_filters_leave_files_out(spark, ledger):
    read = spark.read.format("ledger").load(ledger)
    for condition, n in (("value >= 1010", 11), ("_run = 2", 20), ("value = 5", 1), ("value in (5, 2000)", 2), ("domain = 'nowhere'", 0), ("_run > 1 and value < 1003", 3), ("share <= 0.125", 2), ("value > 5000", 0)):
        found = read.where(condition)
        assert found.count() == n, condition
    assert read.where("value >= 1010").rdd.getNumPartitions() == 4 and read.where("_run = 3").rdd.getNumPartitions() == 1
    assert source.rules_out([], 1, {}) is False


def test_a_failed_write_leaves_nothing(spark, ledger, tmp_path):
    broken = rows(spark, 0, 100).repartition(4).withColumn("domain", F.when(F.col("value") == 77, F.raise_error(F.lit("no luck"))).otherwise(F.col("domain")))
    before = {p.name for p in (tmp_path / "ledger" / "data").iterdir()}
    with pytest.raises(Exception, match="no luck"):
        source.append(broken, ledger)
    assert spark.read.format("ledger").load(ledger).count() == 321 and len(source.runs(ledger)) == 3
    assert {p.name for p in (tmp_path / "ledger" / "data").iterdir()} == before
    source.append(rows(spark, 0, 0), ledger)
    assert len(source.runs(ledger)) == 3
    with pytest.raises(Exception, match="only appended"):
        rows(spark, 0, 1).write.format("ledger").mode("overwrite").save(ledger)


def test_splits_cut_files_anywhere(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    source.register(spark)
    source.append(rows(spark, 0, 200).coalesce(1), path)
    schema = source.with_places(SCHEMA)
    for size in (1, 37, 150, 1 << 20):
        monkeypatch.setattr(source, "SPLIT_BYTES", size)
        got = [v for s in source.splits(source.runs(path)[0]) for b in source.records(path, s, schema) for v in b.column("value").to_pylist()]
        assert got == list(range(200)), size


def test_two_writers_get_two_numbers(tmp_path):
    path = str(tmp_path / "ledger")
    assert [source.commit_run(path, {"files": []}) for _ in range(3)] == [1, 2, 3]
    (tmp_path / "ledger" / "_runs" / f"{4:020d}.json").write_text(json.dumps({"run": 4, "files": []}))
    assert source.commit_run(path, {"files": []}) == 5 and not list((tmp_path / "ledger" / "_runs").glob("*.part"))


def test_streams_go_on_from_the_last_run(spark, tmp_path):
    source.register(spark)
    path, told = f"{tmp_path}/ledger", []

    def follow():
        stream = spark.readStream.format("ledger").schema(source.with_places(SCHEMA)).load(path)
        stream.writeStream.foreachBatch(lambda df, n: told.extend((r._run, r.value) for r in df.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()

    source.append(rows(spark, 0, 10), path)
    source.append(rows(spark, 10, 5), path)
    follow()
    assert sorted(told) == [(1, v) for v in range(10)] + [(2, v) for v in range(10, 15)]
    follow()
    source.append(rows(spark, 20, 3), path)
    follow()
    assert sorted(told)[15:] == [(3, 20), (3, 21), (3, 22)] and len(told) == 18
