"""Calls of services: several at once, answers in order, limits on what is taken and on time."""

import asyncio
import threading
import time

from pyspark.sql import functions as F

from contactloom.sources import providers
from contactloom.sources.in_flight import WAITING, in_order


async def slow(request):
    await asyncio.sleep(0.05)
    return {"answer": request["k"] * 2}


def test_forty_calls_take_the_time_of_one():
    for call in (slow, lambda request: time.sleep(0.05) or {"answer": request["k"] * 2}):
        p = providers.Provider("test", call, "answer long")
        began = time.perf_counter()
        told = [x for group in in_order(({"k": k} for k in range(40)), p.answer, 40) for x in group]
        assert time.perf_counter() - began < 0.6
        assert told == [({"k": k}, {"answer": 2 * k, "error": None}) for k in range(40)]


def test_no_more_at_once_and_no_more_taken_than_the_window():
    now, most, taken, lock = 0, 0, 0, threading.Lock()

    def call(request):
        nonlocal now, most
        with lock:
            now += 1
            most = max(most, now)
        time.sleep(0.002)
        with lock:
            now -= 1
        return {"answer": request["k"]}

    def requests():
        nonlocal taken
        for k in range(200):
            taken += 1
            yield {"k": k}

    given = 0
    for group in in_order(requests(), providers.Provider("test", call, "answer long").answer, 3):
        given += len(group)
        assert taken - given < WAITING * 3 + 1
        time.sleep(0.001)
    assert given == 200 and most == 3


def test_a_slow_call_keeps_its_place_and_holds_nobody_up():
    async def call(request):
        await asyncio.sleep(0.2 if request["k"] == 0 else 0.01)
        return {"answer": request["k"]}

    began = time.perf_counter()
    groups = list(in_order(({"k": k} for k in range(12)), providers.Provider("test", call, "answer long").answer, 4))
    assert [r["k"] for g in groups for r, _ in g] == list(range(12)) and time.perf_counter() - began < 0.4


def test_time_limits_and_retries():
    tries = {}

    async def call(request):
        tries[request["k"]] = tries.get(request["k"], 0) + 1
        if request["k"] == 1:
            await asyncio.sleep(5)
        if request["k"] == 2 and tries[2] < 3:
            raise ValueError("not yet")
        return {"answer": request["k"]}

    p = providers.Provider("test", call, "answer long", providers.Retry(first_wait=0.01), seconds=0.05)
    began = time.perf_counter()
    told = {r["k"]: (a.get("answer"), a["error"]) for g in in_order(({"k": k} for k in range(4)), p.answer, 4) for r, a in g}
    assert told == {0: (0, None), 1: (None, "TimeoutError: no answer in 0.05 seconds"), 2: (2, None), 3: (3, None)}
    assert tries == {0: 1, 1: 3, 2: 3, 3: 1} and time.perf_counter() - began < 1


def test_rows_keep_their_order_in_a_task(spark):
    async def slow(request):
        await asyncio.sleep(0.1)
        return {"answer": request["k"] * 2}

    rows = spark.range(200).withColumnRenamed("id", "k").coalesce(1)
    began = time.perf_counter()
    told = providers.ask(rows, providers.Provider("test", slow, "answer long"), at_once=40).collect()
    assert [(r.k, r.answer, r.error) for r in told] == [(k, 2 * k, None) for k in range(200)]
    assert time.perf_counter() - began < 12  # two hundred calls of 100 ms


def test_sites_share_a_task_but_not_their_time(spark):
    """Every site has 0.3 seconds: its fourth page comes too late, whatever the others do meanwhile."""
    async def call(request):
        await asyncio.sleep(0.12)
        return {"answer": request["pos"]}

    rows = spark.range(40).selectExpr("concat('s', id div 5) site", "cast(id % 5 as int) pos").coalesce(1)
    began = time.perf_counter()
    told = providers.ask_within(rows, providers.Provider("test", call, "answer int"), "site", "pos", 0.3, at_once=16).collect()
    late = {(r.site, r.pos) for r in told if r.error == "over the time limit"}
    assert late == {(f"s{s}", p) for s in range(8) for p in (3, 4)} and all(r.answer == r.pos for r in told if r.error is None)
    assert time.perf_counter() - began < 12


def test_requests_of_a_table_in_one_file_are_dealt_to_many_tasks(spark):
    from contactloom.plans import source_queries

    asked = source_queries.answers_in_flight(spark, "/root/testdata/sf0.1").withColumn("task", F.spark_partition_id())
    tasks = {r.task: r.n for r in asked.groupBy("task").agg(F.count("*").alias("n")).collect()}
    assert sum(tasks.values()) == 15_000 and len(tasks) > 2 * spark.sparkContext.defaultParallelism and max(tasks.values()) < 1000
