import base64
import json

import pytest
from pyspark.sql import functions as F

from contactloom.operators import models
from contactloom.sources import files, providers
from contactloom.sources.in_flight import in_order
from contactloom.streaming import resume


def test_csv_round_trip(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_bytes('﻿Name,Website\r\n"A ""x""","line\nbreak, comma"\r\n,\r\nshort\r\n'.encode())
    rows = files.read_csv(spark, str(source))
    assert rows.columns == ["Name", "Website", "_pos"]
    assert [(r.Name, r.Website) for r in rows.orderBy("_pos").collect()] == [('A "x"', "line\nbreak, comma"), ("short", None)]
    files.write_csv(rows.withColumn("list", F.array(F.lit("p"), F.lit("q"))), f"{tmp_path}/out")
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert '"A ""x""","line\nbreak, comma",p; q' in text and "\nshort,,p; q" in text


def test_master_must_be_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_master(spark, f"{tmp_path}/none.csv")
    (tmp_path / "m.csv").write_text("domain,name,extra\nd,Ann,1\nd,ann,2\n,Bob,3\n")
    assert [(r.name, r.company) for r in files.read_master(spark, f"{tmp_path}/m.csv", base_only=True).collect()] == [("ann", None)]


def test_ledger_torn_lines_and_redaction(spark, tmp_path):
    schema = "domain string, error string, confidence string, deep array<struct<message:string,note:string>>"
    assert files.read_ledger(spark, f"{tmp_path}/none", schema).count() == 0
    path = f"{tmp_path}/ledger"
    files.append_ledger(spark.createDataFrame([("sk-company", "bad sk-abcdef", "error", [("token sk-zzzzzz", "sk-zzzzzz")])], schema), path)
    files.append_ledger(spark.createDataFrame([("d", None, "high", None), ("d", None, "error", None)], schema).coalesce(1), path)
    (tmp_path / "ledger" / "torn.json").write_text('{"domain": "t"}\n\n{"domain": "half')
    rows = {(r.domain, r.error): r for r in files.read_ledger(spark, path, schema).collect()}
    assert set(rows) == {("sk-company", "bad <redacted>"), ("d", None), ("t", None)}
    assert tuple(rows["sk-company", "bad <redacted>"].deep[0]) == ("token <redacted>", "sk-zzzzzz")
    assert {r.domain: r.confidence for r in files.read_cache(spark, path, schema).where("confidence is not null").collect()} == {"d": "high"}


def test_appends_keep_their_order_whatever_their_sizes(spark, tmp_path):
    """Three appends of falling, then rising size: the last one counts for readers of caches and ledgers."""
    from contactloom.operators import ledger

    schema = "domain string, confidence string, value long"
    for name, sizes in (("falling", (300, 30, 1)), ("rising", (1, 30, 300))):
        path = f"{tmp_path}/{name}"
        for run, size in enumerate(sizes):
            rows = spark.range(size).selectExpr("concat('d', id) domain", "'high' confidence", f"{run} * 1000 + id value").repartition(3)
            files.append_ledger(rows, path)
        found = {r.domain: r.value for r in files.read_cache(spark, path, schema).collect()}
        assert found == {f"d{i}": max(run * 1000 + i for run, size in enumerate(sizes) if i < size) for i in range(300)}
        read = files.read_ledger(spark, path, schema)
        assert {r.domain: r.value for r in ledger.latest_per_key(read, "domain", "_seq").collect()} == found
        assert [r.value // 1000 for r in read.orderBy("_seq").collect()] == [run for run, size in enumerate(sizes) for _ in range(size)]
    files.append_ledger(spark.createDataFrame([("d0", "error", 9)], schema), path)
    assert {r.domain: r.value for r in files.read_cache(spark, path, schema).where("domain = 'd0'").collect()} == {"d0": 2000}


def test_master_of_many_files_keeps_the_last_row_of_a_person(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part-0.csv").write_text("domain,name,title\nd,Ann,first\n")
    (tmp_path / "m" / "part-1.csv").write_text("domain,name,title\n" + "".join(f"e{i},Bob,x\n" for i in range(200)) + "d,ann,last\n")
    found = files.read_master(spark, f"{tmp_path}/m", base_only=True).where("domain = 'd'").collect()
    assert [(r.name, r.title) for r in found] == [("ann", "last")]


def test_csv_is_split_unless_a_cell_goes_on(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n')
    (tmp_path / "b.csv").write_text('x,y\n1,"a ""quoted"" word"\n')
    assert [files._opens_cells(spark, f"{tmp_path}/{n}.csv") for n in "ab"] == [True, False]
    assert [r.y for n in "ab" for r in files.read_csv(spark, f"{tmp_path}/{n}.csv").collect()] == ["two\nlines", 'a "quoted" word']


def test_documents_of_companies(spark, tmp_path):
    path = f"{tmp_path}/companies"
    files.write_companies(spark.createDataFrame([("a.example", 1), ("b.example", 2)], "domain string, people int"), path)
    files.write_companies(spark.createDataFrame([("b.example", 5)], "domain string, people int"), path)
    found = {json.loads(p.read_text())["domain"]: json.loads(p.read_text())["people"] for p in (tmp_path / "companies").glob("company_domain=*/*.json")}
    assert found == {"a.example": 1, "b.example": 5}


def test_pattern_store(spark, tmp_path):
    assert files.import_patterns(spark, f"{tmp_path}/none.json").count() == 0 and files.read_patterns(spark, f"{tmp_path}/none").count() == 0
    store = spark.createDataFrame([("a.example", "first", "ai", "s", ["e"]), ("b.example", "last", None, None, None)], files.STORE)
    files.write_patterns(store, f"{tmp_path}/store")
    (tmp_path / "store" / "torn.json").write_text('{"domain": "half')
    assert sorted(map(tuple, files.read_patterns(spark, f"{tmp_path}/store").collect()), key=str) == sorted(map(tuple, store.collect()), key=str)
    (tmp_path / "p.json").write_text(json.dumps({"a.example": {"pattern": "first", "confidence": "ai", "source": "s", "evidence": ["e"]}}))
    (tmp_path / "bad.json").write_text("{not json")
    assert [tuple(r) for r in files.import_patterns(spark, f"{tmp_path}/p.json").collect()] == [("a.example", "first", "ai", "s", ["e"])]
    assert files.import_patterns(spark, f"{tmp_path}/bad.json").count() == 0


def test_versions_swap_whole(spark, tmp_path):
    path = f"file://{tmp_path}/master"
    files.write_versioned(spark.range(3), path, "v1")
    files.write_versioned(spark.range(5), path, "v2")
    assert files.read_versioned(spark, path).count() == 5 and spark.read.parquet(f"{path}/v1").count() == 3


def test_providers_retry_and_report(spark):
    class Refused(Exception):
        status = 401

    def call(request):
        if request["k"] == 1:
            raise Refused("the key sk-abcdef is bad")
        if request["k"] == 2:
            raise ValueError("no luck")
        return {"answer": str(request["k"] * 2)}

    waits = []
    p = providers.Provider("test", call, "answer string", sleep=waits.append)
    said = lambda k: next(in_order(iter([{"k": k}]), p.answer, 1))[0][1]["error"]
    assert said(2) == "ValueError: no luck" and len(waits) == 2
    assert said(1) == "Refused: the key <redacted> is bad" and len(waits) == 2
    quick = providers.Provider("test", call, "answer string", sleep=lambda s: None)
    rows = {r.k: (r.answer, r.error) for r in providers.ask(spark.range(4).withColumnRenamed("id", "k"), quick, 2).collect()}
    assert rows[3] == ("6", None) and rows[1][1].startswith("Refused") and rows[2][0] is None


def test_two_phase_fetch(spark):
    long = "<p>" + "words " * 200 + "</p>"
    static = spark.createDataFrame([("https://a.example/", long, None), ("https://b.example/", "<div>in</div>", None), ("https://c.example/", None, "down"), ("https://d.example/", '{"data": [1, 2]}', None), ("https://e.example/", "<div>in</div>", None)], "url string, html string, error string")
    dear = spark.createDataFrame([("https://b.example/", long, None), ("https://c.example/", None, "down too"), ("https://e.example/", None, "no")], "url string, html string, error string")
    got = providers.fetch_pages(static.select(F.regexp_replace("url", "https", "http").alias("url")), lambda u: providers.recorded(u, static, "url"), lambda u: providers.recorded(u, dear, "url"))
    found = {r.url[7:8]: (r.rendered, r.error, len(r.html or "")) for r in got.collect()}
    assert found == {"a": (False, None, len(long)), "b": (True, None, len(long)), "c": (False, "down too", 0), "d": (False, None, 16), "e": (False, None, 13)}


def test_captures_and_answers(spark):
    body = lambda s: base64.b64encode(s.encode()).decode()
    raw = [("https://x.example/t", body('{"a": 1234567890123}')), ("https://www.s.example/j", body("[1]")), ("https://s.example/k", body('[1, 2, "é"]')), ("https://s.example/h", body("<html>")), (None, body("[3]"))]
    df = spark.createDataFrame([(raw, "https://s.example/")], "raw array<struct<url:string,body:string>>, page string")
    assert [(c.url, c.body) for c in df.select(providers.captures(F.col("raw"), F.col("page"))).first()[0]] == [("https://s.example/k", '[1, 2, "é"]'), ("https://www.s.example/j", "[1]"), ("https://x.example/t", '{"a": 1234567890123}')]
    said = ['{"email": " A@B.example ", "source_url": "u", "identity_match": "confirmed", "confidence": "high"}', 'Sure: {"email": "", "identity_match": ""} done', "nothing"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in said], "s string").select(providers.search_answer(F.col("s"))).collect()]
    assert tuple(got[0]) == ("a@b.example", "u", "confirmed", "high", "") and tuple(got[1])[2:4] == ("uncertain", "low") and got[2] is None


def test_driver_side_rules():
    assert len(providers.interaction("click", ".more", 99)) == 2 + 3 * 12 and providers.interaction("render") == [] and len(providers.interaction("scroll", rounds=0)) == 4
    assert [providers.health(s) for s in (200, 429, 401, None)] == ["PASS", "PASS", "FAIL", "FAIL"] and providers.health(None, False) == "SKIP"
    assert providers.may_go_on(89.9) and not providers.may_go_on(90) and not providers.may_go_on(None)
    assert providers.is_rate_limited("HTTP 429") and not providers.is_rate_limited("page 4290")
    assert "rejected" in providers.explain(401, "", "m", "e") and "deployment" in providers.explain(404, "", "m", "https://x.azure.example")


def test_model_steps_with_recorded_answers(spark):
    entries = spark.createDataFrame([("s", 1, "https://s/", None), ("s", 2, "https://s/team", "Team"), ("s", 3, "https://s/team/ann", None)], "key string, entry int, url string, title string")
    answer = '```json\n{"candidates": [{"index": 2, "score": 90, "reason": "r", "kind": "profile"}, {"index": 1, "score": 88.5, "reason": "r", "kind": "directory"}, {"index": 9, "score": 99, "reason": "?", "kind": "other"}], "profilePrefixes": ["/team"]}\n```'
    seen = []
    model = providers.Provider("rank", lambda r: {"answer": answer}, "answer string")
    candidates, profiles = models.rank_pages(entries, model)
    assert [(r["rank"], r.url, r.score) for r in candidates.orderBy("rank").collect()] == [(1, "https://s/team", 89), (2, "https://s/team/ann", 90)]
    assert [r.url for r in profiles.collect()] == ["https://s/team/ann"] and seen == []
    pages = spark.createDataFrame([("s", "https://s/team", "<p>Ann</p>", 0)], "domain string, url string, html string, pos long")
    reader = providers.Provider("read", lambda r: {"answer": '{"people": [{"name": "Ann Lee", "title": "Dr", "email": "ANN@s "}, {"name": " "}, {"name": "Nav Bar"}]}'}, "answer string")
    raw = models.extract_people(pages, reader)
    assert [(r.name, r.email, r.source_url) for r in raw.collect()] == [("Ann Lee", "ann@s", "https://s/team"), ("Nav Bar", None, "https://s/team")]
    more = raw.unionByName(spark.createDataFrame([("s", "A. Bo", "Head", None, "https://s/bo", 9), ("t", "Cy Dee", None, None, "https://t/", 1)], raw.schema))

    def organise(request):
        if request["domain"] == "t":
            return {"answer": "no JSON"}
        assert request["prompt"] == "A. Bo | Head | \nAnn Lee | Dr | ann@s\nNav Bar |  | "
        return {"answer": '{"people": [{"name": " Ann LEE ", "title": " ", "email": "Ann@S"}, {"name": "Abe Bo", "title": "Head"}, {"name": ""}]}'}

    found = {(r.domain, r.name): (r.title, r.email, r.source_url, r.place) for r in models.organise_people(more, providers.Provider("organise", organise, "answer string")).collect()}
    assert found == {("s", "Ann LEE"): (None, "ann@s", "https://s/team", 0), ("s", "Abe Bo"): ("Head", None, None, 1), ("t", "Cy Dee"): (None, None, "https://t/", None)}
    large = models.organise_people(more, providers.Provider("organise", organise, "answer string"), most=2)
    assert sorted(r.name for r in large.collect()) == ["A. Bo", "Ann Lee", "Cy Dee", "Nav Bar"]
    folk = spark.createDataFrame([("s", "Ann Lee", 1)], "domain string, name string, pos long")
    proof = spark.createDataFrame([("s", "lee-a@s", 1)], "domain string, email string, pos long")
    judge = lambda t: providers.Provider("judge", lambda r: {"answer": json.dumps({"pattern": t})}, "answer string")
    domains = spark.createDataFrame([("s",)], "domain string")
    assert [r.pattern for r in models.judge_patterns(domains, folk, proof, judge("{last}-{fi}")).collect()] == ["{last}-{fi}"]
    assert models.judge_patterns(domains, folk, proof, judge("{first}")).collect() == []


def test_resume_goes_on_where_it_stopped(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/in/one.parquet")
    (first,) = (tmp_path / "in" / "one.parquet").glob("*.parquet")
    folder = tmp_path / "stream"
    folder.mkdir()
    first.rename(folder / "a.parquet")
    seen = []
    run = lambda: resume.run_available(spark, f"file://{folder}", "*.parquet", "id long", f"file://{tmp_path}/cp", lambda df, n: seen.extend(r.id for r in df.collect()))
    assert run() == 1 and run() == 0 and sorted(seen) == [0, 1, 2]
    spark.range(3, 5).coalesce(1).write.parquet(f"{tmp_path}/in/two.parquet")
    next((tmp_path / "in" / "two.parquet").glob("*.parquet")).rename(folder / "b.parquet")
    assert run() == 1 and sorted(seen) == [0, 1, 2, 3, 4]


def test_calls_of_one_site_share_a_time_limit(spark):
    """Each call takes a second by this clock: two sites of four pages get two each, in order, and keep what was answered."""
    ticks = iter(range(10_000))
    slow = providers.Provider("slow", lambda request: {"answer": request["key"] + str(request["pos"])}, "answer string")
    requests = spark.createDataFrame([(k, p) for p in range(4) for k in "ab"], "key string, pos int").coalesce(1)
    rows = providers.ask_within(requests, slow, "key", "pos", 2, clock=lambda: next(ticks)).collect()
    assert {(r.key, r.pos): (r.answer, r.error) for r in rows} == {(k, p): ((f"{k}{p}", None) if p < 2 else (None, "over the time limit")) for k in "ab" for p in range(4)}


def test_services_by_mode_and_limit(spark):
    seen = providers.Provider("echo", lambda r: {"html": f"{r['fetch_url']} {r['mode']} {r['seconds']}"}, "html string")
    urls = spark.createDataFrame([("http://a.test/",)], "url string")
    assert [r.html for r in providers.fetching(seen)(urls).collect()] == ["https://a.test/ static 20"]
    assert [r.html for r in providers.fetching(seen, rendered=True)(urls).collect()] == ["https://a.test/ rendered 60"]
    maps = providers.Provider("map", lambda r: {"links": [{"url": f"{r['url']}{i}", "title": None} for i in range(5)]}, "links array<struct<url:string,title:string>>")
    found = providers.map_sites(spark.createDataFrame([("a", "https://a.test/")], "key string, original string"), providers.asking(maps), limit=3).first()
    assert [x.url for x in found.links] == ["https://a.test/0", "https://a.test/1", "https://a.test/2"] and found.error is None
    assert providers.models(seen) == (seen, seen) and providers.models(seen, maps) == (seen, maps)


def test_a_meter_stops_a_run_and_the_next_goes_on(spark, tmp_path):
    from contactloom.operators import rounds

    path, log, bad = f"{tmp_path}/ledger", [], {3}
    requests = spark.range(10).withColumnRenamed("id", "k").repartition(3)

    def service(asked):
        log.append(sorted(r.k for r in asked.collect()))
        return asked.withColumns({"said": F.col("k") * 2, "error": F.when(F.col("k").isin(list(bad)), "no luck")})

    def run(*readings, **more):
        left = iter(readings)
        return rounds.ask_in_rounds(requests, service, path, "k", "k", "said long", lambda: next(left), size=3, **more)

    assert run(1, 2, 95) == (2, True) and log == [[0, 1, 2], [3, 4, 5]]
    assert run(None) == (0, True) and len(log) == 2
    bad.clear()
    assert run(1, 1, limit=4) == (2, False) and log[2:] == [[3, 6, 7], [8]]
    assert run(1) == (1, False) and log[4:] == [[9]] and run() == (0, False)
    told = files.read_ledger(spark, path, "k long, said long, error string, asked int").where("error is null").collect()
    assert sorted(r.k for r in told) == list(range(10)) and all(r.said == 2 * r.k for r in told)
