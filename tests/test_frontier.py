"""The explorer's loop: rounds, the gate before interaction, the cache, the budget of steps, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from contactloom.operators import frontier
from contactloom.sources import providers

MORE = '<button id="more">Load more</button>'
#: Pages of a site by address and mode.
SITE = {
    ("https://a.test/", "none"): '<a href="/team">Team</a><a href="/gone">Gone</a> info@a.test',
    ("https://a.test/team", "none"): f"<body><p>Ann Lee</p>{MORE}</body>",
    ("https://a.test/team", "click"): "<body><p>Ann Lee</p><p>Bo Yi</p></body>",
    ("https://b.test/", "none"): "<p>nothing here</p>",
}
#: What each explorer asks for, one wish after another.
PLANS = {
    "a.test": [("visit", "a.test/team", "scroll", ""), ("extract", "https://a.test/team", None, None), ("extract", "https://a.test/team", "click", " "), ("visit", "https://a.test/gone", "none", ""), ("visit", "https://a.test/gone", "none", ""), ("extract", "https://a.test/team", "none", ""), ("done", None, None, None)],
    "b.test": [("visit", "https://b.test/", "click", ""), ("answer", "x", None, None)], "c.test": [],
}


def run(spark, folder, log, steps=16, stop_after=None):
    def decide(asked):
        rows = [(r.key, r.step, *(PLANS[r.key][r.step - 2] if r.step - 2 < len(PLANS[r.key]) else ("done", None, None, None))) for r in asked.collect()]
        return spark.createDataFrame(rows, "key string, step int, tool string, url string, mode string, selector string")

    def fetch(asked):
        rows = [tuple(r) for r in asked.collect()]
        log.append(sorted((r[1], r[2], r[3]) for r in rows))
        if stop_after is not None and len(log) > stop_after:
            raise RuntimeError("stopped")
        return spark.createDataFrame([(*r, SITE.get((r[1], r[2])), None if (r[1], r[2]) in SITE else "HTTP 404") for r in rows], "key string, url string, mode string, selector string, html string, error string")

    def read(request):
        return {"answer": json.dumps({"people": [{"name": line, "title": None, "email": None} for line in request["prompt"].split("\n") if line[:1] in "AB" and " " in line]})}

    sites = spark.createDataFrame([(k, f"https://{k}/") for k in PLANS], "key string, original string")
    return frontier.explore(sites, fetch, decide, folder, providers.Provider("rule", read, "answer string"), steps)


def told(done):
    return {(r.key, r.step): (r.tool, r.url, r.mode, r.error, r.people) for r in done.answers.collect()}


WANT = {
    ("a.test", 1): ("visit", "https://a.test/", "none", None, None), ("a.test", 2): ("visit", "https://a.test/team", "scroll", "fetch it without interaction first", None),
    ("a.test", 3): ("extract", "https://a.test/team", "none", None, 1), ("a.test", 4): ("extract", "https://a.test/team", "click", None, 2), ("a.test", 5): ("visit", "https://a.test/gone", "none", "HTTP 404", None),
    ("a.test", 6): ("visit", "https://a.test/gone", "none", "HTTP 404", None), ("a.test", 7): ("extract", "https://a.test/team", "none", None, 1),
    ("b.test", 1): ("visit", "https://b.test/", "none", None, None), ("b.test", 2): ("visit", "https://b.test/", "click", "no control to click on this page", None), ("c.test", 1): ("visit", "https://c.test/", "none", "HTTP 404", None),
}
FETCHES = [("https://a.test/", "none", None), ("https://b.test/", "none", None), ("https://c.test/", "none", None), ("https://a.test/team", "none", None), ("https://a.test/team", "click", "#more"), ("https://a.test/gone", "none", None), ("https://a.test/gone", "none", None)]


def test_rounds_gate_and_cache(spark, tmp_path):
    log = []
    done = run(spark, f"file://{tmp_path}/x", log)
    assert told(done) == WANT and [f for r in log for f in r] == FETCHES
    first = done.answers.where("key = 'a.test' and step = 1").first()
    assert [tuple(x) for x in first.links] == [("https://a.test/team", "Team"), ("https://a.test/gone", "Gone")] and first.emails == ["info@a.test"]
    assert [tuple(c) for c in done.answers.where("key = 'a.test' and step = 3").first().controls] == [("#more", "Load more")]
    assert sorted(r.name for r in done.people.collect()) == ["Ann Lee", "Ann Lee", "Ann Lee", "Bo Yi"]
    assert {r.key for r in done.ended.collect()} == set(PLANS) and done.pages.count() == 4
    run(spark, f"file://{tmp_path}/x", log)
    assert [f for r in log for f in r] == FETCHES  # nothing is left to ask for


def test_a_stopped_run_goes_on(spark, tmp_path):
    log, folder = [], f"file://{tmp_path}/x"
    with pytest.raises(RuntimeError):
        run(spark, folder, log, stop_after=3)
    assert told(run(spark, folder, log)) == WANT
    assert log[4] == log[3] and [f for r in log[:3] + log[4:] for f in r] == FETCHES


def test_steps_are_bounded(spark, tmp_path):
    done = run(spark, f"file://{tmp_path}/x", [], steps=3)
    assert told(done) == {k: v for k, v in WANT.items() if k[1] <= 3}
