from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contactloom.functions import provenance
from contactloom.operators import crawl, decide, domains, harvest, inboxes, ledger, patterns, people

MASTER = "domain string, name string, title string, company string, website string, email string, email_source_url string, web_found_email string, web_found_source string, web_found_confidence string, business_email string, all_business_emails string"
CACHE, STORE = "domain string, email_domain string, provider string, confidence string", "domain string, pattern string, confidence string, source string"


def person(name="Ada Quill", domain="a.example", email=None, web=None, conf=None, business=None):
    return (domain, name, "Dr", "A", "https://a.example", email, "https://a.example/team", web, "https://w.example", conf, business, None)


def decided(spark, rows, cache=(), store=()):
    out = decide.decide(spark.createDataFrame(rows, MASTER), spark.createDataFrame(list(cache), CACHE), spark.createDataFrame(list(store), STORE))
    return {r.name: r for r in out.collect()}, out


def test_decision_order(spark):
    rows = [person("Known One", email=" k@a.example ", web="w@x.example"), person("Web Two", web="w@x.example"), person("Dead Three", "dead.example"), person("—", "a.example"), person("Zed"), person("Ada Quill"), person("Bea Ash", "learn.example"), person("Cy Fox", "tpl.example"), person("Di Orr", "biz.example", business="info@other.example; x@y")]
    cache = [("dead.example", None, None, "none"), ("a.example", "a.example", "p", "high"), ("tpl.example", "tpl.example", "p", "medium"), ("biz.example", "biz.example", "p", "high")]
    store = [("learn.example", "filast", "deterministic", "proof"), ("tpl.example", "{last}-{fi}", "ai", "proof2"), ("a.example", "nonsense", "ai", "x")]
    found, _ = decided(spark, rows, cache, store)
    want = {
        "Known One": ("k@a.example", "known"), "Web Two": ("w@x.example", "web-found:low"), "Dead Three": (None, "no-domain"), "—": (None, "no-name"), "Zed": ("zed@a.example", "default:first"), "Ada Quill": ("ada.quill@a.example", "default:first.last"),
        "Bea Ash": ("bash@learn.example", "learned:filast(unverified-domain)"), "Cy Fox": ("fox-c@tpl.example", "learned:{last}-{fi}(ai)"), "Di Orr": ("di.orr@other.example", "default:first.last")}
    assert {n: (r.best_email, r.basis) for n, r in found.items()} == want
    assert found["Cy Fox"].candidates[0] == "fox-c@tpl.example" and len(found["Cy Fox"].candidates) == 18
    assert found["Bea Ash"].candidates[:2] == ["bash@learn.example", "bea.ash@learn.example"] and len(set(found["Bea Ash"].candidates)) == len(found["Bea Ash"].candidates)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("knowebfudlarit:-() .", max_size=18) | st.sampled_from(["known", "web-found:high", "learned:x", "default:first"]), min_size=1, max_size=30))
def test_only_published_and_found_addresses_are_sent(spark, bases):
    rows = spark.createDataFrame([(b,) for b in bases], "basis string").withColumn("sendable", provenance.basis_status(F.col("basis"))["sendable"])
    ready, verify = decide.route(rows)
    assert decide.check_routing(ready.withColumn("basis", F.trim("basis"))).count() == 0
    assert Counter(r.basis for r in ready.union(verify).collect()) == Counter(bases)


def test_basis_flags_in_either_order(spark):
    rows = spark.createDataFrame([("learned:filast(unverified-domain)(ai)",), ("learned:filast(ai)(unverified-domain)",), (None,), ("mystery",)], "basis string")
    found = [tuple(r[0]) for r in rows.select(provenance.basis_status(F.col("basis"))).collect()]
    assert found[0] == found[1] and not any(f[2] for f in found) and found[2][1] == "Unknown" and found[3][1] == "mystery"


def test_ledger_semantics(spark):
    rows = spark.createDataFrame([("a", 1, "good", None), ("a", 2, None, "failed"), ("b", 1, None, "failed"), ("c", 1, "x", None), ("c", 1, "y", None), (None, 1, "n", None)], "k string, seq int, v string, error string")
    failed = F.col("error").isNotNull()
    assert {r.k: r.v for r in ledger.latest_per_key(rows, "k", "seq", failed).collect()} == {"a": "good", "c": "y", None: "n"}
    assert {r.k: r.error for r in ledger.last_with_failures(rows, "k", "seq").collect()} == {"a": "failed", "b": "failed", "c": None, None: None}
    targets = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    assert sorted(r.k for r in ledger.pending(targets, rows, "k", failed).collect()) == ["b", "z"]


def test_people_move_address_and_page_together(spark):
    raw = spark.createDataFrame([("d", "Ann Lee", "", None, "u1", 1), ("d", "ANN LEE.", "Dr", "ann@d.example", "u2", 2), ("d", "Ann  Lee", "Prof", "later@d.example", "u3", 3), ("d", "...", "x", None, "u", 4)], "domain string, name string, title string, email string, source_url string, pos long")
    (r,) = people.dedupe_people(raw).collect()
    assert (r.name, r.title, r.email, r.source_url) == ("ANN LEE.", "Prof", "ann@d.example", "u2")


def test_patterns_vote_and_proof(spark):
    folk = spark.createDataFrame([("d", "Ada Quill", 1), ("d", "Ben Ash", 2), ("d", "Zed", 3)], "domain string, name string, pos long")
    proof = spark.createDataFrame([("d", "ada@d", 1), ("d", "ben.ash@d", 2), ("d", "bash@d", 3), ("d", "aquill@d", 4)], "domain string, email string, pos long")
    (r,) = patterns.learn_patterns(folk, proof).collect()
    assert (r.pattern, r.votes) == ("filast", 2)
    (tie,) = patterns.learn_patterns(folk, proof.where("pos < 3")).collect()
    (ranked,) = patterns.learn_patterns(folk, proof.where("pos < 3"), by_rank=True).collect()
    assert tie.pattern == "first" and ranked.pattern == "first.last"
    gate = patterns.proof_gate(spark.createDataFrame([("d", "{fi}{last}"), ("d", "{last}.{fi}")], "domain string, pattern string"), folk, proof)
    assert [(g.pattern, g.source) for g in gate.collect()] == [("{fi}{last}", "bash@d")]


def test_published_addresses_are_never_sent_whole_to_the_driver(spark):
    """Few names on many rows: votes count the rows, and neither side of the join is broadcast, however small its file."""
    folk = spark.range(3000).selectExpr("concat('d', id % 2) domain", "if(id % 3 > 0, 'Ann Bell', 'Cy Dee') name", "id pos").repartition(3)
    proof = spark.createDataFrame([("d0", "ann.bell@d0", 4), ("d0", "ann.bell@mail.d0", 5), ("d0", "cd@d0", 3), ("d1", "nobody@d1", 1)], "domain string, email string, pos long")
    matched = patterns.matched_evidence(folk, proof)
    assert sorted(map(tuple, matched.collect())) == [("d0", "ann.bell@d0", 4), ("d0", "ann.bell@mail.d0", 5), ("d0", "cd@d0", 3)]
    learnt = patterns.learn_patterns(folk, proof)
    assert [(r.domain, r.pattern, r.votes, r.source) for r in learnt.collect()] == [("d0", "first.last", 2000, "cd@d0")]
    gate = patterns.proof_gate(spark.createDataFrame([("d0", "{first}.{last}"), ("d1", "{first}")], "domain string, pattern string"), folk, proof)
    assert [tuple(r) for r in gate.collect()] == [("d0", "{first}.{last}", "ann.bell@d0")]
    assert all("BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString() for df in (matched, learnt))


def test_addresses_of_a_master_in_one_file_are_found_in_many_tasks(spark):
    rows = spark.range(0, 4000, 1, 1).selectExpr("'www.d.test' domain", "id pos", "concat('P', id % 50, '@d.test; info@d.test ') email", "'x@other.test,,box@mail.test' related_email")
    found = patterns.master_evidence(rows, spark.createDataFrame([("www.d.test", "mail.test")], "domain string, email_domain string"))
    got = {r.email: (tuple(r.pos), r.personal) for r in found.collect()}
    assert got == {**{f"p{i}@d.test": ((i, 0, 0), True) for i in range(50)}, "info@d.test": ((0, 0, 1), False), "box@mail.test": ((0, 3, 2), True)}
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()


def test_mail_domains(spark):
    records = spark.createDataFrame([("a.example", 20, "mail.other.example", "NOERROR"), ("a.example", 10, "aspmx.l.google.com.", "NOERROR"), ("n.example", None, None, "NXDOMAIN"), ("f.example", None, None, "SERVFAIL"), ("m.example", 5, "mx.m.example", "NOERROR")], "domain string, priority int, exchange string, rcode string")
    targets = spark.createDataFrame([(x,) for x in ("https://www.a.example/x", "n.example", "f.example", "m.example", "zz.example", "bad")], "raw string")
    found = {r.raw: (r.confidence, r.provider, r.has_mx) for r in domains.resolve_domains(targets, records).collect()}
    assert found == {"https://www.a.example/x": ("high", "Google Workspace", True), "n.example": ("none", None, False), "f.example": ("error", None, None), "m.example": ("medium", "other/self-hosted", True), "zz.example": ("error", None, None), "bad": ("invalid", None, None)}


def test_inbox_only_company_appears(spark):
    rec = "domain string, company string, website string, business_emails array<string>, business_email_source_url string, error string, _seq long"
    rel = "domain string, company string, website string, own_emails array<string>, related_emails array<string>, sources map<string,string>, error string, _seq long"
    business = spark.createDataFrame([("d", "D", "w", ["info@d"], "p1", None, 1), ("d", "D", "w", [], None, "failed", 2)], rec)
    related = spark.createDataFrame([("e", "E", "w", [], ["x@f"], {"x@f": "p2"}, None, 1), ("d", None, None, ["b@d"], [], {"info@d": "p3"}, None, 3)], rel)
    rows = {r.domain: r for r in inboxes.inbox_rows(inboxes.build_inboxes(business, spark.createDataFrame([], rec), related)).collect()}
    assert (rows["d"].email, rows["d"].all_business_emails, rows["d"].proof, rows["d"].company) == ("info@d", "info@d; b@d", "p3", "D")
    assert (rows["e"].email, rows["e"].source, rows["e"].proof) == ("x@f", "Published on an affiliated domain", "p2")


def test_harvest_reads_home_and_contact_pages(spark):
    pages = spark.createDataFrame([
        ("https://a.test/", '<a href="/reach-us">Find us</a> ann@a.test x@gmail.com', None), ("https://a.test/reach-us", "info@a.test ann@a.test", None), ("https://a.test/contact", "late@a.test", None),
        ("https://b.test/", None, "HTTP 500")], "url string, html string, error string")
    sites = crawl.targets(spark.createDataFrame([("A", "a.test", 1), ("B", "b.test", 2), ("A again", "www.a.test", 3), ("none", "", 4)], "Name string, Website string, pos int"), "Website", "Name", "pos")
    fetch = lambda urls: urls.join(pages, "url", "left")
    rows = {r.domain: r for r in harvest.harvest(sites, fetch).collect()}
    assert rows["a.test"].own == ["info@a.test", "ann@a.test", "late@a.test"] and rows["a.test"].pages == 3 and rows["a.test"].company == "A"
    assert rows["a.test"].sources["info@a.test"] == "https://a.test/reach-us" and rows["a.test"].sources["ann@a.test"] == "https://a.test/"
    assert rows["b.test"].error == "HTTP 500" and rows["b.test"].own == []


def test_crawl_choices(spark):
    candidates = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(s).alias("score"), F.lit(k).alias("kind")) for u, s, k in (("a", 90, "directory"), ("b", 99, "profile"), ("c", 84, "other"), ("d", 85, "other"))])
    assert [c.url for c in spark.range(1).select(crawl.shortlist(candidates)).first()[0]] == ["a", "d"]
    sweep = lambda n: spark.range(1).select(crawl.to_sweep(F.array(*map(F.lit, ("https://www.x/p/1/", "https://x/p/2", "https://x/p/3"))), F.array(F.lit("http://x/p/1")), F.lit(n))).first()[0]
    assert sweep(1) == ["https://x/p/2", "https://x/p/3"] and sweep(3) == []
    kinds = "company string, website string, candidates array<struct<url:string,title:string,score:int,reason:string,kind:string>>, profile_urls array<string>, error string"
    rows = crawl.rank_report(spark.createDataFrame([("A", "w", [("u1", "t", 90, "r", "directory")], ["u1", "u2"], None), ("B", "w", [], [], None), ("C", "w", [], [], "bad")], kinds)).collect()
    assert [(r.company, r["rank"], r.url, r.reason, r.error) for r in rows] == [("A", 1, "u1", "r", None), ("A", None, "u2", "expanded from profile prefix", None), ("B", None, None, "no candidate pages found", None), ("C", None, None, None, "bad")]
    assert [r.Name for r in crawl.only_fragments(spark.createDataFrame([("Alpha",), ("beta",)], "Name string"), ["LPH"], "Name").collect()] == ["Alpha"]


def test_cap_of_candidates_and_what_it_drops(spark):
    """A cap of three: the site's own page and its first two others stay, the rest are counted."""
    sites = spark.createDataFrame([("a.test", "https://a.test/")], "key string, original string")
    links = spark.createDataFrame([("a.test", f"https://a.test/p{i}", "t", i) for i in range(6)], "key string, url string, title string, pos long")
    assert [r.url for r in crawl.candidate_links(sites, links, cap=3).orderBy("entry").collect()] == ["https://a.test/", "https://a.test/p0", "https://a.test/p1"]
    assert tuple(crawl.overflow(sites, links, cap=3).first()) == ("a.test", 3, 4)


def test_no_service_is_asked_twice(spark, tmp_path):
    """Every call leaves a file; a stage whose answers are read several times still asks once for each site."""
    from contactloom.operators import stages
    from contactloom.sources.providers import Provider, asking

    calls = tmp_path / "calls"
    calls.mkdir()

    def logged(kind, answer):
        def call(request):
            import uuid

            (calls / f"{kind}-{uuid.uuid4().hex}").touch()
            return answer

        return call

    sites = spark.createDataFrame([("a.test", "A", "https://a.test/"), ("b.test", "B", "https://b.test/")], "key string, company string, original string")
    mapping = Provider("map", logged("map", {"links": [{"url": "https://a.test/team", "title": "Team"}]}), "links array<struct<url:string,title:string>>")
    model = Provider("rank", logged("rank", {"answer": '{"candidates": [{"index": 1, "score": 90, "reason": "r", "kind": "directory"}], "profilePrefixes": ["/team"]}'}), "answer string")
    rows = {r.key: [p.url for p in r.pages] for r in stages.team_pages(sites, asking(mapping), model).collect()}
    assert rows == {"a.test": ["https://a.test/team"], "b.test": []}
    assert sorted(p.name.split("-")[0] for p in calls.iterdir()) == ["map", "map", "rank", "rank"]
