import brute_text
from pyspark.sql import functions as F

from contactloom.functions import addresses, markup, provenance, urls
from contactloom.plans import page_queries


def one(spark, expr, value, *more):
    return spark.createDataFrame([(value, *more)], ", ".join(f"c{i} string" for i in range(1 + len(more)))).select(expr(*[F.col(f"c{i}") for i in range(1 + len(more))]).alias("x")).first()[0]


def test_entities_decode_in_turn(spark):
    assert one(spark, markup.decode_entities, "a&nbsp;b &amp;lt; &quot;q&quot; &#39;&apos; &lt;&gt; &#233;&#8364;&#128512; &copy; &#x41;") == "a b < \"q\" '' <> é€\U0001f600 &copy; &#x41;"


def test_html_to_text(spark):
    assert one(spark, markup.html_to_text, "<style>x</style><div>A <b>bold</b>   word</div><p>two<br>lines</p><!-- no --><script>1</script>\n\n\nend ") == "A bold word\ntwo\nlines\nend"


def test_links(spark):
    page = '<a href="/team/">Team</a><a class=x href=\'about#top\'>no</a><a href="about/us?x=1"> <b>About</b> us</a><a href="https://sub.a.example.com/x">Sub</a><a href="https://other.example.org/">Other</a><a href="/team">again</a><a href="/f.PDF">file</a><a href="mailto:x@y.example">m</a><a href="../up">up</a>'
    found = one(spark, markup.extract_links, page, "https://www.a.example.com/d/e/page.html")
    assert [(x.url, x.text) for x in found] == [("https://www.a.example.com/team/", "Team"), ("https://www.a.example.com/d/e/about/us?x=1", "About us"), ("https://sub.a.example.com/x", "Sub"), ("https://www.a.example.com/d/up", "up")]


def test_hidden_addresses(spark):
    assert one(spark, addresses.encode_hidden, "ann@example.net") == brute_text.hide("ann@example.net", 0x6B)
    assert one(spark, addresses.decode_hidden, brute_text.hide("ann@example.net", 0x2A)) == "ann@example.net"
    assert one(spark, addresses.decode_hidden, "abc") is None and one(spark, addresses.decode_hidden, brute_text.hide("no address", 1)) is None


def test_extract_addresses(spark):
    page = f'<a href="mailto:Info@Clinic.example.net?subject=x">x</a> and bob@clinic.example.net <i data-cfemail="{brute_text.hide("hid@clinic.example.net", 7)}"></i> logo@2x.png user@site.example.net you@example.com 0123456789abcdef01@t.example.net INFO@clinic.example.net'
    assert one(spark, addresses.extract_addresses, page) == ["info@clinic.example.net", "bob@clinic.example.net", "hid@clinic.example.net"]


def test_classify_keeps_the_dot_boundary(spark):
    emails = F.array(*map(F.lit, ("ann@clinic.test.au", "info@clinic.test.au", "x@notclinic.test.au", "reception@gmail.com", "joe@gmail.com", "a@sub.clinic.test.au", "noreply@sentry.io")))
    strict = spark.range(1).select(addresses.classify(emails, F.lit("clinic.test.au")).alias("c")).first()[0]
    assert strict.business == ["info@clinic.test.au", "ann@clinic.test.au", "a@sub.clinic.test.au"] and strict.other == ["reception@gmail.com"]
    loose = spark.range(1).select(addresses.classify(emails, F.lit("clinic.test.au"), dot_boundary=False).alias("c")).first()[0]
    assert "x@notclinic.test.au" in loose.business


def test_tiers_by_brand(spark):
    tier = lambda e, s: spark.range(1).select(addresses.tier(F.array(F.lit(e)), F.lit(s)).alias("t")).first()[0]
    assert tier("a@brandlong.net", "brandlong.com").own == ["a@brandlong.net"] and tier("a@abcd.net", "abc.com").related == ["a@abcd.net"]


def test_redaction(spark):
    text = "key sk-abcDEF123 at https://api.example.com/v1/abcdefghijklmnop1234/x failed 401; GSK plc, user-skill"
    assert one(spark, provenance.redact, text) == "key <redacted> at https://api.example.com/v1/<redacted>/x failed 401; GSK plc, user-skill"
    assert one(spark, lambda v: provenance.status_of(F.lit(None), v), text) == 401
    assert one(spark, lambda v: provenance.brief(v, 12), "a \n\t b  c " * 9) == "a b c a b c "[:12]


def test_chunks_against_brute_force(spark):
    texts = ["short", "line one\nline two\n" * 40, "a,b,c\n" + "1,2,3\n" * 300, "x" * 5000, "", "one\n" + "y" * 500 + "\nend\n" * 50]
    for t in texts:
        assert one(spark, lambda v: markup.chunks(v, 200), t) == brute_text.chunks(t, 200)
    assert one(spark, markup.chunks, None) is None


def test_chunk_query_keeps_the_whole_of_long_texts(spark, tmp_path):
    texts = ["\n".join(f"line {i} " + "x" * (i % 90) for i in range(3000)), "a,b,c\n" + "\n".join(f"{i},2,3" for i in range(20_000))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for i, text in enumerate(texts):
        got = [r.text for r in page_queries.chunk_text(spark, str(tmp_path)).where(f"doc_id = {i}").orderBy("chunk").collect()]
        assert len(got) > 24
        header = "a,b,c\n" if i else ""
        assert header + "\n".join(c.removeprefix(header) for c in got) == text


def test_load_more_and_data_urls(spark):
    page = '<button class="btn load-btn" id="more">Load <b>more</b></button><a class="x1">View all</a><div>show me</div><span>see more</span><script src="/app.js?v=1"></script><script src="https://cdn.example.org/x.js"></script> "/data/team.json" `/api/people`'
    assert [(c.selector, c.text) for c in one(spark, markup.load_more, page)] == [("#more", "Load more"), ("a.x1", "View all")]
    assert one(spark, markup.data_urls, page, "https://www.a.example.com/p") == ["https://www.a.example.com/app.js?v=1", "https://www.a.example.com/data/team.json", "https://www.a.example.com/api/people"]


def test_websites_and_domains(spark):
    site = lambda v: one(spark, urls.normalize_website, v)
    assert tuple(site(" WWW.Example.com/Team ")) == ("example.com", "https://www.example.com/Team", "https://www.example.com/")
    assert site("localhost") is None and site("") is None and site(None) is None and site("https://a b.example.com") is None
    domain = lambda v: one(spark, urls.normalize_domain, v)
    assert [domain(v) for v in ("HTTPS://www2.Example.com:8080/x?y#z", "example.com.", "nothing", None)] == ["example.com", "example.com", None, None]
    assert [one(spark, urls.normalize_prefix, v) for v in ("Team", "/team/", "https://a.example.com/Doctors/x", "/", "")] == ["/team/", "/team/", "/doctors/x/", "", ""]
