import html
import re
from collections import Counter, defaultdict

import pytest

from contactloom.llm import html_template, queries

FRAME = """<html><head><title>{t}</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><header>Site name</header>
<div class="cookie-banner">We use cookies</div><div><p>House style line of this site</p></div>
<article><h1>{t}</h1><p>{a}</p><p>{b}</p></article>
<section id="comments"><p>First!</p></section><form><input name="q">Search</form><footer>Imprint</footer></body></html>"""


def pages(spark):
    rows = [(i, f"https://WWW.a.example.com/{i}", FRAME.format(t=f"Title {i}", a=f"Body &amp; text {i}\n  goes &lt;on&gt;", b=f"More &#233; of {i}")) for i in range(12)]
    rows += [(100, "https://b.example.com/", "<p>only this</p>"), (101, None, "<div>null url</div>"), (102, "https://b.example.com/2", None), (103, "https://b.example.com/3", ""), (103, "https://b.example.com/3", "")]
    rows += [(200 + i, f"https://c.example.com/{i}", f"<body><div><span>Plain frame without names</span></div><div><h2>Story {i}</h2><p>Tale {i} is long</p></div><div><b>End note of all pages</b></div></body>") for i in range(8)]
    rows += [(300, "https://d.example.com/", "<p>Unclosed <b>tags<p>Next & more &unknown; <br>line</p><div>x < y and 3 > 2")]
    return spark.createDataFrame([(*r, "keep") for r in rows], "page_id long, url string, html string, text string").repartition(4)


def test_main_text(spark):
    found = {}
    for r in html_template.extract_main_text(pages(spark)).collect():
        found.setdefault(r.page_id, []).append(r.text)
    assert found[3] == ["Title 3\n\nBody & text 3 goes <on>\n\nMore é of 3"]
    assert found[100] == ["only this"] and found[101] == ["null url"] and found[102] == [""] and found[103] == ["", ""]
    assert found[205] == ["Story 5\n\nTale 5 is long"]  # what recurs on the host goes without any name that marks it
    assert found[300] == ["Unclosed tags\n\nNext & more &unknown; line\n\nx < y and 3 > 2"]


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, f"https://e.example.com/{i}", "<body><h1>Same story</h1><p>The very same paragraph</p></body>") for i in range(30)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html_template.extract_main_text(docs).collect()} == {"Same story\n\nThe very same paragraph"}


def test_empty_table_and_query_columns(spark):
    assert html_template.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    folder = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op6_main_text"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/pages.parquet").count()
    for r in rows:
        assert r.n_chars == len(r.text) and r.text == r.text.strip() and "</" not in r.text


def test_pages_of_one_title_have_templates(spark):
    rows = [(i, f"https://f.example.com/{i}", f"<title>My site</title><body><div><span>Plain frame line</span></div><p>Own words of {i}</p></body>") for i in range(12)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r.text for r in html_template.extract_main_text(docs).collect()) == sorted(f"Own words of {i}" for i in range(12))


def test_a_section_has_its_own_templates(spark):
    rows = [(i, f"https://g.example.com/{'news' if i < 10 else 'blog'}/{i}", f"<title>T{i}</title><body>{'<div><span>Line of the news</span></div>' if i < 10 else ''}<p>Own words of {i}</p></body>") for i in range(60)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r.text for r in html_template.extract_main_text(docs).collect()) == sorted(f"Own words of {i}" for i in range(60))


def test_a_line_of_a_sections_articles_is_text(spark):
    rows = [(i, f"https://h.example.com/{'news' if i < 10 else 'blog'}/{i}", f"<body><article><p>Own words of {i}</p>{'<p>A line of some articles</p>' if i < 6 else ''}</article></body>") for i in range(60)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sum("A line of some articles" in r.text for r in html_template.extract_main_text(docs).collect()) == 6


def plain_article(source):
    """The text of a page's article by regexes alone, for pages as the driver writes them."""
    own = re.search(r"(?s)<article>(.*?)</article>", source or "")
    blocks = re.split(r"</?(?:p|h1)(?:\s[^>]*)?>", own[1]) if own else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", b))).split()) for b in blocks]
    return "\n\n".join(filter(None, blocks))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_is_brute_force(spark, folder):
    want = {r.page_id: plain_article(r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert {r.page_id: r.text for r in queries.QUERIES["op6_main_text"](spark, folder).collect()} == want


def counted(rows, min_pages=5, share=0.3, frame_share=0.25):
    """Templates and shapes by host in plain Python."""
    hosts = defaultdict(list)
    for r in rows:
        hosts[re.match(html_template.HOST, r.url)[1].lower()].append(html_template.page_subtrees(r.html or ""))
    out = {}
    for host, pages in hosts.items():
        by_mark = {}
        for mark, chars, content, _, shapes in pages:
            seen = by_mark.setdefault(mark, (set(), {}))
            seen[0].update(content)
            for s in shapes:
                before = seen[1].get(s["shape"], (0, 0))
                seen[1][s["shape"]] = (max(before[0], s["chars"]), max(before[1], chars))
        n, content, shapes = Counter(), Counter(), defaultdict(lambda: [0, 0, 0])
        for c, s in by_mark.values():
            content.update(c)
            for h, (chars, whole) in s.items():
                for i, x in enumerate((1, chars, whole)):
                    shapes[h][i] += x
        enough = max(min_pages, share * len(by_mark))
        found = {h for h, k in content.items() if k >= enough}, {h for h, (k, chars, whole) in shapes.items() if k >= enough and chars <= frame_share * whole}
        if any(found):
            out[host] = found
    return out


def test_templates_are_those_counted_in_plain_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = counted(pages.collect())
    found = {r.scope: (set(r.templates), set(r.shapes)) for r in html_template.site_templates(pages, "url", "html", 5, 0.3, 0.25).where("scope not like '%/%'").collect()}
    assert found == want and len(want) > 40 and all(shapes for _, shapes in want.values())


def test_counts_alone_remove_the_frame(spark, monkeypatch):
    """With no tag, name, role or article to go by, hosts with templates lose menu, advert and footer."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    templates = counted(pages)
    right = whole = removed = frame = 0
    for r in pages:
        host = re.match(html_template.HOST, r.url)[1].lower()
        if host in templates:
            page = html_template.Page(r.html)
            content, shapes = (frozenset(x) for x in templates[host])
            right += page.text(content, frozenset(), shapes, marked=False) == plain_article(r.html)
            whole += 1
            gone = page.by_templates(content, frozenset(), shapes)
            for e in range(1, len(gone)):
                gone[e] = gone[e] or gone[page.parent[e]]
            outside = [e for e, *_ in page.blocks if not page.main[e]]
            frame, removed = frame + len(outside), removed + sum(gone[e] for e in outside)
    assert whole > 2000 and right > 0.95 * whole and removed > 0.98 * frame, (right, whole, removed, frame)


def test_shapes_without_a_main_part(spark):
    """Menus of links go by shape; a container of text that stands once on each page stays."""
    page = lambda i: f"<body><div class='m'>{''.join(f'<a href=x>Link {i}-{k}</a> ' for k in range(3 + i % 3))}</div><div class='story'><p>Own words of {i} that go on for a while</p></div><div class='by'>By writer {i}</div></body>"
    docs = spark.createDataFrame([(i, f"https://k.example.com/{i}", page(i)) for i in range(20)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_template.extract_main_text(docs).collect()} == {i: f"Own words of {i} that go on for a while\n\nBy writer {i}" for i in range(20)}


def test_names_are_not_needed_on_driver_pages(spark, monkeypatch):
    for name in ("NAMES", "FRAME", "ROLES"):
        monkeypatch.setattr(html_template, name, set())
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    templates = counted(pages.collect())
    for r in pages.collect():
        content, shapes = (frozenset(x) for x in templates.get(re.match(html_template.HOST, r.url)[1].lower(), ((), ())))
        assert html_template.Page(r.html).text(content, frozenset(), shapes) == plain_article(r.html)


PAPER = """<body><nav><a href="/">Home</a></nav><main><article><h1>Title</h1><p>First paragraph.</p><h2 id="related-work">Related work</h2><p>What others did.</p><section id="search"><h3 id="search">Search</h3><p>How we search.</p></section>
<p class="notice">Important result.</p><div class="menu"><p>The menu of the day.</p></div><p id="footer-note">A note.</p><aside>Aside</aside><div id="comments"><p>Great post!</p></div></article></main><footer>Imprint</footer></body>"""


def test_words_in_ids_and_classes_drop_no_article_text():
    text = html_template.Page(PAPER).text(frozenset())
    assert text.split("\n\n") == ["Title", "First paragraph.", "Related work", "What others did.", "Search", "How we search.", "Important result.", "The menu of the day.", "A note."]
    sentence = '<body><p><a href="/x">A whole sentence that is a link from its begin to its end.</a></p><p>Text.</p><ul><li><a href="/a">Short link</a></li></ul></body>'
    assert html_template.Page(sentence).text(frozenset()) == "A whole sentence that is a link from its begin to its end.\n\nText."
    outside = "<body><main><h1>Only a heading</h1></main><div><p>The text stands outside of it.</p></div></body>"
    assert html_template.Page(outside).text(frozenset()) == "Only a heading\n\nThe text stands outside of it."


def test_bad_pages_take_time_in_proportion():
    """Five megabytes of each: unclosed elements, stray ends, tags without an end, lines between inline elements, self-closing drawings."""
    import time

    bad = ["<div>", "<div></b>", "<div></p>x", "<a ", "<b>x<hr>", "<li>x", "<svg/>x", "<!", "<!--", "<p><b>", '<a href="', "<table><td>x", "<dd>x<dt>y", "<header><div>x", "<article><div>x"]
    for piece in bad:
        source = "<body><p>Begin.</p>" + piece * ((5 << 20) // len(piece) // (1 if piece in ("<div>", "<a ") else 10))
        began = time.process_time()
        assert html_template.Page(source).text(frozenset()).startswith("Begin.") or piece in ("<article><div>x", "<header><div>x")
        assert time.process_time() - began < 25, (piece, time.process_time() - began)
