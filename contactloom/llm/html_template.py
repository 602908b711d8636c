"""Main text of HTML pages: site templates go by subtree counts, the rest of the frame by its markup.

A page becomes a list of elements and text blocks.  Every element's subtree has two hashes: of its content
(tag, text, children) and of its shape (tag, class, id, children, each run of alike ones as one, no text).
Spark counts by host on how many different pages each stands, and content outside the main part by section
of a host too.  First the counts decide: content that recurs on many pages goes, and so do containers outside the main
part whose shape stands once on each of many pages and holds little of the host's text.  Then elements go that
HTML or their names mark as menus, headers, footers, sidebars, notices, adverts, forms or reader comments.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .scratch import write_table

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names of HTML by their part in a page.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select", "video", "audio", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
FRAME = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "label", "fieldset", "input"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "adslot", "adbox", "adunit", "sponsor", "sponsored", "sponsors", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr",
    "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "paywall", "sidebar", "aside", "widget", "widgets", "related", "recommended",
    "recommendations", "share", "sharing", "social", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "nav", "navbar", "navigation", "menu", "submenu", "breadcrumb", "breadcrumbs",
    "footer", "masthead", "topbar", "toolbar", "pagination", "pager", "login", "search", "searchbox", "skip", "disclaimer", "copyright",
}
COMMENTS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond"}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"address", "aside", "center", "details", "dialog", "div", "dl", "fieldset", "footer", "form", "header", "menu", "nav", "ol", "section", "table", "ul"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}


class Page:
    """Elements (parent, tag, dropped, main) and blocks (element, text, characters in links) of one page."""

    def __init__(self, source: str) -> None:
        self.parent, self.tag, self.dropped, self.main, self.mark = [-1], ["#root"], [False], [False], [""]
        self.blocks: list[tuple[int, str, int]] = []
        self.content: list[list[str | int]] = [[]]  # text and child elements in order
        self.title = ""
        self._open, self._text, self._linked, self._links = [0], [], 0, 0
        self._owners, self._times = [0], {"#root": 1}  # open blocks, and how often each tag is open
        # After the last ">" no tag ends, so only a comment can begin there.
        at, end, last = 0, len(source), source.rfind(">")
        while at < end:
            if at > last:
                comment = source.find("<!--", at)
                self._add(source[at : comment if comment >= 0 else end])
                break
            m = MARKUP.search(source, at)
            if m is None:
                self._add(source[at:])
                break
            self._add(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:
                self._close(name)
            elif name in RAW:
                if m[3].endswith("/"):
                    continue
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                if name == "title" and not self.title:
                    self.title = " ".join(html.unescape(source[at : close.start() if close else end]).split())
                at = close.end() if close else end
            else:
                self._start(name, m[3])
        self._flush()

    def _add(self, text: str) -> None:
        if text:
            self._text.append(text)
            if self._links:
                self._linked += len(text)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                owner = self._owners[-1]
                self.blocks.append((owner, text, self._linked))
                self.content[owner].append(text)
            self._text, self._linked = [], 0

    def _start(self, name: str, attributes: str) -> None:
        if name in ("br", "hr"):
            self._text.append(" ")
        if name in VOID:
            if name == "hr":
                self._flush()
            return
        if name in BLOCK:
            self._flush()
            if self._times.get("p"):
                self._pop("p", {"table", "td", "th", "li", "div", "section", "article", "blockquote"} - {name})
        for shut in CLOSES.get(name, ()):
            self._pop(shut, STOPS.get(name, set()))
        above = self._open[-1]
        main = name in MAIN
        dropped = self.dropped[above] or name in FRAME or name == "header" and not self.main[above]
        mark = ""
        if "class" in attributes or "id" in attributes or attributes and not dropped:
            found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
            mark = f"{found.get('class', '')}#{found.get('id', '')}"
            main = main or found.get("role", "").lower() == "main"
            # A heading's or paragraph's id is an anchor; inside the main part words of authors only mark reader comments.
            named = found.get("class", "") if name in HEADINGS or name == "p" else f"{found.get('class', '')} {found.get('id', '')}"
            words = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", named).lower()))
            marks = bool(words & NAMES) and name not in ("html", "body", "main") if not self.main[above] and name not in MAIN else bool(words & COMMENTS) and name in CONTAINERS
            dropped = dropped or marks or found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        self.parent.append(above)
        self.tag.append(name)
        self.dropped.append(dropped)
        self.mark.append(mark)
        self.main.append(self.main[above] or main)
        self.content.append([])
        self.content[above].append(len(self.tag) - 1)
        self._open.append(len(self.tag) - 1)
        self._times[name] = self._times.get(name, 0) + 1
        if name in BLOCK:
            self._owners.append(len(self.tag) - 1)
        self._links += name == "a"

    def _close(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        self._pop(name, set())

    def _pop(self, name: str, stops: set[str]) -> None:
        """Close the innermost ``name`` and all in it, unless one of ``stops`` stands between; nothing is walked where none is open."""
        if not self._times.get(name):
            return
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag == name:
                if self._owners[-1] >= self._open[k]:
                    self._flush()
                for e in self._open[k:]:
                    self._times[self.tag[e]] -= 1
                    self._links -= self.tag[e] == "a"
                while self._owners[-1] >= self._open[k]:
                    self._owners.pop()
                del self._open[k:]
                return
            if tag in stops:
                return

    def hashes(self) -> list[int]:
        """Of every element's subtree, as signed 64-bit numbers; 0 for one without text."""
        found = [0] * len(self.tag)
        for e in range(len(self.tag) - 1, 0, -1):  # children come after their parents
            parts = [c if isinstance(c, str) else str(found[c]) for c in self.content[e] if isinstance(c, str) or found[c]]
            if parts:
                h = xxhash.xxh64_intdigest("\x00".join([self.tag[e], *parts]).encode("utf-8", "surrogatepass"))
                found[e] = h - (1 << 64) if h >> 63 else h
        return found

    def shapes(self) -> dict[int, tuple[int, int, int, int]]:
        """Shape hash, characters, and characters in links of each container outside the main part that holds text but no heading; the last is how often the shape stands on the page."""
        n = len(self.tag)
        chars, linked, heading = [0] * n, [0] * n, [t in HEADINGS for t in self.tag]
        for e, t, of_links in self.blocks:
            chars[e] += len(t)
            linked[e] += min(of_links, len(t))
        shape = [""] * n
        for e in range(n - 1, 0, -1):  # children come after their parents
            below = [shape[c] for c in self.content[e] if not isinstance(c, str)]
            alone = [x for i, x in enumerate(below) if i == 0 or x != below[i - 1]]
            shape[e] = xxhash.xxh64_hexdigest("\x00".join([self.tag[e], self.mark[e], *alone]).encode("utf-8", "surrogatepass"))
            up = self.parent[e]
            chars[up] += chars[e]
            linked[up] += linked[e]
            heading[up] = heading[up] or heading[e]
        held = [e for e in range(1, n) if self.tag[e] in CONTAINERS and chars[e] and not heading[e] and not self.main[e]]
        times: dict[str, int] = {}
        for e in held:
            times[shape[e]] = times.get(shape[e], 0) + 1
        signed = lambda x: int(x, 16) - (1 << 64 if x >= "8" else 0)
        return {e: (signed(shape[e]), chars[e], linked[e], times[shape[e]]) for e in held}

    def by_templates(self, templates: frozenset[int], outside: frozenset[int] = frozenset(), shapes: frozenset[int] = frozenset()) -> list[bool]:
        """Elements that the counts delete.

        Content in ``templates`` goes anywhere, that in ``outside`` only outside article and main; a container of one
        of ``shapes`` goes where the page has an article or main, or where half of its text are links.
        """
        gone = [False] * len(self.tag)
        if templates or outside:
            for e, h in enumerate(self.hashes()):
                gone[e] = (h in templates or h in outside and not self.main[e]) and self.tag[e] not in ("html", "body", *MAIN)
        if shapes:
            has_main = any(self.main[e] for e, *_ in self.blocks)
            for e, (h, chars, linked, _) in self.shapes().items():
                gone[e] = gone[e] or h in shapes and (has_main or 2 * linked >= chars)
        return gone

    def text(self, templates: frozenset[int], outside: frozenset[int] = frozenset(), shapes: frozenset[int] = frozenset(), marked: bool = True) -> str:
        """Blocks that stay, joined by two line feeds.

        First the templates go; then, if ``marked``, what tags, names and roles mark, and what stands outside
        article and main where the page has text there.
        """
        gone = self.by_templates(templates, outside, shapes)
        if marked:
            gone = [g or d for g, d in zip(gone, self.dropped)]
        header = [0] * len(gone)  # 1: in an article's header, of which all but headings goes; 2: in a heading there
        for e in range(1, len(gone)):
            up = self.parent[e]
            gone[e] = gone[e] or gone[up]
            header[e] = 1 if self.tag[e] == "header" else 2 if header[up] and self.tag[e] in HEADINGS else header[up]
        stay = [(e, t, n) for e, t, n in self.blocks if not gone[e] and not (marked and header[e] == 1)]
        inside = [(e, t) for e, t, _ in stay if self.main[e] and marked]
        if any(self.tag[e] not in HEADINGS for e, _ in inside):
            return "\n\n".join(t for _, t in inside)
        # Without a main part, or with one that holds headings only: lines of links go, sentences stay.
        return "\n\n".join(t for _, t, linked in stay if linked < 0.7 * len(t) or len(t) >= 40 and t.rstrip("\"'”’»)")[-1:] in (".", "!", "?"))


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
FOLDER = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+/)"


def scopes(url: Column) -> tuple[Column, Column]:
    """A URL's host, and its section: the host with the first folder of the path."""
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return host, F.concat(host, F.coalesce(F.nullif(F.regexp_extract(url, FOLDER, 1), F.lit("")), F.lit("/")))


SUBTREES = "host string, section string, page long, chars long, subtrees array<long>, outside array<long>, shapes array<struct<shape:long,chars:long>>"
_ARROW = pa.schema([("host", pa.string()), ("section", pa.string()), ("page", pa.int64()), ("chars", pa.int64()), ("subtrees", pa.list_(pa.int64())), ("outside", pa.list_(pa.int64())), ("shapes", pa.list_(pa.struct([("shape", pa.int64()), ("chars", pa.int64())])))])


def page_subtrees(source: str) -> tuple[int, int, list[int], list[int], list[dict]]:
    """What a page adds to the counts: its own mark, its characters, content hashes, those outside the main part, and shapes that stand once.

    Pages differ by the blocks of their article or main, or where they have none, by all blocks that their
    markup doesn't drop; so copies of an article count once, and pages of one title each count.
    """
    page = Page(source)
    stay = [(e, t) for e, t, _ in page.blocks if not page.dropped[e]]
    own = "\n".join([t for e, t in stay if page.main[e]] or [t for _, t in stay])
    mark = xxhash.xxh64_intdigest(own.encode("utf-8", "surrogatepass")) >> 1
    kept = [(h, page.main[e]) for e, h in enumerate(page.hashes()) if h and page.tag[e] not in ("html", "body", *MAIN)]
    shapes = [{"shape": h, "chars": chars} for h, chars, _, times in page.shapes().values() if times == 1]
    return mark, sum(len(t) for _, t, _ in page.blocks), sorted({h for h, _ in kept}), sorted({h for h, main in kept if not main}), shapes


def site_templates(pages: DataFrame, url_col: str, html_col: str, min_pages: int, share: float, frame_share: float) -> DataFrame:
    """(scope, templates array<long>, shapes array<long>): what stands on ``min_pages`` different pages and on ``share`` of all different pages of a host or a section.

    A section's content is only counted outside article and main: a line that a few of its articles share is
    text.  Shapes are a host's, and those that hold over ``frame_share`` of the text of their pages are none.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = zip(*[page_subtrees(source or "") for source in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, f.type) for c, f in zip(found, list(_ARROW)[2:])]], schema=_ARROW)

    host, section = scopes(F.col(url_col))
    seen = write_table(spread(pages.select(host.alias("host"), section.alias("section"), html_col)).mapInArrow(rows, SUBTREES), "subtrees")

    def frequent(scope: str, subtrees: str) -> DataFrame:
        own = seen.select(F.col(scope).alias("scope"), "page", F.col(subtrees).alias("subtrees"))
        counts = own.select("scope", "page", F.explode("subtrees").alias("subtree")).distinct().groupBy("scope", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
        return counts.join(totals(own), "scope").where(F.col("n") >= share * F.col("pages")).select("scope", "subtree")

    def totals(own: DataFrame) -> DataFrame:
        return own.select("scope", "page").distinct().groupBy("scope").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)

    # At most the mean number of a page's subtrees over ``share`` pass for a host or a section, so the lists are bounded.
    by_host = write_table(frequent("host", "subtrees"), "host-templates")
    by_section = frequent("section", "outside").withColumn("host", F.substring_index("scope", "/", 1)).join(by_host.withColumnRenamed("scope", "host"), ["host", "subtree"], "left_anti")
    own = seen.select(F.col("host").alias("scope"), "page", "chars", "shapes")
    held = own.select("scope", "page", F.col("chars").alias("whole"), F.explode("shapes").alias("s")).groupBy("scope", "page", "s.shape").agg(F.max("s.chars").alias("chars"), F.max("whole").alias("whole"))
    counts = held.groupBy("scope", "shape").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("whole").alias("whole")).where(F.col("n") >= min_pages).where(F.col("chars") <= frame_share * F.col("whole"))
    by_shape = counts.join(totals(own), "scope").where(F.col("n") >= share * F.col("pages")).select("scope", "shape")
    none = F.lit(None).cast("long")
    found = by_host.unionByName(by_section.drop("host")).select("scope", "subtree", none.alias("shape")).unionByName(by_shape.select("scope", none.alias("subtree"), "shape"))
    return write_table(found.groupBy("scope").agg(F.collect_list("subtree").alias("templates"), F.collect_list("shape").alias("shapes")), "templates")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 5, share: float = 0.3, frame_share: float = 0.25) -> DataFrame:
    """(page_id, url, text) for every row: blocks in page order joined by two line feeds, white space in them as one space.

    A null or empty page, or one without main text, gives an empty text; a null URL belongs to no
    host but to one group of its own; repeated rows get a row each; an empty table gives an empty
    result; other columns are ignored.  ``<br>`` is white space.
    """
    templates = site_templates(pages, url_col, html_col, min_pages, share, frame_share)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [Page(s or "").text(*(frozenset(x or ()) for x in lists)) for s, *lists in zip(*[c.to_pylist() for c in b.columns[2:6]])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    host, section = scopes(F.col(url_col))
    keyed = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"), section.alias("section"))
    of_host = templates.where(~F.col("scope").contains("/")).select(F.col("scope").alias("host"), F.col("templates").alias("of_host"), "shapes")
    of_section = templates.where(F.col("scope").contains("/")).select(F.col("scope").alias("section"), F.col("templates").alias("of_section"))
    keyed = spread(keyed)
    # Spark broadcasts the written templates if their size allows it, and else splits a large host.
    return keyed.join(of_host, "host", "left").join(of_section, "section", "left").select("page_id", "url", "html", "of_host", "of_section", "shapes").mapInArrow(rows, "page_id long, url string, text string")
