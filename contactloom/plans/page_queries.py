"""Queries over pages and texts: URLs, links, markup, addresses, redaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses, markup, provenance, urls
from ..operators import crawl, inboxes, ledger
from .registry import query, table

HOST = r"lower(regexp_extract(url, '^https?://([^/?#:]+)', 1))"
KEY = rf"regexp_replace({HOST}, '^www\.', '')"
PATH = r"CASE WHEN regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) END"
QUERY = r"regexp_extract(url, '(\?[^#]*)', 1)"
SCHEME = r"regexp_extract(url, '^(https?)://', 1)"
ASSETS = r"'\.(css|js|json|xml|pdf|jpe?g|png|gif|webp|svg|ico|woff2?|zip|mp4)$'"


def _text_sql(source: str) -> str:
    for p in ("(?is)<script.*?</script>", "(?is)<style.*?</style>", "(?is)<noscript.*?</noscript>", "(?s)<!--.*?-->"):
        source = f"regexp_replace({source}, '{p}', ' ', 'g')"
    source = f"regexp_replace({source}, '(?i)<(br|hr)[^>]*>|</(p|div|li|tr|h[1-6]|section|article|header|footer)>', chr(10), 'g')"
    return f"regexp_replace({source}, '<[^>]+>', ' ', 'g')"


def _decoded_sql(text: str) -> str:
    for name, to in (("nbsp", "' '"), ("amp", "'&'"), ("quot", "'\"'"), ("#0?39", "chr(39)"), ("apos", "chr(39)"), ("lt", "'<'"), ("gt", "'>'")):
        text = f"regexp_replace({text}, '(?i)&{name};', {to}, 'g')"
    return text


def _squeezed_sql(text: str) -> str:
    text = f"regexp_replace(regexp_replace({text}, '[ \\t]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({text}, '\\n{{2,}}', chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"


@query(f"""SELECT page_id, {KEY} AS key, {SCHEME} || '://' || {HOST} || '/' AS origin,
       {SCHEME} || '://' || {HOST} || {PATH} || {QUERY} || regexp_extract(url, '(#.*)$', 1) AS original FROM pages""")
def normalize_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site key, origin and whole address of every page's URL."""
    site = urls.normalize_website(F.col("url"))
    return table(spark, sf_dir, "pages", "page_id", "url").select("page_id", site.alias("s")).select("page_id", "s.key", "s.origin", "s.original")


@query(f"""SELECT {KEY} AS key, arg_min(url, page_id) AS company, min(page_id) AS pos FROM pages GROUP BY 1""")
def distinct_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of each site, as the targets of a crawl."""
    return crawl.targets(table(spark, sf_dir, "pages", "page_id", "url"), "url", "name", "page_id").select("key", "company", "pos")


_ANCHOR = r"(?is)<a\b[^>]*href=[\"'']([^\"''#]+)[\"''][^>]*>(.*?)</a>"
LINKS_SQL = rf"""hrefs AS (
    SELECT page_id, {KEY} AS site, {SCHEME} || '://' || {HOST} AS root, unnest(regexp_extract_all(html, '{_ANCHOR}', 1)) AS href, unnest(regexp_extract_all(html, '{_ANCHOR}', 2)) AS body,
           generate_subscripts(regexp_extract_all(html, '{_ANCHOR}', 1), 1) AS pos FROM pages),
urls AS (SELECT page_id, site, pos, body, CASE WHEN href LIKE 'http%' THEN href ELSE root || href END AS url FROM hrefs WHERE href LIKE '/%' OR href LIKE 'http%'),
seen AS (SELECT page_id, site, pos, url, body, {KEY} AS host, {PATH} AS path, {QUERY} AS q FROM urls),
inside AS (SELECT * FROM seen WHERE (host = site OR ends_with(host, '.' || site)) AND NOT regexp_matches(lower(path), {ASSETS})),
firsts AS (SELECT page_id, arg_min(site, pos) AS site, min(pos) AS pos, arg_min(url, pos) AS url, arg_min(body, pos) AS body FROM inside GROUP BY page_id, host, CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(path, '/') END, q)"""


def _links(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    found = markup.extract_links(F.col("html"), F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", urls.site_key(F.col("url")).alias("site"), urls.origin(F.col("url")).alias("origin"), *more, F.posexplode(found).alias("_at", "_l"))


@query(f"""WITH {LINKS_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM firsts)
SELECT page_id, CAST(rank AS INTEGER) AS rank, url, trim(regexp_replace({_decoded_sql("regexp_replace(body, '<[^>]+>', ' ', 'g')")}, '\\s+', ' ', 'g'))[1:80] AS text FROM ranked WHERE rank <= 150""")
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every page to its own site, the first of each address, at most 150."""
    return _links(spark, sf_dir).select("page_id", (F.col("_at") + 1).alias("rank"), "_l.url", "_l.text")


_CAP = 500  # the operator's own
CANDIDATES_SQL = f"""{LINKS_SQL}, sites AS (SELECT {KEY} AS key, arg_min({SCHEME} || '://' || {HOST} || {PATH} || {QUERY}, page_id) AS own FROM pages GROUP BY 1),
pooled AS (SELECT key, own AS url, -1 AS pos FROM sites UNION ALL SELECT site, url, page_id * 1000 + pos FROM (SELECT site, url, page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS pos FROM firsts) WHERE pos < 150),
parts AS (SELECT key, url, pos, {KEY} AS host, {PATH} AS path, {QUERY} AS q FROM pooled),
usable AS (SELECT * FROM parts WHERE NOT regexp_matches(lower(path), '(^|/)(sitemap([_-][^/]*)?\\.xml(\\.gz)?|robots\\.txt)$|\\.(css|js|mjs|map|json|xml|pdf|jpe?g|png|gif|webp|svg|ico|woff2?|ttf|eot|zip|gz|mp[34]|webm|avi|mov)$')),
each AS (SELECT key, min(pos) AS pos, arg_min(url, pos) AS url FROM usable GROUP BY key, host, CASE WHEN rtrim(path, '/') = '' THEN '/' ELSE rtrim(path, '/') END, q),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos, url) AS entry FROM each)"""


def _site_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sites = crawl.targets(table(spark, sf_dir, "pages", "page_id", "url"), "url", "name", "page_id")
    sites = sites.select("key", urls.without_fragment(F.col("original")).alias("original"))
    links = _links(spark, sf_dir).select(F.col("site").alias("key"), "_l.url", F.col("_l.text").alias("title"), (F.col("page_id") * 1000 + F.col("_at")).alias("pos"))
    return sites, links


@query(f"WITH {CANDIDATES_SQL} SELECT key, CAST(entry AS INTEGER) AS entry, url FROM numbered WHERE entry <= {_CAP}")
def filter_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pages of each site to rank: its own address, then its links without files and repeats."""
    return crawl.candidate_links(*_site_links(spark, sf_dir)).select("key", "entry", "url")


@query(f"WITH {CANDIDATES_SQL} SELECT key, least(count(*), {_CAP}) AS n_entries, greatest(count(*) - {_CAP}, 0) AS n_dropped FROM numbered GROUP BY key")
def candidate_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages of each site the cap keeps and leaves out."""
    return crawl.overflow(*_site_links(spark, sf_dir))


@query(f"""WITH parts AS (SELECT page_id, {KEY} AS key, {PATH} AS path, url FROM pages),
prefixes AS (SELECT DISTINCT key, '/' || lower(split_part(path, '/', 2)) || '/' AS p FROM parts WHERE page_id % 3 = 0 AND split_part(path, '/', 2) <> '')
SELECT DISTINCT page_id, key FROM parts JOIN prefixes USING (key) WHERE starts_with(lower(path), p) AND rtrim(lower(path), '/') <> rtrim(p, '/')""")
def profile_prefix_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages below a prefix of their site; the prefixes are the first folders of every third page."""
    pages = table(spark, sf_dir, "pages", "page_id", "url").withColumn("key", urls.site_key(F.col("url")))
    prefixes = pages.where("page_id % 3 = 0").select("key", F.get(F.split(urls.path_of(F.col("url")), "/"), F.lit(1)).alias("prefix")).distinct()
    return crawl.under_prefixes(pages, prefixes).select("page_id", "key")


@query(f"""WITH {LINKS_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS r FROM firsts),
found AS (SELECT page_id, r, url FROM ranked WHERE r <= 150 AND (regexp_matches(lower(url), 'contact|reach|get-in-touch|enquir') OR regexp_matches(lower(body), 'contact|reach|enquir'))),
guess AS (SELECT page_id, 1000 + g AS r, {SCHEME} || '://' || {HOST} || '/' || ['contact', 'contact-us', 'contactus'][g] AS url FROM pages, range(1, 4) t(g)),
pooled AS (SELECT page_id, url, min(r) AS r FROM (FROM found UNION ALL FROM guess) GROUP BY 1, 2), top AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY r) AS rank FROM pooled)
SELECT page_id, CAST(rank AS INTEGER) AS rank, url FROM top WHERE rank <= 2""")
def contact_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two pages of each site to visit for inboxes: links that look like it, then guesses."""
    found = crawl.contact_pages(markup.extract_links(F.col("html"), F.col("url")), urls.origin(F.col("url")))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(found).alias("_at", "url")).select("page_id", (F.col("_at") + 1).alias("rank"), "url")


@query(f"SELECT page_id, {_squeezed_sql(_decoded_sql(_text_sql('html')))} AS text FROM pages")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return table(spark, sf_dir, "pages").select("page_id", markup.html_to_text(F.col("html")).alias("text"))


@query(f"SELECT page_id, md5({_decoded_sql('html')}) AS decoded_md5 FROM pages")
def decode_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's source with its entities decoded, as a digest."""
    return table(spark, sf_dir, "pages").select("page_id", F.md5(markup.decode_entities(F.col("html")).cast("binary")).alias("decoded_md5"))


_ADDRESS = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
ADDRESSES_SQL = f"""raw AS (
    SELECT 'document' AS kind, doc_id AS id, unnest(regexp_extract_all(text, '{_ADDRESS}')) AS e, generate_subscripts(regexp_extract_all(text, '{_ADDRESS}'), 1) AS pos FROM documents
    UNION ALL SELECT 'page', page_id, unnest(regexp_extract_all(html, '{_ADDRESS}')), generate_subscripts(regexp_extract_all(html, '{_ADDRESS}'), 1) FROM pages),
found AS (SELECT kind, id, lower(e) AS email, min(pos) AS pos FROM raw WHERE NOT regexp_matches(lower(e), '\\.(png|jpe?g|gif|webp|svg|css|js)$|@(example|sentry|schema|w3|domain|yourdomain|email|yourcompany|company|website|test)\\.(com|net|org)|^(your|youremail|name|firstname|lastname|email|username|user)@|^[0-9a-f]{{16,}}@') GROUP BY 1, 2, 3)"""


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("s"))
    pages = table(spark, sf_dir, "pages", "page_id", "html").select(F.lit("page"), "page_id", "html")
    return docs.union(pages).where(F.contains("s", F.lit("@")) | F.contains("s", F.lit("data-cfemail")) | F.contains("s", F.lit("/email-protection#"))).select("kind", "id", addresses.extract_addresses(F.col("s")).alias("emails"))


@query(f"WITH {ADDRESSES_SQL} SELECT kind, id, CAST(row_number() OVER (PARTITION BY kind, id ORDER BY pos) AS INTEGER) AS rank, email FROM found")
def extract_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in texts and pages, in order of their first place."""
    return _found(spark, sf_dir).select("kind", "id", F.posexplode("emails").alias("_at", "email")).select("kind", "id", (F.col("_at") + 1).alias("rank"), "email")


@query(f"""WITH {ADDRESSES_SQL} SELECT kind, id, email, '6b' || array_to_string(list_transform(range(1, length(email) + 1), lambda i: lpad(lower(to_hex(xor(107, ascii(email[i])))), 2, '0')), '') AS hidden, email AS shown FROM found""")
def cf_email_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in their hidden form, and back."""
    hidden = _found(spark, sf_dir).select("kind", "id", F.explode("emails").alias("email")).withColumn("hidden", addresses.encode_hidden(F.col("email")))
    return hidden.withColumn("shown", addresses.decode_hidden(F.col("hidden")))


# The data's hosts hold a vendor word, so both sides read another word in its place.
_SORTED_SQL = f"""WITH {ADDRESSES_SQL}, given AS (
    SELECT id, pos, replace(email, 'example', 'clinic') AS email FROM found WHERE kind = 'document'
    UNION ALL SELECT id, 10000 + g, ['info@' || 'mail' || (id % 9) || '.clinic.com', 'bookings@gmail.com', 'desk@mail' || (id % 9) || 'x.clinic.net', 'user@domain.com'][g] FROM (SELECT DISTINCT id FROM found WHERE kind = 'document'), range(1, 5) t(g)),
firsts AS (SELECT id, email, min(pos) AS pos, 'mail' || (id % 9) || '.clinic.com' AS site, split_part(email, '@', 2) AS host, regexp_matches(email, '^(info|reception\\d*|admin|contact|enquir(y|ies)|office|hello|mail|practice|bookings?|appointments?|referrals?|accounts?|hr|careers?|frontdesk|desk|clinic|rooms|secretary|pa|welcome|team|support|general)@') AS role FROM given GROUP BY 1, 2),
usable AS (SELECT * FROM firsts WHERE email NOT LIKE 'user@%' AND email NOT LIKE '%@domain.com' AND NOT regexp_matches(email, '^(test|name|email|yourname|firstname|your)@'))"""


def _sorted_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = lambda end: F.concat(F.lit("mail"), F.col("id") % 9, F.lit(end))
    more = F.array(F.concat(F.lit("info@"), host(".clinic.com")), F.lit("bookings@gmail.com"), F.concat(F.lit("desk@"), host("x.clinic.net")), F.lit("user@domain.com"))
    emails = F.concat(F.transform("emails", lambda e: F.replace(e, F.lit("example"), F.lit("clinic"))), more)
    return _found(spark, sf_dir).where("kind = 'document' and size(emails) > 0").select("id", host(".clinic.com").alias("site"), emails.alias("emails"))


def _two_lists(df: DataFrame, first: str, second: str) -> DataFrame:
    part = lambda name: F.transform(f"c.{name}", lambda e, i: F.struct(F.lit(name).alias("bucket"), (i + 1).alias("rank"), e.alias("email")))
    return df.select("id", F.explode(F.concat(part(first), part(second))).alias("r")).select("id", "r.*")


@query(_SORTED_SQL + """, told AS (SELECT *, host = site OR ends_with(host, '.' || site) OR ends_with(site, '.' || host) AS own FROM usable)
SELECT id, CASE WHEN own THEN 'business' ELSE 'other' END AS bucket, CAST(row_number() OVER (PARTITION BY id, own ORDER BY NOT role, pos) AS INTEGER) AS rank, email
FROM told WHERE own OR (role AND host = 'gmail.com')""")
def classify_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of each text as the site's own inboxes and role inboxes at free hosts."""
    return _two_lists(_sorted_input(spark, sf_dir).select("id", addresses.classify(F.col("emails"), F.col("site")).alias("c")), "business", "other")


@query(_SORTED_SQL + """, told AS (SELECT *, host = site OR ends_with(host, '.' || site) OR split_part(host, '.', 1) = split_part(site, '.', 1)
  OR (length(split_part(host, '.', 1)) >= 5 AND length(split_part(site, '.', 1)) >= 5 AND (starts_with(split_part(host, '.', 1), split_part(site, '.', 1)) OR starts_with(split_part(site, '.', 1), split_part(host, '.', 1)))) AS own FROM usable)
SELECT id, CASE WHEN own THEN 'own' ELSE 'related' END AS bucket, CAST(row_number() OVER (PARTITION BY id, own ORDER BY NOT role, pos) AS INTEGER) AS rank, email FROM told""")
def tier_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of each text as the site's own by domain or brand (stems of five characters here), and related ones."""
    return _two_lists(_sorted_input(spark, sf_dir).select("id", addresses.tier(F.col("emails"), F.col("site"), stem_min=5).alias("c")), "own", "related")


@query(f"WITH {ADDRESSES_SQL} SELECT email, arg_min(kind || ':' || id, (kind, id)) AS source, count(*) AS n_sources FROM found GROUP BY email")
def email_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first place of each address and how many places hold it."""
    found = _found(spark, sf_dir).select("kind", "id", F.explode("emails").alias("email"))
    return found.groupBy("email").agg(F.min_by(F.concat_ws(":", "kind", "id"), F.struct("kind", "id")).alias("source"), F.count("*").alias("n_sources"))


@query(f"WITH {ADDRESSES_SQL}, sited AS (SELECT {KEY} AS site, email, page_id, pos, url FROM found JOIN pages ON kind = 'page' AND id = page_id) SELECT site, email, arg_min(url, (page_id, pos)) AS source_url FROM sited GROUP BY 1, 2")
def site_email_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page on which each address of a site was seen first."""
    found = table(spark, sf_dir, "pages").select(urls.site_key(F.col("url")).alias("site"), "url", "page_id", F.posexplode(addresses.extract_addresses(F.col("html"))).alias("_at", "email"))
    return inboxes.first_source_per_address(found.withColumn("pos", F.struct("page_id", "_at")))


@query("""SELECT doc_id, regexp_replace(text, '(?i)\\b(sk|fc|xai|gsk)-[A-Za-z0-9_*-]{4,}', '<redacted>', 'g') AS text FROM documents""")
def redact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without key-shaped words."""
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", provenance.redact(F.col("text"), url_tokens=False).alias("text"))


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '(?i)\\b(sk|fc|xai|gsk)-[A-Za-z0-9_*-]{4,}', '<redacted>', 'g'), '\\s+', ' ', 'g'))[1:200] AS line FROM documents""")
def brief_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 200 characters of each text as one redacted line."""
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", provenance.brief(F.col("text"), url_tokens=False).alias("line"))


_OPAQUE = "regexp_replace(url, '[?#].*', '') || '/' || sha256(url)[1:24] || '/end'"


@query(rf"""SELECT page_id, regexp_replace({_OPAQUE}, '(https?://[^\s"''<>]*?/)[A-Za-z0-9_-]{{16,}}(/|$)', '\1<redacted>\2', 'g') AS url FROM pages""")
def redact_url_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses with an opaque segment put in, redacted."""
    opaque = F.concat(F.regexp_replace("url", r"[?#].*", ""), F.lit("/"), F.substring(F.sha2(F.col("url"), 256), 1, 24), F.lit("/end"))
    return table(spark, sf_dir, "pages", "page_id", "url").select("page_id", provenance.redact(opaque).alias("url"))


@query("""WITH said AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'request failed with ' || (400 + user_id) || ' after ' || event_id || 'ms' ELSE 'fine' END AS message, CASE WHEN event_type = 'click' THEN 200 END AS status FROM events)
SELECT event_id, coalesce(status, TRY_CAST(nullif(regexp_extract(message, '(^|[^0-9A-Za-z_])([45][0-9]{2})([^0-9A-Za-z_]|$)', 2), '') AS INTEGER)) AS code FROM said""")
def status_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of every record: a structured one, else the first that its message names."""
    message = F.when(F.col("event_type") == "error", F.concat(F.lit("request failed with "), F.col("user_id") + 400, F.lit(" after "), "event_id", F.lit("ms"))).otherwise("fine")
    return table(spark, sf_dir, "events").select("event_id", provenance.status_of(F.when(F.col("event_type") == "click", 200), message).alias("code"))


@query("""SELECT 'event' AS kind, event_id AS id, json_valid(props) AND regexp_matches(props, '^[\\[{]') AS is_json FROM events
UNION ALL SELECT 'document', doc_id, coalesce(json_valid(text) AND regexp_matches(text, '^[\\[{]'), false) FROM documents""")
def is_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether properties and texts are JSON objects or lists."""
    events = table(spark, sf_dir, "events").select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("props").alias("s"))
    docs = table(spark, sf_dir, "documents").select(F.lit("document"), "doc_id", "text")
    return events.union(docs).select("kind", "id", markup.is_json(F.col("s")).alias("is_json"))


def _csv_sql(text: str) -> str:
    marks = lambda i: f"length(regexp_replace(split_part({text}, chr(10), {i}), '[^,\\t]', '', 'g')) >= 2"
    return f"coalesce(len(string_split({text}, chr(10))) >= 3 AND {marks(1)} AND {marks(2)}, false)"


@query(f"SELECT doc_id, {_csv_sql('text')} AS is_csv, {_csv_sql('replace(text, chr(32), chr(44))')} AS spaced_is_csv, coalesce(regexp_matches(text[1:4000], '(?i)<(!doctype|html|head|body|div|main|section)\\b'), false) AS is_markup FROM documents")
def text_sniffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether texts are tables (as they are, and with commas for spaces) or markup."""
    text = F.col("text")
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", markup.is_csv(text).alias("is_csv"), markup.is_csv(F.translate(text, " ", ",")).alias("spaced_is_csv"), markup.is_markup(text).alias("is_markup"))


_CHUNK = 2000
_CHUNK_SQL = f"""WITH RECURSIVE texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls, {_csv_sql('text')} AS csv FROM documents WHERE length(text) > {_CHUNK}),
bodies AS (SELECT doc_id, CASE WHEN csv THEN ls[1] ELSE '' END AS header, CASE WHEN csv THEN ls[2:] ELSE ls END AS ls FROM texts),
packed AS (SELECT doc_id, 1 AS i, 0 AS chunk, length(header) + length(ls[1]) + 1 AS size FROM bodies UNION ALL
  SELECT p.doc_id, i + 1, chunk + (size + length(ls[i + 1]) > {_CHUNK})::INT, CASE WHEN size + length(ls[i + 1]) > {_CHUNK} THEN length(header) ELSE size END + length(ls[i + 1]) + 1 FROM packed p JOIN bodies b USING (doc_id) WHERE i < len(ls)),
joined AS (SELECT doc_id, chunk, string_agg(ls[i], chr(10) ORDER BY i) AS body, any_value(header) AS header FROM packed JOIN bodies USING (doc_id) GROUP BY 1, 2)"""


@query(f"""{_CHUNK_SQL} SELECT doc_id, chunk::INTEGER AS chunk, CASE WHEN header <> '' THEN header || chr(10) || body ELSE body END AS text FROM joined
UNION ALL SELECT doc_id, 0, text FROM documents WHERE length(text) <= {_CHUNK}""")
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of whole lines of about 2,000 characters, all of every text."""
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(markup.chunks(F.col("text"), _CHUNK, most=None)).alias("chunk", "text"))


# The data's pages name no data and have no controls, so both sides read some more markup after each page.
_MORE = """<script src="/app.js?v=7"></script><script src="https://cdn.elsewhere.net/x.js"></script><a href="/lib.mjs">m</a><script>load("/feed/team.json"); load('https://elsewhere.net/t.csv'); load("/feed/team.json"); get("/api/people?p=2"); get('/data/x/y');</script>
<button id="more" class="btn big">Load more</button><a class="next-page more" href="/p2">Show <b>all</b> doctors</a><span>View more</span><div id="1x" class="9y ok">See all &amp; more</div><a class="next-page" href="/p3">show more</a><button class="save">Save</button>"""
_MORE_SQL = "'" + _MORE.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _with_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", F.lit(_MORE)).alias("html"))


@query(rf"""WITH h AS (SELECT page_id, {KEY} AS site, {SCHEME} || '://' || {HOST} AS root, html || {_MORE_SQL} AS html FROM pages),
found AS (SELECT page_id, site, root, list_concat(list_concat(regexp_extract_all(html, '(?i)(?:src|href)=["'']([^"'']+\.m?js(?:\?[^"'']*)?)["'']', 1), regexp_extract_all(html, '(?i)["''`]((?:https?://[^"''`\s]+|/[^"''`\s]+)\.(?:json|csv)(?:\?[^"''`\s]*)?)["''`]', 1)), regexp_extract_all(html, '(?i)["''`](/(?:api|data)/[^"''`\s]{{2,100}})["''`]', 1)) AS us FROM h),
each AS (SELECT page_id, site, root, unnest(us) AS u, generate_subscripts(us, 1) AS i FROM found),
full_ AS (SELECT page_id, site, CASE WHEN u LIKE 'http%' THEN u ELSE root || u END AS url, min(i) AS i FROM each GROUP BY 1, 2, 3),
inside AS (SELECT *, {KEY} AS host FROM full_)
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INTEGER AS at, url FROM inside WHERE host = site OR ends_with(host, '.' || site)""")
def data_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scripts and data paths of every page's own site."""
    return _with_more(spark, sf_dir).select("page_id", F.posexplode(markup.data_urls(F.col("html"), F.col("url"))).alias("at", "url"))


_CONTROLS_SQL = " UNION ALL ".join(rf"SELECT page_id, html, '{t}' AS tag, unnest(regexp_extract_all(html, '(?is)<{t}\b[^>]*>.{{0,160}}?</{t}>')) AS c FROM h" for t in ("button", "a", "div", "span"))


@query(rf"""WITH h AS (SELECT page_id, html || {_MORE_SQL} AS html FROM pages), c AS ({_CONTROLS_SQL}),
told AS (SELECT page_id, tag, strpos(html, c) AS spot, trim(regexp_replace({_decoded_sql("regexp_replace(c, '<[^>]+>', ' ', 'g')")}, '\s+', ' ', 'g')) AS text, regexp_extract(c, '(?i)^<[^>]*\bid=["'']([^"'']+)["'']', 1) AS own,
  list_filter(regexp_split_to_array(regexp_extract(c, '(?i)^<[^>]*\bclass=["'']([^"'']+)["'']', 1), '\s+'), lambda k: regexp_matches(k, '^[A-Za-z][A-Za-z0-9_-]*$')) AS classes FROM c),
named AS (SELECT page_id, spot, text, CASE WHEN regexp_matches(own, '^[A-Za-z][A-Za-z0-9_-]*$') THEN '#' || own WHEN len(classes) > 0 THEN tag || '.' || classes[1] END AS selector FROM told
  WHERE length(text) <= 60 AND regexp_matches(text, '(?i)\b(?:(?:load|show|view|see)\s+(?:more|all)|more\s+(?:results|doctors|people|team))\b'))
SELECT page_id, selector, arg_min(text, spot) AS text FROM named WHERE selector IS NOT NULL GROUP BY 1, 2""")
def load_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Controls of every page that promise more entries."""
    return _with_more(spark, sf_dir).select("page_id", F.explode(markup.load_more(F.col("html"))).alias("c")).select("page_id", "c.selector", "c.text")


@query(f"""WITH s AS (SELECT DISTINCT {KEY} AS key FROM pages), d AS (SELECT {KEY} AS key, bool_or(html LIKE '%@%') AS any_at FROM pages GROUP BY 1)
SELECT key, any_at AS has_email FROM s JOIN d USING (key)""")
def site_has_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether any page of a site holds an at sign."""
    pages = table(spark, sf_dir, "pages").withColumn("key", urls.site_key(F.col("url")))
    return ledger.has_any(pages, "key", F.contains("html", F.lit("@")), "has_email")
