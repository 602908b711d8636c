"""Outside services behind plain callables, and their recorded forms.

A provider is a function of one request, plain or a coroutine, that returns a mapping or raises.  It runs in tasks, several
calls at once, with retries; what it raises becomes the row's ``error``, redacted.  Recorded
answers are tables, so a recorded run is a join and gives the same rows every time.
"""

from __future__ import annotations

import asyncio
import re
import time
from collections.abc import Awaitable, Callable, Iterator
from contextlib import AbstractAsyncContextManager, nullcontext
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

from ..functions import markup, names, provenance, urls
from .in_flight import Loop, in_order


@dataclass(frozen=True)
class Retry:
    """How often to try, how long to wait (doubling or growing evenly), and which statuses no retry heals."""

    attempts: int = 3
    first_wait: float = 0.3
    doubling: bool = True
    final: tuple[int, ...] = (401, 402, 403)
    final_words: str = r"(?i)payment|unauthori[sz]ed"

    def wait(self, attempt: int) -> float:
        return self.first_wait * (2**attempt if self.doubling else attempt + 1)

    def gives_up(self, error: Exception) -> bool:
        return getattr(error, "status", None) in self.final or re.search(self.final_words, str(error)) is not None


@dataclass(frozen=True)
class Provider:
    """A named service: ``call(request) -> answer`` and the answer's fields.

    ``seconds`` limits one call, where it is given; a plain function that hangs keeps its thread, a coroutine is
    given up.  ``sleep`` waits between attempts, on the event loop if it is None.
    """

    name: str
    call: Callable[[dict], dict] | Callable[[dict], Awaitable[dict]]
    fields: str
    retry: Retry = field(default_factory=Retry)
    secrets: tuple[str, ...] = ()
    sleep: Callable[[float], None] | None = None
    seconds: float | None = None

    async def answer(self, loop: Loop, request: dict, place: AbstractAsyncContextManager | None = None) -> dict:
        for attempt in range(self.retry.attempts):
            limit = asyncio.timeout(self.seconds)
            try:
                async with place or loop.free, limit:
                    return {**await loop.call(self.call, request), "error": None}
            except Exception as e:  # noqa: BLE001  a row's failure is its result
                last = TimeoutError(f"no answer in {self.seconds:g} seconds") if limit.expired() else e
                if self.retry.gives_up(e):
                    break
            if attempt + 1 < self.retry.attempts:
                wait = self.retry.wait(attempt)
                await (asyncio.sleep(wait) if self.sleep is None else loop.call(self.sleep, wait))
        return {"error": plain_redacted(f"{type(last).__name__}: {last}", self.secrets)[:200]}


def plain_redacted(text: str, secrets: tuple[str, ...] = ()) -> str:
    """The same as ``provenance.redact`` for one string on the driver or in a task."""
    for s in filter(None, secrets):
        text = text.replace(s, "<redacted>")
    text = re.sub(provenance.KEY_SHAPED, "<redacted>", text)
    return re.sub(r"(https?://[^\s\"'<>]*?/)[A-Za-z0-9_-]{16,}(?=[/\s\"'<>]|\Z)", r"\1<redacted>", text)


AnswerOne = Callable[[Loop, dict], Awaitable[dict]]


def _answered(rows: DataFrame, provider: Provider, at_once: int, one: Callable[[], AnswerOne]) -> DataFrame:
    """``rows`` with what ``one()``, made once in each task, answers to each; ``at_once`` calls of a task run at a time."""
    whole = StructType(rows.schema.fields + StructType.fromDDL(provider.fields).fields).add("error", StringType())
    arrow = to_arrow_schema(whole)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        requests = (r for b in batches for i in range(0, b.num_rows, at_once) for r in b.slice(i, at_once).to_pylist())
        for group in in_order(requests, one(), at_once):
            yield pa.RecordBatch.from_pylist([{**dict.fromkeys(arrow.names), **request, **answer} for request, answer in group], schema=arrow)

    return rows.mapInArrow(answered, whole)


def ask(requests: DataFrame, provider: Provider, fan_out: int | None = None, at_once: int = 1) -> DataFrame:
    """``requests`` with the provider's fields and ``error``, one call for each row.

    ``fan_out`` partitions with ``at_once`` calls each bound how many run at a time; rows keep their order.  A lost
    task is run again, so write the answers to a ledger and ask only for what is pending there.  A split of a narrow
    table's file may hold millions of requests: ``shared.scattered`` deals them to more tasks, of which no more run at a time than there are cores.
    """
    return _answered(requests.repartition(fan_out) if fan_out else requests, provider, at_once, lambda: provider.answer)


def recorded(requests: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """``requests`` with recorded answers; one that was not recorded is an error."""
    known = answers.withColumn("_known", F.lit(True))
    joined = requests.join(known, key, "left")
    error = F.when(F.col("_known").isNull(), F.lit("not recorded"))
    error = F.coalesce(F.col("error"), error) if "error" in answers.columns else error
    return joined.withColumn("error", error).drop("_known")


def needs_render(html: Column) -> Column:
    """A page without source, or markup with under 600 characters of text, is worth rendering; what is no markup is data and never is."""
    data = ~markup.is_markup(html) | markup.is_json(names.trimmed(html)) | markup.is_csv(html)
    return F.coalesce(html == "", F.lit(True)) | (~data & (F.length(markup.html_to_text(html)) < 600))


def fetch_pages(requests: DataFrame, static: Callable[[DataFrame], DataFrame], rendered: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(url, html, rendered, error): the cheap fetch for all, the dear one only for pages that need it.

    ``static`` and ``rendered`` add html and error to a table of urls.  A thin page stays where rendering fails too.
    """
    wanted = requests.select(F.regexp_replace("url", "^http://", "https://").alias("fetch_url"), "url").distinct()
    cheap = static(wanted.select(F.col("fetch_url").alias("url")).distinct()).select(F.col("url").alias("fetch_url"), F.when(F.col("error").isNull(), F.col("html")).alias("_thin"), F.col("error").alias("_thin_error"))
    cheap = cheap.withColumn("_more", needs_render(F.col("_thin")))
    dear = rendered(cheap.where("_more").select(F.col("fetch_url").alias("url"))).select(F.col("url").alias("fetch_url"), F.when(F.col("error").isNull(), F.col("html")).alias("_full"), F.col("error").alias("_full_error"))
    both = wanted.join(cheap, "fetch_url", "left").join(dear, "fetch_url", "left")
    html = F.coalesce("_full", "_thin")
    return both.select("url", html.alias("html"), F.col("_full").isNotNull().alias("rendered"), F.when(html.isNull(), F.coalesce("_full_error", "_thin_error")).alias("error"))


def captures(raw: Column, page_url: Column, most: int = 15, size: int = 1_500_000) -> Column:
    """Array of (url, body) of captured responses that are data: the first ``most``, the site's own before others, long before short."""
    body = F.transform(raw, lambda c: F.struct(c["url"].alias("url"), F.regexp_replace(F.decode(F.unbase64(c["body"]), "UTF-8"), r"^\s+|\s+\z", "").alias("body")))
    data = F.filter(body, lambda c: (F.coalesce(c["url"], F.lit("")) != "") & (markup.is_json(c["body"]) | markup.is_csv(c["body"])))
    site = urls.site_key(page_url)
    own = lambda u: (urls.site_key(u) == site) | F.endswith(urls.site_key(u), F.concat(F.lit("."), site))
    ranked = F.transform(F.slice(data, 1, most), lambda c, i: F.struct((~own(c["url"])).cast("int").alias("other"), (-F.least(F.length(c["body"]), F.lit(size))).alias("less"), i.alias("at"), c["url"].alias("url"), F.substring(c["body"], 1, size).alias("body")))
    return F.transform(F.array_sort(ranked), lambda c: F.struct(c["url"].alias("url"), c["body"].alias("body")))


def interaction(mode: str, selector: str | None = None, rounds: int = 6) -> list[dict]:
    """Steps of an interactive fetch: none to render only, else scroll or click ``rounds`` times, 1 to 12."""
    if mode not in ("render", "scroll", "click"):
        raise ValueError(f"unknown mode {mode!r}")
    scroll, pause = {"action": "scrollBottom"}, {"action": "waitForTimeout", "timeout": 1.5}
    if mode == "render":
        return []
    click = {"action": "click", "selector": {"type": "css", "value": selector}}
    once = [click, pause, scroll] if mode == "click" and selector else [scroll, pause]
    return [scroll, pause, *once * min(max(rounds, 1), 12)]


def json_answer(raw: Column, schema: str) -> Column:
    """A model's JSON answer, code fences taken off; null where it isn't what the schema says."""
    bare = F.regexp_replace(F.regexp_replace(raw, r"(?i)^\s*```(?:json)?\s*", ""), r"```\s*\z", "")
    return F.from_json(bare, schema)


HIT = "email string, source_url string, identity_match string, confidence string, notes string"


def search_answer(raw: Column) -> Column:
    """A search's answer: the whole text as JSON, or the first flat object with identity_match in it; null for neither."""
    inner = F.regexp_extract(raw, r"\{[^{}]*\"identity_match\"[^{}]*\}", 0)
    found = F.coalesce(F.when(F.try_parse_json(raw).isNotNull(), F.from_json(raw, HIT)), F.when(inner != "", F.from_json(inner, HIT)))
    text = lambda c: F.trim(F.coalesce(found[c], F.lit("")))
    or_ = lambda c, d: F.when(text(c) == "", d).otherwise(text(c))
    return F.when(found.isNotNull(), F.struct(F.lower(text("email")).alias("email"), text("source_url").alias("source_url"), or_("identity_match", "uncertain").alias("identity_match"), or_("confidence", "low").alias("confidence"), text("notes").alias("notes")))


def is_rate_limited(stderr: str) -> bool:
    """Only what the tool itself says counts, not the answer or the pages it quotes."""
    return re.search(r"(?i)usage limit|rate limit|rate_limit|\b429\b|too many requests|limit reached|quota exceeded", stderr) is not None


def may_go_on(used_percent: float | None, stop_at: float = 90) -> bool:
    """Below the limit; a meter that can't be read stops the run."""
    return used_percent is not None and used_percent < stop_at


def health(status: int | None, configured: bool = True) -> str:
    """PASS, FAIL or SKIP of a provider's probe; a rate limit proves that the key works."""
    if not configured:
        return "SKIP"
    return "PASS" if status is not None and (200 <= status < 300 or status == 429) else "FAIL"


def explain(status: int | None, message: str, model: str, endpoint: str) -> str:
    """One line on what a failed model call means."""
    if status in (401, 403):
        return f"the key was rejected by {endpoint}"
    if status == 404:
        kind = "deployment" if re.search(r"(?i)azure|cognitiveservices", endpoint) else "model"
        return f"{endpoint} has no {kind} named {model!r}"
    if status == 400 and re.search(r"(?i)not allowed|not supported|batch", message):
        return f"{model!r} exists at {endpoint} but does not take this kind of call"
    return f"the call of {model!r} at {endpoint} failed: {plain_redacted(message)[:120]}"


Service = Callable[[DataFrame], DataFrame]
STATIC_SECONDS, RENDERED_SECONDS = 20, 60  # fixed values: how long a fetch may take


def asking(provider: Provider, fan_out: int | None = None, at_once: int = 1) -> Service:
    """A provider as a service over tables."""
    return lambda requests: ask(requests, provider, fan_out, at_once)


def fetching(provider: Provider, rendered: bool = False, fan_out: int | None = None, at_once: int = 8) -> Service:
    """A service over a table of urls that asks for https addresses with a mode and a time limit; adds html and error."""
    def fetch(requests: DataFrame) -> DataFrame:
        asked = requests.withColumns({"fetch_url": F.regexp_replace("url", "^http://", "https://"), "mode": F.lit("rendered" if rendered else "static"), "seconds": F.lit(RENDERED_SECONDS if rendered else STATIC_SECONDS)})
        return ask(asked, provider, fan_out, at_once).drop("fetch_url", "mode", "seconds")

    return fetch


def map_sites(sites: DataFrame, service: Service, limit: int = 1000, seconds: int = 60) -> DataFrame:
    """(key, links array<struct<url,title>>, error) of sites (key, original): at most ``limit`` pages that a service knows of each.

    ``service`` adds links and error to key, url, limit and seconds; a failed site has no links.
    """
    asked = service(sites.select("key", F.col("original").alias("url"), F.lit(limit).alias("limit"), F.lit(seconds).alias("seconds")))
    links = F.when(F.col("error").isNull(), F.slice("links", 1, limit))
    return asked.select("key", F.coalesce(links, F.array().cast("array<struct<url:string,title:string>>")).alias("links"), "error")


def reachable(requests: DataFrame, service: Service, seconds: int = 10) -> DataFrame:
    """``requests`` with ``alive``: any status of an answer means that the host is up, only a failure to connect that it is down.

    ``service`` adds status to requests with seconds.
    """
    asked = service(requests.withColumn("seconds", F.lit(seconds)))
    return asked.select(*requests.columns, F.col("status").isNotNull().alias("alive"))


def models(reasoning: Provider, extraction: Provider | None = None) -> tuple[Provider, Provider]:
    """The model that ranks and judges, and the one that extracts; one can do both."""
    return reasoning, extraction or reasoning


def looked_up(targets: DataFrame, *sources: DataFrame) -> DataFrame:
    """(domain, priority, exchange, rcode) of ``targets`` (domain), each from the first source that says anything about it for certain.

    A source (domain, priority, exchange, rcode) has a row for each exchanger, or one without an exchanger.  The first is the native
    lookup, where NOERROR, NODATA and NXDOMAIN are certain; in the others, asked one after another where
    it failed, any code is an answer.  Where none answers, the rcode is the first source's, or SERVFAIL.
    """
    best = None
    for n, source in enumerate(sources):
        certain = F.col("rcode").isin("NOERROR", "NODATA", "NXDOMAIN") if n == 0 else F.col("rcode").isNotNull()
        host = F.when(F.col("rcode") != "NXDOMAIN", F.regexp_replace(F.regexp_replace("exchange", r"^[0-9]+\s+", ""), r"\.\z", ""))
        rows = source.select("domain", "priority", host.alias("exchange"), F.when(certain & (F.col("rcode") != "NXDOMAIN"), "NOERROR").otherwise(F.col("rcode")).alias("rcode"), certain.alias("_certain"), F.lit(n).alias("_n"))
        best = rows if best is None else best.unionByName(rows)
    first = best.where("_certain").groupBy("domain").agg(F.min("_n").alias("_n"))
    native = best.where("_n = 0").groupBy("domain").agg(F.min("rcode").alias("_code"))
    told = targets.select("domain").distinct().join(first, "domain", "left")
    found = told.join(best.drop("_certain"), ["domain", "_n"]).drop("_n")
    failed = told.where("_n is null").join(native, "domain", "left").select("domain", F.lit(None).cast("int").alias("priority"), F.lit(None).cast("string").alias("exchange"), F.coalesce("_code", F.lit("SERVFAIL")).alias("rcode"))
    return found.select("domain", F.col("priority").cast("int").alias("priority"), F.when(F.col("exchange") != "", F.col("exchange")).alias("exchange"), "rcode").unionByName(failed)


def ask_within(requests: DataFrame, provider: Provider, key: str, order: str, seconds: float, clock: Callable[[], float] = time.monotonic, at_once: int = 1) -> DataFrame:
    """As ``ask``, but the calls of one key, in their order, share a time limit: once it is up the rest are errors and nothing is asked.

    What was answered before stays, so a slow site keeps its partial results.  ``at_once`` keys of a task are served at a
    time, the calls of each one after another.
    """
    def one() -> AnswerOne:
        chain: dict = {"key": None, "last": None, "spent": None}

        def begin(loop: Loop, request: dict) -> Awaitable[dict]:
            # Requests come in order, so the one before is of the same key or ends another's turn.
            if chain["last"] is None or request[key] != chain["key"]:
                chain.update(key=request[key], last=None, spent=[0.0])
            before, spent, done = chain["last"], chain["spent"], asyncio.Event()
            chain["last"] = done

            async def turn() -> dict:
                try:
                    if before is not None:
                        await before.wait()
                    if spent[0] >= seconds:
                        return {"error": "over the time limit"}
                    async with loop.free:  # time spent waiting for a place isn't the site's
                        began = clock()
                        answer = await provider.answer(loop, request, nullcontext())
                        spent[0] += clock() - began
                    return answer
                finally:
                    done.set()

            return turn()

        return begin

    return _answered(requests.repartition(key).sortWithinPartitions(key, order), provider, at_once, one)
