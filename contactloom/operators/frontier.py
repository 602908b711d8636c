"""An explorer of sites as data: rounds of wish, visit and answer, at most so many steps for a site.

A site's explorer asks for one page at a time: to look at it or to extract people from it, as it is or, as a second look,
rendered, scrolled or clicked.  All sites' wishes of a round are one table, and so are the pages that it takes.
Pages are kept by site, address and mode, so none is fetched twice.  Every round is written and then committed, and a run
that was stopped goes on with the round after the last committed one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import addresses, markup
from ..sources import commits
from ..sources.providers import Provider, Service
from .models import extract_people

# Steps of a site, and how much of a page its explorer is shown.
STEPS, LINKS, EMAILS, CONTROLS = 16, 150, 40, 5
WISH = "key string, step int, tool string, url string, mode string, selector string"
PAGE = "key string, url string, mode string, html string"
PERSON = "domain string, name string, title string, email string, source_url string, pos long"
ANSWER = WISH + ", error string, chars int, links array<struct<url:string,text:string>>, emails array<string>, controls array<struct<selector:string,text:string>>, people int"


def _first_look(mode: Column) -> Column:
    return F.coalesce(mode, F.lit("none")) == "none"


def wishes(asked: DataFrame) -> DataFrame:
    """A model's wishes in plain form: an address has a scheme, no mode is ``none``; other tools than visit and extract end a site's way."""
    url = F.when(F.col("url").rlike("^(?i:https?)://"), F.col("url")).otherwise(F.concat(F.lit("https://"), "url"))
    mode = F.when(F.col("mode").isin("render", "scroll", "click"), F.col("mode")).otherwise("none")
    return asked.where(F.col("tool").isin("visit", "extract") & (F.trim(F.coalesce("url", F.lit(""))) != "")).select("key", F.col("step").cast("int").alias("step"), "tool", url.alias("url"), mode.alias("mode"), F.when(F.trim("selector") != "", F.col("selector")).alias("selector"))


def fetched(asked: DataFrame, pages: DataFrame, fetch: Service) -> DataFrame:
    """``asked`` with html and error.

    A page that is there is not fetched again, one that failed is.  A second look needs a first one that succeeded, and a click a
    selector, given or found on the first look; else the wish fails without a fetch.  ``fetch`` adds html and error to (key, url, mode, selector).
    """
    first = pages.where(_first_look(F.col("mode"))).select("key", "url", F.col("html").alias("_first"))
    known = asked.join(first, ["key", "url"], "left")
    selector = F.coalesce("selector", F.get(markup.load_more(F.col("_first"), CONTROLS), F.lit(0))["selector"])
    known = known.withColumn("selector", F.when(F.col("mode") == "click", selector))
    refused = F.when(~_first_look(F.col("mode")) & F.col("_first").isNull(), "fetch it without interaction first").when((F.col("mode") == "click") & F.col("selector").isNull(), "no control to click on this page")
    known = known.withColumn("_refused", refused).drop("_first")
    there = known.join(pages.select("key", "url", "mode", F.col("html").alias("_held")), ["key", "url", "mode"], "left")
    new = fetch(there.where("_held is null and _refused is null").select("key", "url", "mode", "selector").distinct()).select("key", "url", "mode", F.col("html").alias("_new"), F.col("error").alias("_error"))
    told = there.join(new, ["key", "url", "mode"], "left").withColumn("html", F.coalesce("_held", F.when(F.col("_error").isNull(), F.col("_new"))))
    error = F.when(F.col("html").isNull(), F.coalesce("_refused", "_error", F.lit("no page")))
    return told.withColumn("error", error).select("key", "step", "tool", "url", "mode", "selector", "html", "error")


def summaries(answered: DataFrame, counts: DataFrame) -> DataFrame:
    """What the explorer is told of each wish: never the page itself, only counts, links, addresses and controls."""
    text = F.when(markup.is_markup(F.col("html")), markup.html_to_text(F.col("html"))).otherwise(F.col("html"))
    known = F.col("html").isNotNull()
    links = F.when(known, markup.extract_links(F.col("html"), F.col("url"), LINKS))
    controls = F.transform(markup.load_more(F.col("html"), CONTROLS), lambda c: F.struct(c["selector"].alias("selector"), c["text"].alias("text")))
    told = answered.join(counts, ["key", "step"], "left")
    return told.select(*[c.split()[0] for c in WISH.split(", ")], "error", F.length(text).alias("chars"), links.alias("links"), F.when(known, F.slice(addresses.extract_addresses(F.col("html")), 1, EMAILS)).alias("emails"), F.when(known, controls).alias("controls"), F.when(F.col("tool") == "extract", F.coalesce("people", F.lit(0))).cast("int").alias("people"))


def histories(answers: DataFrame) -> DataFrame:
    """(key, step, history): what each site's explorer has been told, in order, and the step that comes next; no more than the steps of a site."""
    fields = [c for c in answers.columns if c != "key"]
    told = F.array_sort(F.collect_list(F.struct(*fields)))
    return answers.groupBy("key").agg(told.alias("history"), (F.max("step") + 1).alias("step")).select("key", "step", "history")


class Exploration:
    """The rounds below ``folder``: answers, pages and people as they were committed."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.at = commits.latest(spark, folder)

    def table(self, name: str, schema: str) -> DataFrame:
        rounds = self.at.content["rounds"] if self.at else []
        return reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(f"{self.folder}/{r}/{name}") for r in rounds], self.spark.createDataFrame([], schema))

    @property
    def answers(self) -> DataFrame:
        return self.table("answers", ANSWER)

    @property
    def pages(self) -> DataFrame:
        return self.table("pages", PAGE)

    @property
    def people(self) -> DataFrame:
        return self.table("people", PERSON)

    @property
    def ended(self) -> DataFrame:
        """Sites whose explorer asked for nothing more."""
        return self.table("decisions", WISH).join(wishes(self.table("decisions", WISH)).select("key", "step"), ["key", "step"], "left_anti").select("key").distinct()

    def round(self, decisions: DataFrame, fetch: Service, model: Provider | None) -> bool:
        """Answer a round's decisions and commit them; False where there were none."""
        name = f"round-{uuid.uuid4().hex}"

        def put(df: DataFrame, part: str, schema: str) -> DataFrame:
            df.write.parquet(f"{self.folder}/{name}/{part}")
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/{part}")

        said = put(decisions, "decisions", WISH)
        if said.isEmpty():
            return False
        done = put(fetched(wishes(said), self.pages, fetch), "visits", WISH + ", html string, error string")
        put(done.where("html is not null").select("key", "url", "mode", "html").join(self.pages.select("key", "url", "mode"), ["key", "url", "mode"], "left_anti").select("key", "url", "mode", "html"), "pages", PAGE)
        read = done.where("tool = 'extract' and html is not null").select(F.col("key").alias("domain"), "url", "html", F.col("step").alias("pos"))
        people = extract_people(read, model) if model else self.spark.createDataFrame([], PERSON)
        people = put(people.select("domain", "name", "title", "email", "source_url", "pos"), "people", PERSON)
        counts = people.groupBy(F.col("domain").alias("key"), F.shiftright("pos", 24).cast("int").alias("step")).agg(F.count("*").alias("people"))
        put(summaries(done, counts), "answers", ANSWER)
        self.at = commits.add(self.spark, self.folder, self.at, {"rounds": [*(self.at.content["rounds"] if self.at else []), name]})
        return True


def explore(sites: DataFrame, fetch: Service, decide: Service, folder: str, model: Provider | None = None, steps: int = STEPS) -> Exploration:
    """Explore ``sites`` (key, original) until no explorer wishes for more, each for at most ``steps`` steps.

    The first wish is the site's own address.  Then ``decide`` adds tool, url, mode and selector to (key, step, history); a
    tool other than ``visit`` and ``extract`` ends a site's way.  What ``model`` reads from extracted pages is in ``people``.
    Called again on the same folder it goes on after the last round; new sites begin there.
    """
    run = Exploration(sites.sparkSession, folder)
    columns = [c.split()[0] for c in WISH.split(", ")]
    while True:
        known = histories(run.answers)
        none = F.lit(None).cast("string")
        first = sites.join(known.select("key"), "key", "left_anti").select("key", F.lit(1).alias("step"), F.lit("visit").alias("tool"), F.col("original").alias("url"), none.alias("mode"), none.alias("selector"))
        going = known.where(F.col("step") <= steps).join(sites.select("key"), "key", "left_semi").join(run.ended, "key", "left_anti")
        if not run.round(first.unionByName(decide(going).select(*columns)), fetch, model):
            return run
