"""The parts of model-backed steps that are plain data: prompts, chunks, answers, and the gates behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import markup, urls
from ..functions.names import person_key
from ..sources.providers import Provider, ask, json_answer
from ..sources.shared import keep
from .crawl import ranked_candidates, under_prefixes
from .ledger import numbered_within
from .patterns import proof_gate
from .people import dedupe_people

RANKING = "candidates array<struct<index:int,score:double,reason:string,kind:string>>, profilePrefixes array<string>"
PEOPLE = "people array<struct<name:string,title:string,email:string>>"


def page_list(entries: DataFrame) -> DataFrame:
    """(key, prompt): the numbered pages of each site, by path and title, as a ranking model reads them.

    A site's entries are capped before, so its list is bounded.
    """
    line = F.concat((F.col("entry") - 1).cast("string"), F.lit(". "), urls.path_of(F.col("url")), F.when(F.coalesce("title", F.lit("")) != "", F.concat(F.lit(" - "), "title")).otherwise(""))
    lines = F.array_sort(F.collect_list(F.struct("entry", line.alias("line"))))
    return entries.groupBy("key").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("prompt"))


def rank_pages(entries: DataFrame, model: Provider, top: int = 15, fan_out: int | None = 3) -> tuple[DataFrame, DataFrame]:
    """(candidates, profile pages) of each site: the model answers with indexes, and code looks the pages up.

    ``model`` takes key and prompt and gives ``answer``, its raw text.
    """
    said = keep(ask(page_list(entries), model, fan_out), "rankings").withColumn("a", json_answer(F.col("answer"), RANKING)).where("a is not null")
    answers = said.select("key", F.posexplode("a.candidates").alias("said", "c")).select("key", "said", "c.index", "c.score", "c.reason", F.coalesce("c.kind", F.lit("other")).alias("kind"))
    prefixes = said.select("key", F.explode("a.profilePrefixes").alias("prefix"))
    return ranked_candidates(entries, answers, top), under_prefixes(entries.select("key", "url"), prefixes)


def extract_people(pages: DataFrame, model: Provider, fan_out: int | None = 6, size: int = 50_000, at_once: int = 4) -> DataFrame:
    """(domain, name, title, email, source_url, pos): people that the model reads from each chunk of each page, ``at_once`` chunks of a task at a time.

    ``pages`` (domain, url, html, pos).  The source is the page's own address, whatever the model says.
    """
    text = F.when(markup.is_markup(F.col("html")), markup.html_to_text(F.col("html"))).otherwise(F.col("html"))
    parts = pages.select("domain", "url", "pos", F.posexplode(markup.chunks(text, size)).alias("chunk", "prompt"))
    said = ask(parts, model, fan_out, at_once).select("domain", "url", "pos", "chunk", F.posexplode(json_answer(F.col("answer"), PEOPLE)["people"]).alias("at", "p"))
    return said.where("trim(p.name) != ''").select("domain", "p.name", "p.title", F.lower(F.trim("p.email")).alias("email"), F.col("url").alias("source_url"), (F.col("pos").cast("long") * (1 << 24) + F.col("chunk") * (1 << 16) + F.col("at")).alias("pos"))


def organise_people(raw: DataFrame, model: Provider | None = None, most: int = 250, at_once: int = 4) -> DataFrame:
    """(domain, person_key, name, title, email, source_url, place): people merged by code, then by a model at sites of at most ``most``.

    The model takes domain and prompt, a person a line as "name | title | email", and answers with the people that it
    merged, leaders first; ``place`` is their place in its answer.  It never sees or gives a page: that is found again by the
    person's key, and is null where the model renamed someone past recognition.  Larger sites, and those without
    a usable answer, keep the people that code merged, without a place.
    """
    merged = dedupe_people(raw).withColumn("place", F.lit(None).cast("int"))
    if model is None:
        return merged
    counted = merged.groupBy("domain").agg(F.count("*").alias("_n"))
    small = merged.join(counted.where(F.col("_n") <= most).select("domain"), "domain", "left_semi")
    line = F.concat_ws(" | ", "name", F.coalesce("title", F.lit("")), F.coalesce("email", F.lit("")))
    lines = F.array_sort(F.collect_list(F.struct("name", line.alias("line"))))  # at most ``most``
    prompts = small.groupBy("domain").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("prompt"))
    said = keep(ask(prompts, model, at_once=at_once), "organised").withColumn("a", json_answer(F.col("answer"), PEOPLE)["people"]).where("a is not null")
    told = said.select("domain", F.posexplode("a").alias("place", "p")).where("trim(coalesce(p.name, '')) != ''")
    filled = lambda c: F.when(F.trim(c) != "", F.trim(c))
    named = told.select("domain", F.trim("p.name").alias("name"), filled("p.title").alias("title"), F.lower(filled("p.email")).alias("email"), "place").withColumn("person_key", person_key(F.col("name")))
    pages = merged.select("domain", "person_key", "source_url")
    kept = named.join(pages, ["domain", "person_key"], "left").select(*merged.columns)
    return kept.unionByName(merged.join(said.select("domain"), "domain", "left_anti"))


def by_name(people: DataFrame, most: int = 250) -> DataFrame:
    """``people`` with ``rank``: from 1 in the order of names at sites of over ``most`` people, which no model sees; null elsewhere.

    Sites are numbered by ranges of names, so one with a third of all people is no task of its own.
    """
    counts = people.groupBy("domain").agg(F.count("*").alias("_people"))
    placed = numbered_within(people, "domain", F.collate("name", "UNICODE"), "name", "person_key", name="rank").join(counts, "domain")
    return placed.withColumn("rank", F.when(F.col("_people") > most, F.col("rank") + 1).cast("int")).drop("_people")


def first_of_group(df: DataFrame, group: str, value: str, order: str, n: int) -> DataFrame:
    """(group, value, order): the first ``n`` different rows of each group; a task sends no more than that of a group."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order, value))
    return df.select(group, value, order).distinct().withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def judge_patterns(unlearned: DataFrame, people: DataFrame, evidence: DataFrame, model: Provider, names: int = 25, emails: int = 12, at_once: int = 8) -> DataFrame:
    """(domain, pattern, source): formats that a model proposes and that reproduce a published address.

    ``unlearned`` (domain).  The prompt holds at most ``names`` names and ``emails`` addresses, and no more are gathered; without
    the proof a proposal is dropped.
    """
    def some(df: DataFrame, value: str, n: int) -> DataFrame:
        first = first_of_group(df.join(unlearned, "domain", "left_semi"), "domain", value, "pos", n)
        lines = F.transform(F.array_sort(F.collect_list(F.struct("pos", value))), lambda x: x[value])
        return first.groupBy("domain").agg(F.array_join(lines, "\n").alias(value))

    prompts = some(people, "name", names).join(some(evidence, "email", emails), "domain").select("domain", F.concat_ws("\n\n", "name", "email").alias("prompt"))
    said = keep(ask(prompts, model, at_once=at_once), "judged").select("domain", json_answer(F.col("answer"), "pattern string")["pattern"].alias("pattern")).where("pattern is not null")
    return proof_gate(said, people, evidence)


def search_prompt(name: Column, title: Column, company: Column, specialty: Column, place: Column) -> Column:
    """What a researcher is asked about one person; the place is a parameter."""
    role = F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(", "), title)).otherwise("")
    field_ = F.when(F.coalesce(specialty, F.lit("")) != "", F.concat(F.lit(" ("), specialty, F.lit(")"))).otherwise("")
    return F.concat(F.lit("Find the published work address of "), name, role, F.lit(" at "), company, field_, F.lit(" in "), place, F.lit(". Answer with email, source_url, identity_match, confidence and notes as JSON; identity_match is confirmed only if field, place and employer all agree."))
