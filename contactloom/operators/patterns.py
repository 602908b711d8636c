"""Learning of each domain's address format from published addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import addresses, names
from ..functions.let import with_fields
from ..sources.shared import scattered


ADDRESS_COLUMNS = ("email", "business_email", "all_business_emails", "related_email", "web_found_email")


def master_evidence(master: DataFrame, resolved: DataFrame, columns: tuple[str, ...] = ADDRESS_COLUMNS) -> DataFrame:
    """(domain, email, pos, personal): the distinct addresses of each domain's rows that stand on its own or its mail domain.

    Cells are split at ; and , trimmed and lower-cased; ``pos`` is the first place (row, column, part).  An address is
    the domain's own by its mail domain, its bare domain or their first label; ``personal`` leaves role words
    out and is what can prove a format.  ``master`` (domain, pos, ...), ``resolved`` (domain, email_domain).
    """
    held = [c for c in columns if c in master.columns]
    cells = F.array(*[F.split(F.coalesce(F.col(c) if c in held else F.lit(""), F.lit("")), "[;,]") for c in columns])
    # Places are structs, so the first of them is found by sorting a task's rows.
    rows = scattered(master.select("domain", "pos", *[c for c in held if c not in ("domain", "pos")]), "domain", "pos")
    parts = rows.select("domain", "pos", F.posexplode(cells).alias("_column", "_parts")).select("domain", "pos", "_column", F.posexplode("_parts").alias("_part", "_email"))
    given = parts.select("domain", F.lower(F.trim("_email")).alias("email"), F.struct("pos", "_column", "_part").alias("pos")).where("domain is not null and email != ''").groupBy("domain", "email").agg(F.min("pos").alias("pos"))
    mail = resolved.where("email_domain is not null").groupBy("domain").agg(F.min("email_domain").alias("_mail"))
    bare = F.regexp_replace("domain", r"^www\.", "")
    own = addresses.evidence(F.array("email"), F.lower(F.coalesce("_mail", bare)), bare)
    return with_fields(given.join(mail, "domain", "left"), F.struct(own.alias("_own"))).where("size(_own.own) > 0").select("domain", "email", "pos", (F.size("_own.personal") > 0).alias("personal"))


def learn_patterns(people: DataFrame, evidence: DataFrame, ascii_only: bool = False, by_rank: bool = False) -> DataFrame:
    """(domain, pattern, votes, confidence, source) by votes of names times patterns times addresses.

    ``people`` (domain, name, pos) and ``evidence`` (domain, email, pos).  The most votes win; a tie goes
    to the pattern whose first vote came first (address, then name, then rank), or with ``by_rank`` to
    the higher ranked.  The source is the first address that any pattern gave.  Candidates meet addresses in an equi-join on domain and local part; nothing is
    multiplied out.
    """
    hits = _hits(people, evidence, ascii_only)
    votes = hits.groupBy("domain", "pattern", "rank").agg(F.sum("names").alias("votes"), F.min(F.struct("email_pos", "name_pos", "rank")).alias("first"), F.min(F.struct("email_pos", "email")).alias("proof"))
    tie = F.col("rank") if by_rank else F.col("first")
    best = votes.groupBy("domain").agg(F.min_by(F.struct("pattern", "votes"), F.struct(-F.col("votes"), tie.alias("t"))).alias("b"), F.min("proof").alias("p"))
    return best.select("domain", "b.pattern", "b.votes", F.lit("deterministic").alias("confidence"), F.col("p.email").alias("source"))


def _made(people: DataFrame, ascii_only: bool) -> DataFrame:
    """(domain, local, rank, pattern, names, name_pos): what each pattern makes of each distinct name of a domain, how many rows have the name, and the first of them."""
    each = people.groupBy("domain", "name").agg(F.count("*").alias("names"), F.min("pos").alias("name_pos"))
    split = each.select("domain", "names", "name_pos", names.first_last(names.name_tokens(F.col("name"), ascii_only)).alias("n")).where("n is not null")
    built = F.array(*[F.struct(names.local_part(p, F.col("n.first"), F.col("n.last")).alias("local"), F.lit(i).alias("rank"), F.lit(p).alias("pattern")) for i, p in enumerate(names.PATTERNS)])
    return split.select("domain", "names", "name_pos", F.explode(built).alias("c")).select("domain", "names", "name_pos", "c.*")


def _given(evidence: DataFrame) -> DataFrame:
    """Published addresses by local part.  Spark takes no side of a join for small that is exploded or aggregated from a small file: its estimate doesn't know of the new rows, and the driver would hold them all."""
    return evidence.select("domain", "email", F.col("pos").alias("email_pos"), F.split("email", "@")[0].alias("local")).hint("merge")


def _hits(people: DataFrame, evidence: DataFrame, ascii_only: bool) -> DataFrame:
    """A row for each distinct name of a domain and pattern that give a published address."""
    return _made(people, ascii_only).join(_given(evidence), ["domain", "local"])


def matched_evidence(people: DataFrame, evidence: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(domain, email, pos): the published addresses that some name and pattern give, a row for each."""
    made = _made(people, ascii_only).select("domain", "local").distinct()
    return _given(evidence).join(made, ["domain", "local"], "left_semi").select("domain", "email", F.col("email_pos").alias("pos")).distinct()


def proof_gate(proposed: DataFrame, people: DataFrame, evidence: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Proposed (domain, pattern) that reproduce a published address for some name, with the first such address."""
    tokens = people.select("domain", "name").distinct().select("domain", names.name_tokens(F.col("name"), ascii_only).alias("tokens"))
    made = proposed.join(tokens, "domain").withColumn("email", names.build_email(F.col("pattern"), F.col("tokens"), F.lit("x"))).where("email is not null")
    given = evidence.select("domain", F.concat(F.split("email", "@")[0], F.lit("@x")).alias("email"), F.col("email").alias("published"), "pos").hint("merge")
    return made.join(given, ["domain", "email"]).groupBy("domain", "pattern").agg(F.min_by("published", "pos").alias("source"))


def upsert_store(prior: DataFrame, learned: DataFrame) -> DataFrame:
    """The stored patterns with those learned now in place of older ones."""
    return prior.join(learned.select("domain"), "domain", "left_anti").unionByName(learned)


def distribution(store: DataFrame) -> DataFrame:
    return store.groupBy("pattern", "confidence").agg(F.count("*").alias("n"))
