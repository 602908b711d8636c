"""People: merge of duplicates, and upsert into the master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import person_key


def dedupe_people(raw: DataFrame, group: str = "domain", order: str = "pos") -> DataFrame:
    """One row for each person of a group: (group, person_key, name, title, email, source_url).

    The longest name and title win, the first of equal length; the first address comes with the page
    that carried it, and without an address the first page stays.  Empty names go.  Everything is an
    aggregate with partial results, so no group is gathered anywhere.
    """
    keyed = raw.withColumn("person_key", person_key(F.col("name"))).where(F.coalesce(F.col("person_key"), F.lit("")) != "")
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    longest = lambda c: F.max_by(filled(c), F.when(filled(c).isNotNull(), F.struct(F.length(c), -F.col(order), F.col(c))))
    first_email = F.min_by(F.struct("email", "source_url"), F.when(filled("email").isNotNull(), F.struct(order, "email", "source_url")))
    first_source = F.min_by("source_url", F.when(F.col("source_url").isNotNull(), F.struct(order, "source_url")))
    merged = keyed.groupBy(group, "person_key").agg(longest("name").alias("name"), longest("title").alias("title"), first_email.alias("_e"), first_source.alias("_s"))
    return merged.select(group, "person_key", "name", "title", F.col("_e.email").alias("email"), F.coalesce("_e.source_url", "_s").alias("source_url"))


def upsert_people(master: DataFrame, incoming: DataFrame, stamp, keys: tuple[str, ...] = ("domain", "person_key")) -> DataFrame:
    """Master rows updated by incoming ones, and new ones added, with ``change`` (added, updated, same).

    A new title or address wins where there is one; the page follows the address; ``updated_at`` moves
    only when something changed.  Both sides hold a key once.
    """
    old, new = master.alias("o"), incoming.alias("n")
    is_new = F.col(f"o.{keys[0]}").isNull()
    said = lambda c: F.coalesce(F.col(f"n.{c}"), F.lit("")) != ""
    differs = lambda c: said(c) & ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    seen = F.col(f"n.{keys[0]}").isNotNull()
    changed = seen & ~is_new & (differs("title") | differs("email"))
    joined = old.join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    newer = lambda c: F.when(said(c), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    return joined.select(
        *[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], F.coalesce("o.name", "n.name").alias("name"), newer("title"), newer("email"),
        F.when(is_new | differs("email"), F.col("n.source_url")).otherwise(F.col("o.source_url")).alias("source_url"),
        F.when(is_new | changed, stamp).otherwise(F.col("o.updated_at")).alias("updated_at"),
        F.when(is_new, "added").when(changed, "updated").otherwise("same").alias("change"))
