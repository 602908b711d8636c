"""Dear calls in rounds: so many at a time, each round written before a meter is read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import files
from ..sources.providers import Service, may_go_on
from ..sources.shared import keep
from .ledger import pending

Meter = Callable[[], float | None]


def ask_in_rounds(requests: DataFrame, service: Service, path: str, key: str, order: str, fields: str, meter: Meter, size: int = 100, stop_at: float = 90, limit: int | None = None) -> tuple[int, bool]:
    """Ask for every key of ``requests`` that the ledger at ``path`` has no good answer of; (rounds asked, whether the meter stopped it).

    A round is the first ``size`` of what is left, by ``order``; its answers are in the ledger before the meter, in per cent, is
    read again, and a meter at ``stop_at`` or one that can't be read lets no round begin.  The next run goes on
    with what is left.  A key that fails is asked once in a run, and again in the next.  ``limit`` bounds the keys of this run.
    ``service`` adds ``fields`` and error; the ledger keeps key, fields, error and ``asked``, the round's number in its run.
    """
    spark, kind = requests.sparkSession, requests.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, {fields}, error string, asked int"
    names = [c.strip().split()[0] for c in fields.split(",")]
    begun = files.read_ledger(spark, path, schema).select(key, "error")
    left = pending(requests, begun, key, F.col("error").isNotNull())
    # What this run asks for is fixed when it begins, so a failed key doesn't come back in it.
    todo = keep(left.orderBy(order).limit(limit) if limit is not None else left, "to-ask")
    asked, after = 0, None
    while True:
        rest = todo if after is None else todo.where(F.col(order) > F.lit(after))
        batch = keep(rest.orderBy(order).limit(size), "round")
        last = batch.agg(F.max(order)).first()[0]
        if last is None:
            return asked, False
        if not may_go_on(meter(), stop_at):
            return asked, True
        files.append_ledger(service(batch).select(key, *names, "error", F.lit(asked).alias("asked")), path)
        asked, after = asked + 1, last
