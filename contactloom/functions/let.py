"""Values that are worked out once, however often an expression names them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``; a lambda's variable is never inlined again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def with_fields(df: DataFrame, struct: Column) -> DataFrame:
    """``df`` and the fields of ``struct`` as columns.  A generator, so that later filters don't repeat the expression."""
    return df.select("*", F.inline(F.array(struct)))
