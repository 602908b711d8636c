"""Stages composed from the operators, and the registered queries with their SQL."""

from . import decide_queries, ledger_queries, name_queries, page_queries, source_queries, stage_queries, stream_queries  # noqa: F401  registers the queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
