"""Incremental runs over appended ledgers."""
