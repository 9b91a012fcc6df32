"""Queries over the given tables, each with SQL that states the same result."""

from tallyfield.catalog.registry import oracle_texts, query_functions

__all__ = ["oracle_texts", "query_functions"]
