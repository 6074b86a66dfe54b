"""Operators for preparing training data. Nothing outside this package imports it."""

from chainstrata.llm.queries import QUERIES, SQL  # noqa: F401
