"""Registered queries over the test tables, each with the SQL that checks it."""

from suite import aggregates, columns, files, filters, joins, questions, streams, tables  # noqa: F401
from suite.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
