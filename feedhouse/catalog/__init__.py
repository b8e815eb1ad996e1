"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from feedhouse.catalog import analytics, delivery, feed, mapping, quality, warehouse  # noqa: F401
from feedhouse.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
