"""JSON text and arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(value: Column) -> Column:
    """JSON with null fields kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def record_json(columns: Sequence[str | Column]) -> Column:
    return json_text(F.struct(*columns))


def json_fields(c: Column, schema: str) -> Column:
    return F.from_json(c, schema)
