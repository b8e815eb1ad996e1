"""Query registry."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedhouse.catalog.relations import with_relations

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query. `sql` may use the relations of `relations.py` by name."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Stamps compare as UTC, whatever zone the given session was started with.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        ORACLE[name] = with_relations(sql)
        return fn

    return register
