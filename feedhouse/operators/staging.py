"""Staging rows: insert-or-ignore by content hash."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.fixed import STAGING_COLUMNS, STAGING_LENGTHS
from feedhouse.functions.nested import json_text
from feedhouse.functions.text import empty_to_null
from feedhouse.functions.times import stamp_literal
from feedhouse.operators.quality import field_or_null
from feedhouse.operators.spread import key_counts, lookup, settle_keyed
from feedhouse.sources.tables import BROADCAST_BYTES

# Memory for one broadcast run: its id, a stamp and the row around them.
RUN_BYTES = 256


def insertable(columns: Sequence[str]) -> Column:
    """Whether staging takes a feed row: no value is too long for its column."""
    fits = [F.char_length(field_or_null(columns, f)) <= STAGING_LENGTHS[t]
            for f, t in STAGING_COLUMNS.items() if t in STAGING_LENGTHS]
    if "_sourceFile" in columns:
        fits.append(F.char_length("_sourceFile") <= STAGING_LENGTHS["source_file"])
    return reduce(and_, [F.coalesce(x, F.lit(True)) for x in fits])


def staging_rows(
    enriched: DataFrame, run_id: str | Column, run_at: dt.datetime, version: str = "1.0.0", source_file: str | None = None
) -> DataFrame:
    """Rows to append. The first row of each hash that is not staged yet is exactly the row that carries
    no duplicate flag and was not met in an earlier file, so no further grouping or join is needed."""
    file = F.lit(source_file) if source_file is not None else F.col("_sourceFile")
    return enriched.where(~F.col("_duplicateRow") & ~F.col("_loaded") & ~F.col("_met")).select(
        file.cast("string").alias("source_file"),
        F.col("_rowNumber").alias("source_row"),
        F.col("_sourceHash").alias("source_hash"),
        (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("pipeline_run_id"),
        stamp_literal(run_at).alias("ingested_at"),
        F.lit(version).alias("pipeline_version"),
        *[empty_to_null(field_or_null(enriched.columns, f)).alias(t) for f, t in STAGING_COLUMNS.items()],
        F.col("_isClean").alias("is_valid"),
        json_text(F.col("_qualityIssues")).alias("quality_issues"),
    )


def with_processed(staging: DataFrame, finished_runs: DataFrame, order: str = "source_hash", **how) -> DataFrame:
    """`is_processed` and `processed_at` from the runs that ended (`run_id`, `processed_at`).

    Derived on reading, so staged files are never rewritten. A run may hold most of the rows.
    """
    done = finished_runs.select(F.col("run_id").alias("pipeline_run_id"), "processed_at")
    if done.count() * RUN_BYTES <= how.get("broadcast_bytes", BROADCAST_BYTES):
        # The log of runs is small; staging is read once and not moved.
        marked = staging.join(F.broadcast(done), "pipeline_run_id", "left").select(*staging.columns, "processed_at")
        return marked.withColumn("is_processed", F.col("processed_at").isNotNull())
    counted = key_counts(staging, "pipeline_run_id").join(done, "pipeline_run_id")
    found = lookup(staging, settle_keyed(counted, "finished-runs"), "pipeline_run_id", order, **how)
    return found.drop("n").withColumn("is_processed", F.col("processed_at").isNotNull())
