"""What was loaded before: new rows, skipped rows, checkpoint.

Staged rows lie in folders by the first digits of their hash, more digits the larger the load that wrote them. Hashes of
a feed are sent to the staged ones, a range of digits at a time where they are many, and each time only the folders of
those digits are read: staging never moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.functions.times import iso_stamp
from feedhouse.session import scratch_path

DIGITS = "0123456789abcdef"
# Memory for one broadcast hash: 64 characters and the row around them. Hashes of a feed are sent in parts of this many.
HASH_BYTES = 128
PART_BYTES = 64 * 1024 * 1024
# Staged rows per folder of a load, above which it takes another digit, up to two.
FOLDER_ROWS = 2_000_000
DEEPEST = 2
PREFIX = "hash_prefix"


def prefix_digits(rows: int, folder_rows: int = FOLDER_ROWS) -> int:
    """Digits that a load of so many rows lays its staged rows out by."""
    return next((d for d in range(DEEPEST) if rows <= folder_rows * 16**d), DEEPEST)


def hash_prefix(source_hash: Column, digits: int) -> Column:
    """The folder of a hash: a mark, then its first digits."""
    return F.concat(F.lit("x"), F.substring(source_hash, 1, digits)) if digits else F.lit("x")


def _folders(prefixes: list[str]) -> list[str]:
    """All folders that can hold a hash with one of these first digits."""
    return sorted({"x" + p[:d] for p in prefixes for d in range(DEEPEST + 1)})


def loaded_hashes(staging: DataFrame | None) -> DataFrame | None:
    """Hashes of staging and the folders they are in, one column read; None for a first load."""
    if staging is None:
        return None
    return staging.select("source_hash", *[c for c in (PREFIX,) if c in staging.columns])


def staged_among(
    hashes: DataFrame, staged: DataFrame, rows: int | None = None, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The distinct `_sourceHash` of a feed that are staged (`source_hash`).

    `rows` bounds the number of feed hashes. Without it, or where even a 256th of them is too large to be sent, both sides
    meet by shuffle.
    """
    found = staged.withColumnRenamed("source_hash", "_sourceHash")
    parts = None if rows is None else max(1, -(-rows * HASH_BYTES // part_bytes))
    # Parts are even up to chance; a part takes 16 * 16 / parts pairs of digits.
    if parts is None or parts > 64:
        return found.select("_sourceHash").join(hashes, "_sourceHash", "left_semi").distinct()
    distinct = hashes.distinct()
    if PREFIX not in staged.columns:
        return found.join(F.broadcast(distinct), "_sourceHash", "left_semi").select("_sourceHash").distinct()
    pair = F.substring("_sourceHash", 1, DEEPEST)
    if parts == 1:
        # At most 256 pairs; a feed of a few rows has few, and reads few folders.
        pairs = sorted(r[0] for r in distinct.select(pair.alias("p")).distinct().collect())
        near = found.where(F.col(PREFIX).isin(_folders(pairs)))
        return near.join(F.broadcast(distinct), "_sourceHash", "left_semi").select("_sourceHash").distinct()
    # One part after the other, so that one broadcast at a time is held.
    every = [a + b for a in DIGITS for b in DIGITS]
    path = scratch_path(staged.sparkSession, "staged-hashes")
    size = -(-len(every) // (2 * parts))
    for first in range(0, len(every), size):
        pairs = every[first : first + size]
        own = distinct.where(pair.between(pairs[0], pairs[-1]))
        near = found.where(F.col(PREFIX).isin(_folders(pairs)))
        near.join(F.broadcast(own), "_sourceHash", "left_semi").select("_sourceHash").write.mode("append").parquet(path)
    return staged.sparkSession.read.schema("_sourceHash string").parquet(path).distinct()


def new_rows(enriched: DataFrame) -> DataFrame:
    """Rows whose hash is not in history. Dirty rows and repeats inside the batch stay."""
    return enriched.where(~F.col("_loaded"))


def skipped_rows(enriched: DataFrame) -> DataFrame:
    return enriched.where("_loaded")


def last_checkpoint(runs: DataFrame) -> DataFrame:
    """The latest run that ended well, as the stamps a next run would log; nulls when there is none."""
    done = runs.where(F.col("status").isin("success", "partial"))
    latest = done.agg(F.max(F.struct("started_at", "run_id")).alias("last"))
    return latest.select(
        iso_stamp(F.col("last.started_at")).alias("last_successful_run"), F.col("last.run_id").alias("last_run_id")
    )
