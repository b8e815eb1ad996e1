"""Lookup of keyed figures from a large frame whose keys may be very uneven."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.sources.tables import BROADCAST_BYTES, Settled, row_bytes, settle

# A key is hot when its rows outweigh this share of one average shuffle partition.
HOT_SHARE = 0.1

_SALT, _HOT = "_salt", "_hot"


def lookup(
    left: DataFrame,
    keyed: Settled,
    key: str,
    order: str,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """Join `left` to a table with one row per key, settled by `settle_keyed`.

    Its column `n` is the number of left rows with that key. `order` names a column of `left` that differs
    from row to row.

    A table of up to `broadcast_bytes` is broadcast. A larger one is joined by shuffle, with the hot keys taken out: fewer than
    partitions / HOT_SHARE keys can be hot, so those are broadcast, and their left rows, like those without
    a key, are spread by a salt that no other row carries. No row is dropped on either way.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    figures = [c for c in keyed.frame.columns if c != key]
    if keyed.fits(broadcast_bytes):
        return left.join(F.broadcast(keyed.frame), key, how)
    partitions = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1, int((keyed.stats["total"] or 0) / partitions * HOT_SHARE))
    if how == "inner":
        left = left.where(F.col(key).isNotNull())
    if (keyed.stats["largest"] or 0) <= limit and how == "inner":
        return left.join(keyed.frame, key, how)

    hot = keyed.frame.where(F.col("n") > limit).select(key, F.struct(*figures).alias(_HOT))
    # Zero, but not as a literal: the optimizer would fold that out of the join key and undo the spreading.
    cold = keyed.frame.where(F.col("n") <= limit).withColumn(_SALT, F.col("n").cast("bigint").bitwiseAND(F.lit(0)))
    own: Column = F.xxhash64(order).bitwiseOR(F.lit(1))
    tagged = left.join(F.broadcast(hot), key, "left").withColumn(
        _SALT, F.when(F.col(key).isNull() | F.col(_HOT).isNotNull(), own).otherwise(F.lit(0).cast("bigint"))
    )
    joined = tagged.join(cold, [key, _SALT], "left")
    found = joined.select(
        *left.columns, *[F.coalesce(F.col(f"{_HOT}.{c}"), F.col(c)).alias(c) for c in figures]
    )
    return found.where(F.col("n").isNotNull()) if how == "inner" else found


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-null key, combined before the shuffle."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def settle_keyed(df: DataFrame, label: str) -> Settled:
    """Write a table for `lookup`: one row per key, `n` left rows each."""
    return settle(df, label, total=F.sum("n"), largest=F.max("n"), size=F.sum(row_bytes(df)))
