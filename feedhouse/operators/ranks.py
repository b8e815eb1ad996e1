"""Running numbers over a whole frame, without putting it in one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedhouse.sources.tables import settle


def dense_numbers(df: DataFrame, order: str, name: str, label: str = "ranks") -> DataFrame:
    """Add `name` = 1, 2, 3 ... in the order of the unique column `order`.

    Rows are range-partitioned and sorted, then written once: range bounds are sampled, so a second
    evaluation could cut differently. The written row index plus the sizes of the earlier partitions
    (one small row per partition) give the number.
    """
    part = F.spark_partition_id().alias("_part")
    ordered = df.repartitionByRange(order).sortWithinPartitions(order).select("*", part)
    settled = settle(ordered, label)
    numbered = settled.frame.withColumn("_index", F.col("_metadata.row_index"))
    sizes = settled.frame.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    return numbered.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_index") + 1).cast("bigint").alias(name)
    )


def growing_key(first_free: int) -> Column:
    """A key for rows about to be written: unique, above all earlier keys, with gaps between tasks.

    Settled once the rows are written. 2^33 numbers go to each task, which leaves room for ten thousand
    loads of a hundred thousand tasks.
    """
    return F.monotonically_increasing_id() + F.lit(first_free)
