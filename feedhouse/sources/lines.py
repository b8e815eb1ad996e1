"""Line scan of feed files and exact row numbers without a global order.

A landed table keeps, for each line, the file and the block (input split) it came from. One task reads
one block front to back and writes it to one Parquet file, so the row index of that file gives the
place of a line inside its block; a running sum over blocks gives the rest. No row is sorted or moved.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from feedhouse.functions.text import is_blank
from feedhouse.session import scratch_path
from feedhouse.sources.tables import BROADCAST_BYTES, Settled, row_bytes, settle


def scan_lines(reader: DataFrameReader | DataStreamReader, paths: str | list[str]) -> DataFrame:
    """Non-blank lines with their file and block; LF, CRLF and CR end a line."""
    return (
        reader.text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_sourceFile"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
        .where(~is_blank(F.col("value")))
    )


@dataclass
class Landing:
    """Landed lines with `_sourceFile`, `_block`, `_line` and one entry per block."""

    lines: DataFrame
    blocks: Settled


def land_lines(
    spark: SparkSession,
    paths: str | list[str],
    parse: Callable[[DataFrame], DataFrame] | None = None,
    target: str | None = None,
) -> Landing:
    """Write the scanned lines to Parquet, parsed into columns when `parse` is given."""
    target = target or scratch_path(spark, "landing")
    lines = scan_lines(spark.read, paths)
    lines = parse(lines) if parse else lines
    lines.write.option("maxRecordsPerFile", 0).parquet(f"{target}/lines")
    return open_landing(spark, [f"{target}/lines"], f"{target}/blocks")


def open_landing(spark: SparkSession, lines_paths: list[str], blocks_path: str | None = None) -> Landing:
    """Landed lines of some folders or files; the block table is written anew."""
    lines = spark.read.parquet(*lines_paths).withColumn("_line", F.col("_metadata.row_index"))
    blocks = lines.groupBy("_sourceFile", "_block").agg(
        F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_count")
    )
    # The windows below hold blocks, not lines.
    earlier = Window.partitionBy("_sourceFile").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_sourceFile",
        "_block",
        "_count",
        (F.coalesce(F.sum("_count").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return Landing(lines, settle(
        starts, "blocks", blocks_path, lines=F.sum("_count"), size=F.sum(row_bytes(starts))
    ))


def file_sizes(landing: Landing) -> DataFrame:
    return landing.blocks.frame.groupBy("_sourceFile").agg(F.sum("_count").alias("lines"))


def head_lines(landing: Landing) -> DataFrame:
    """The first line of each file, read from the blocks that can hold one."""
    firsts = landing.blocks.frame.groupBy("_sourceFile").agg(F.min("_block").alias("_block"))
    bound = firsts.agg(F.max("_block")).first()[0] or 0
    heads = Landing(landing.lines.where(F.col("_block") <= bound), landing.blocks)
    return number_lines(heads).where(F.col("_rowNumber") == 1)


def number_lines(landing: Landing) -> DataFrame:
    """Add `_rowNumber` (1-based in its file) and `_rowOrder` (a struct: file, then row number).

    Further columns of the block table come along.
    """
    starts = landing.blocks.frame.drop("_count")
    # One row per input split: some 200 MB for 100 TB of text in splits of 128 MB.
    if landing.blocks.fits(BROADCAST_BYTES):
        starts = F.broadcast(starts)
    number = F.col("_line") + F.col("_shift")
    keep = [c for c in landing.lines.columns if c not in ("_block", "_line")]
    keep += [c for c in starts.columns if c not in ("_sourceFile", "_block", "_shift")]
    return landing.lines.join(starts, ["_sourceFile", "_block"]).select(
        *keep,
        number.alias("_rowNumber"),
        F.struct(F.col("_sourceFile").alias("file"), number.alias("row")).alias("_rowOrder"),
    )
