"""Helpers shared by the operators: settled tables, Arrow passes, and the package on the executors."""

from __future__ import annotations

import ctypes
import io
import os
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.session import delete_path, scratch_path

# Bytes that separate words: space and the five control characters from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Spark removes the shuffle files of a query when it ends, and not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SETTLED: ContextVar[list[str] | None] = ContextVar("settled", default=None)
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back, which cuts its lineage and frees its shuffles."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    written = _SETTLED.get()
    if written is not None:
        written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def drop(*settled: DataFrame) -> None:
    """Delete tables that `settle` has written; frames that still read them become unusable."""
    for df in settled:
        path = _PATHS.pop(df, None)
        if path:
            delete_path(df.sparkSession, path)


def settle_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What `make` returns, settled; the tables settled on the way to it are deleted."""
    written: list[str] = []
    token = _SETTLED.set(written)
    try:
        out = settle(make(), label)
    finally:
        _SETTLED.reset(token)
    for path in written[:-1]:
        delete_path(out.sparkSession, path)
    outer = _SETTLED.get()
    if outer is not None:
        outer.append(written[-1])
    return out


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors once a session, by way of the shared folder, so that tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_feedhouse_shipped", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'code')}.zip")
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(place.toString())
    context._feedhouse_shipped = True


_OF_TASK: list[dict] = []


def of_task(table: dict) -> dict:
    """A table that holds what a task has worked out; it is emptied when the task ends."""
    _OF_TASK.append(table)
    return table


def free_task() -> None:
    """Empty the tables of the task and give its memory back, since workers live on between tasks."""
    for table in _OF_TASK:
        table.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def arrow_pass(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """`mapInArrow` with the package at hand on the executors, and nothing left behind in them."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            free_task()

    return df.mapInArrow(run, schema)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that Python objects are made of few texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# Bitmaps of 4 KB that are sent to all tasks; more of them meet the rows by shuffle.
SENT_BITMAPS = 1 << 14


def marked(rows: DataFrame, ids: DataFrame, name: str = "rid") -> DataFrame:
    """`rows` plus `_marked`: whether their number `name`, 0 or more, is among those of the one column of `ids`.

    The ids become bitmaps, a bit a number and 4 KB for each stretch of 32,768 numbers that has any of them. These go to
    all tasks, so the rows stay where they lie, and only those that are wanted need to move.
    """
    bits = ids.toDF("_id").groupBy(F.bitmap_bucket_number("_id").alias("_stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits"))
    if bits.count() <= SENT_BITMAPS:
        bits = F.broadcast(bits)
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(bitmap_bit_position({name}) div 8 as int) + 1, 1)")), 16, 10)
    bit = F.expr(f"cast(bitmap_bit_position({name}) % 8 as int)")
    found = F.coalesce(F.getbit(byte.cast("int"), bit) == 1, F.lit(False))
    return rows.join(bits, F.bitmap_bucket_number(name) == F.col("_stretch"), "left").withColumn(
        "_marked", found).drop("_stretch", "_bits")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id is taken as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(taken: Iterable[str], name: str) -> str:
    """`name`, or a variant of it that no column bears yet, whatever its case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def shared_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
