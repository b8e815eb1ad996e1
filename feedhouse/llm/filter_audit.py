"""How filters interact: what each removes, alone, after others, and on average over all orders.

A document becomes a mask, one bit per filter that it fails. Four filters read the text alone. The fifth, copies, needs
other rows: a counting Bloom prepass finds texts that cannot occur twice. Each task counts its hashes into sparse partial
sketches, partials of a slice of the hash range merge into an array of saturating counters, and the distinct hashes of
each task probe it. A text with a counter below two is unique for certain. Only the texts that remain move, whole, to
find the smallest id of each; copies in one task are combined before that.

Everything after that is additive: rows are counted by part, mask and label, and any order of the filters is a sum over
the 32 masks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.llm.common import SPACE_RUN, arrow_pass, documents, settle, ship_package

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
COPY_BIT = 1 << FILTERS.index("E")
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOL = r"[#$%&*|]"

# A slice of the hash range has so many counters, and each text sets so many of them.
SLICE_CELLS = 1 << 18
CELLS_PER_TEXT = 12
PROBES = 4
# Hashes that a task holds before it hands out a partial sketch.
HELD_HASHES = 1 << 20
# Hashes of possible repeats are sent to all tasks up to so many, 64 MB in memory; beyond that rows meet them by shuffle.
BROADCAST_HASHES = 2_000_000

_NUMBERS = "slice int, hashes binary"
_CELLS = "slice int, cells binary, twice binary"


def text_mask(text: Column) -> Column:
    """The bits of the filters that read the text alone; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACE_RUN), "")
    return F.transform(F.array(words), lambda w: (
        F.when(F.size(w) < MIN_WORDS, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PERCENT * F.size(w), 2).otherwise(0)
    ))[0] + (
        F.when(100 * (F.char_length(text) - F.char_length(F.translate(text, CAPITALS, "")))
               > MAX_CAPITAL_PERCENT * F.char_length(text), 4).otherwise(0)
        + F.when(text.rlike(SYMBOL), 8).otherwise(0)
    )


# --- the counting Bloom prepass -------------------------------------------------------------------------------------


def _cells(hashes: np.ndarray) -> np.ndarray:
    """The counters of each hash in its slice, one row per probe: steps of an odd stride from a start."""
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    start, stride = mixed >> np.uint64(40), (mixed & np.uint64(0xFFFFF)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((start[None, :] + probes * stride[None, :]) % np.uint64(SLICE_CELLS)).astype(np.uint32)


def _slices(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(slices)).astype(np.int32)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterable[np.ndarray]:
    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        n += len(held[-1])
        if n >= HELD_HASHES:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _by_slice(slices: int, hashes: np.ndarray) -> Iterable[tuple[int, slice]]:
    """Runs of equal slices of hashes that are sorted by slice."""
    of = _slices(hashes, slices)
    firsts = np.flatnonzero(np.diff(of, prepend=-1))
    for first, last in zip(firsts, [*firsts[1:], len(of)]):
        yield int(of[first]), slice(first, last)


def _sorted_by_slice(slices: int, hashes: np.ndarray) -> np.ndarray:
    return np.argsort(_slices(hashes, slices), kind="stable")


def _partials(slices: int):
    """Sparse partial sketches: the counters that a task touches, and whether more than once."""
    schema = pa.schema([("slice", pa.int32()), ("cells", pa.binary()), ("twice", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for hashes in _held(batches):
            hashes, counts = np.unique(hashes, return_counts=True)
            order = _sorted_by_slice(slices, hashes)
            hashes, counts = hashes[order], counts[order]
            rows = []
            for number, at in _by_slice(slices, hashes):
                cells, sums = saturated(_cells(hashes[at]), counts[at])
                rows.append({"slice": number, "cells": cells.tobytes(), "twice": np.packbits(sums > 1).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def saturated(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct counters of some hashes, and 1 or 2 for each. A hash that hits a counter by two probes adds once."""
    once = np.sort(cells, axis=0)
    new = np.vstack([np.ones((1, cells.shape[1]), dtype=bool), once[1:] != once[:-1]])
    touched, places = np.unique(once[new], return_inverse=True)
    sums = np.bincount(places, weights=np.broadcast_to(counts, cells.shape)[new], minlength=len(touched))
    return touched.astype(np.uint32), np.minimum(sums, 2).astype(np.uint8)


def _numbers(slices: int):
    """The distinct hashes of a task, by slice."""
    schema = pa.schema([("slice", pa.int32()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for hashes in _held(batches):
            hashes = np.unique(hashes)
            hashes = hashes[_sorted_by_slice(slices, hashes)]
            yield pa.RecordBatch.from_pylist(
                [{"slice": n, "hashes": hashes[at].tobytes()} for n, at in _by_slice(slices, hashes)], schema=schema)

    return run


def _merged(partials: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counters of one slice, two bits' worth each, from all its partial sketches."""
    counters = np.zeros(SLICE_CELLS, dtype=np.uint8)
    number = None
    for batch in partials:
        for row in batch.to_pylist():
            number = row["slice"]
            cells = np.frombuffer(row["cells"], np.uint32)
            twice = np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(cells))
            counters[cells] = np.minimum(counters[cells] + 1 + twice, 2)
    packed = np.concatenate([np.packbits(counters > 0), np.packbits(counters > 1)])
    yield pa.RecordBatch.from_pylist([{"slice": number, "counters": packed.tobytes()}],
                                     schema=pa.schema([("slice", pa.int32()), ("counters", pa.binary())]))


def _probe(numbers: pa.Table, sketches: pa.Table) -> pa.Table:
    """The hashes of a slice whose counters all stand at two."""
    rows = numbers.column("hashes").to_pylist()
    hashes = np.unique(np.concatenate([np.frombuffer(r, np.uint64) for r in rows])) if rows else np.zeros(0, np.uint64)
    if len(hashes) and sketches.num_rows:
        packed = np.frombuffer(sketches.column("counters")[0].as_py(), np.uint8)
        twice = np.unpackbits(packed[len(packed) // 2 :]).astype(bool)
        hashes = hashes[twice[_cells(hashes)].all(axis=0)]
    return pa.table({"h": pa.array(hashes.view(np.int64))})


def possible_repeats(hashed: DataFrame, rows: int) -> DataFrame:
    """Distinct values of the column `h` that may occur twice: all that do, and few that do not.

    `rows` sets the number of slices, so that a slice holds about as many texts whatever the size of the table.
    """
    ship_package(hashed.sparkSession)
    slices = max(1, -(-rows * CELLS_PER_TEXT // SLICE_CELLS))
    only = hashed.select("h")
    sketches = (
        arrow_pass(only, _partials(slices), _CELLS).groupBy("slice").applyInArrow(_merged, "slice int, counters binary"))
    numbers = arrow_pass(only, _numbers(slices), _NUMBERS)
    return numbers.groupBy("slice").cogroup(sketches.groupBy("slice")).applyInArrow(_probe, "h long")


# --- masks ----------------------------------------------------------------------------------------------------------


def first_ids(docs: DataFrame, possible: DataFrame, few: bool) -> DataFrame:
    """h and doc_id of the first row of each text among the possible repeats: the smallest id of exactly that text."""
    held = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = held.withColumn("h", F.xxhash64("text"))
    wanted = F.broadcast(possible) if few else possible
    return (
        held.join(wanted, "h", "left_semi").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
        .where(F.col("doc_id").isNotNull()).select(F.xxhash64("text").alias("h"), "doc_id")
    )


def with_masks(docs: DataFrame, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """doc_id, part, mask of each document. A row without id is no copy, and no row is a copy of it."""
    text = F.coalesce("text", F.lit(""))
    hashed = settle(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"), F.xxhash64(text).alias("h"),
    ), "text-masks")
    possible = settle(possible_repeats(hashed, hashed.count()), "possible-repeats")
    few = possible.count() <= broadcast_hashes
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    firsts = settle(first_ids(docs, possible, few), "first-ids").withColumn("first", F.lit(True))
    again = (F.broadcast(possible) if few else possible).withColumn("again", F.lit(True))
    # Rows of one text spread over their ids, so that a group of many copies does not meet in one task.
    flagged = hashed.join(again, "h", "left").join(firsts, ["h", "doc_id"], "left")
    copy = F.col("again").isNotNull() & F.col("first").isNull() & F.col("doc_id").isNotNull()
    return flagged.select("doc_id", "part", (F.col("mask") + F.when(copy, COPY_BIT).otherwise(0)).alias("mask"))


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: rows, and those that some label row calls good or toxic."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    zero = F.lit(0).cast("bigint")
    return masked.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), zero).alias("good"),
        F.coalesce(F.sum("toxic"), zero).alias("toxic"))


# --- orders ---------------------------------------------------------------------------------------------------------


def orders() -> list[tuple[str, int, int, int]]:
    """Order, step, bits of the filters before the step's, and its own bit."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append(("".join(order), step, before, bit))
            before |= bit
    return out


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from the mask counts of the parts."""
    values = lambda c: F.array(*[
        F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0).cast("bigint")) for m in range(MASKS)])
    per_part = counts.groupBy("part").agg(*[values(c).alias(c) for c in ("n", "good", "toxic")])
    steps = F.array(*[
        F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("before"), F.lit(f).alias("bit"))
        for o, s, b, f in orders()])
    rows = per_part.select("*", F.explode(steps).alias("s")).select("part", "n", "good", "toxic", "s.*")

    def total(column: str, holds) -> Column:
        """Sum over the masks for which `holds`."""
        return F.aggregate(
            F.transform(F.col(column), lambda v, m: F.when(holds(m), v).otherwise(F.lit(0).cast("bigint"))),
            F.lit(0).cast("bigint"), lambda a, v: a + v)

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    there = lambda m: m.bitwiseAND(F.col("before")) == 0
    removed = lambda m: fails(m) & there(m)
    stepped = rows.select(
        "part", "filter_order", "step", "bit",
        total("n", lambda m: there(m) & ~fails(m)).alias("kept"), total("n", removed).alias("removed"),
        total("n", lambda m: fails(m) & ~there(m)).alias("redundant"),
        total("n", lambda m: m == F.col("bit")).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
        # Of the filters that a row fails, each comes first in an equal share of the 120 orders, and that one removes it.
        F.aggregate(
            F.transform("n", lambda v, m: F.when(fails(m), v * (F.lit(120) / F.bit_count(m)).cast("bigint"))
                        .otherwise(F.lit(0).cast("bigint"))),
            F.lit(0).cast("bigint"), lambda a, v: a + v).alias("shapley"),
    )
    return stepped.drop("bit")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part (language), order of the five filters and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley, all zeros included.

    Null text counts as empty, null language as empty text. Rows without id, or with the smallest id of their text, are no
    copies; several rows may bear that id. A document is good or toxic if any of its label rows says so. An empty table
    gives no rows. Columns of `docs` other than doc_id, text and lang are left out.
    """
    return audit(mask_counts(with_masks(docs), labels))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
