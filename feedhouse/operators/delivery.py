"""Delivery outcomes from an attempt log.

The log has one row per attempt: a customer key column, `attempt` (1, 2, ...), `status` (HTTP status, null
for a network error), and optionally `error` (text) and `response_id`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.fixed import BACKOFF_MS, BATCH_SIZE, DELIVERY_ATTEMPTS
from feedhouse.functions.nested import record_json
from feedhouse.functions.numbers import count_where
from feedhouse.operators.ranks import dense_numbers
from feedhouse.sources.tables import settle


def is_success(status: Column) -> Column:
    return F.coalesce(status.between(200, 299), F.lit(False))


def is_retryable(status: Column) -> Column:
    """429, 5xx, and network errors."""
    return status.isNull() | (status == 429) | (status >= 500)


def status_text(status: Column) -> Column:
    return F.when(status.isNull(), F.lit("network error")).otherwise(F.concat(F.lit("HTTP "), status.cast("string")))


def backoff_ms(attempt: Column) -> Column:
    """Wait after a failed attempt that is tried again."""
    return (F.lit(BACKOFF_MS) * F.pow(F.lit(2), attempt - 1)).cast("bigint")


def delivery_outcomes(
    attempts: DataFrame, keys: Sequence[str] = ("email",), limit: int = DELIVERY_ATTEMPTS
) -> DataFrame:
    """One outcome per customer, as if the attempts were made in order until one ends the matter.

    A success ends it, so does an error that is not retryable, and so does the last allowed attempt.
    `attempts` is the successful attempt, or the limit on failure; `attempts_made` is the real number.
    All figures are partial aggregates, so a customer with any share of the log is one record per task.
    """
    status = F.col("status")
    ok = is_success(status)
    stop = ~ok & ~is_retryable(status)
    error = F.col("error") if "error" in attempts.columns else status_text(status)
    response = F.col("response_id") if "response_id" in attempts.columns else F.lit(None).cast("string")
    place = F.col("attempt")

    found = attempts.where(place.between(1, limit)).groupBy(*keys).agg(
        F.min(F.when(ok, place)).alias("_ok"),
        F.min(F.when(stop, place)).alias("_stop"),
        F.max(place).alias("_last"),
        F.min_by(F.struct(error.alias("error")), F.when(stop, place)).alias("_stopError"),
        F.max_by(F.struct(error.alias("error")), F.when(~ok, place)).alias("_lastError"),
        F.min_by(F.struct(response.alias("id")), F.when(ok, place)).alias("_response"),
    )
    delivered = F.col("_ok").isNotNull() & (F.col("_stop").isNull() | (F.col("_ok") < F.col("_stop")))
    made = F.when(delivered, F.col("_ok")).otherwise(F.coalesce("_stop", "_last")).cast("int")
    return found.select(
        *keys,
        F.when(delivered, "success").otherwise("failed").alias("status"),
        F.when(delivered, F.col("_ok")).otherwise(limit).cast("int").alias("attempts"),
        made.alias("attempts_made"),
        F.when(~delivered, F.coalesce("_stopError.error", "_lastError.error")).alias("error"),
        F.when(delivered, F.col("_response.id")).alias("response_id"),
        (F.lit(BACKOFF_MS) * (F.pow(F.lit(2), made - 1) - 1)).cast("bigint").alias("waited_ms"),
    )


def last_per_email(outcomes: DataFrame, order: str) -> DataFrame:
    """The result that counts for an email that was sent more than once: the last one by `order`."""
    return outcomes.groupBy("email").agg(
        F.max_by("status", order).alias("status"), F.max_by("attempts", order).alias("attempts")
    )


def delivery_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count(F.lit(1)).alias("total"),
        count_where(F.col("status") == "success").alias("success"),
        count_where(F.col("status") == "failed").alias("failed"),
    )


def _cut(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of rows of one batch: `batch_id`, `first` place, `payloads`. Rows come in order of place."""
    schema = pa.schema([("batch_id", pa.int64()), ("first", pa.int64()), ("payloads", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, held = None, 0, []
        for batch in batches:
            rows = []
            for place, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (place - 1) // size != number:
                    if held:
                        rows.append((number, first, held))
                    number, first, held = (place - 1) // size, place, []
                held.append(payload)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip((number, first, held), schema.types)], schema=schema)

    return run


def payload_batches(customers: DataFrame, order: str = "_rowNumber", size: int = BATCH_SIZE) -> DataFrame:
    """Customer objects as JSON, `size` per batch in row order; the last batch may be short.

    Payloads are sorted into ranges once, and batches are cut where they lie. Only batches that lie on two tasks, two a
    task at most, meet by shuffle.
    """
    fields = [c for c in customers.columns if not c.startswith("_")]
    payloads = customers.select(order, record_json(fields).alias("payload"))
    numbered = dense_numbers(payloads, order, "_place", "payloads").select("_place", "payload")
    cut = settle(numbered.mapInArrow(_cut(size), "batch_id bigint, first bigint, payloads array<string>"), "batches").frame
    whole = F.size("payloads") == size
    parts = cut.where(~whole).groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("first", "payloads"))).alias("_parts"))
    joined = parts.select("batch_id", F.flatten("_parts.payloads").alias("payloads"))
    return cut.where(whole).select("batch_id", "payloads").unionByName(joined)
