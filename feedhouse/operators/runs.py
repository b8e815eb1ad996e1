"""Run log as events, run metrics, error lists and the final report."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import asdict, dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.functions.numbers import half_up
from feedhouse.functions.times import stamp_literal

COUNT_COLUMNS = [
    "records_in_file", "records_parsed", "records_valid", "records_invalid", "records_new",
    "records_loaded", "records_api_sent", "records_api_success", "records_api_failed",
]

EVENT_SCHEMA = (
    "run_id string, event_seq bigint, pipeline_version string, source_file string, started_at timestamp, "
    "completed_at timestamp, execution_time_ms bigint, "
    + ", ".join(f"{c} bigint" for c in COUNT_COLUMNS)
    + ", success_rate decimal(5,2), parse_error_count bigint, status string, error_message string, dq_report string"
)
RUN_COLUMNS = [f.split()[0] for f in EVENT_SCHEMA.split(", ") if not f.startswith("event_seq")]


@dataclass
class RunMetrics:
    records_in_file: int = 0
    records_parsed: int = 0
    records_valid: int = 0
    records_invalid: int = 0
    records_new: int = 0
    records_loaded: int = 0
    records_api_sent: int = 0
    records_api_success: int = 0
    records_api_failed: int = 0
    parse_error_count: int = 0

    @property
    def success_rate(self) -> float:
        """Delivered share of the parsed rows in percent, half up to two places; 0 when none parsed."""
        if not self.records_parsed:
            return 0.0
        return int(self.records_api_success / self.records_parsed * 10000 + 0.5) / 100

    @property
    def status(self) -> str:
        return "partial" if self.records_api_failed else "success"


def events(spark: SparkSession, **values) -> DataFrame:
    """One event as a frame; columns that are not given are null."""
    names = [f.split()[0] for f in EVENT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], EVENT_SCHEMA)


def start_event(spark: SparkSession, run_id: str, source_file: str, at: dt.datetime, version: str) -> DataFrame:
    return events(
        spark, run_id=run_id, event_seq=0, pipeline_version=version, source_file=source_file, started_at=at,
        status="running", parse_error_count=0, **dict.fromkeys(COUNT_COLUMNS, 0),
    )


def _now() -> int:
    """Ends are in the order they were logged in, whatever time a run is given."""
    return time.time_ns() // 1000


def _ended(started_at: dt.datetime, at: dt.datetime) -> dict:
    return {"completed_at": at, "execution_time_ms": int((at - started_at).total_seconds() * 1000)}


def complete_event(
    spark: SparkSession, run_id: str, started_at: dt.datetime, at: dt.datetime, metrics: RunMetrics, dq_report: str
) -> DataFrame:
    return events(
        spark, run_id=run_id, event_seq=_now(), status=metrics.status, dq_report=dq_report,
        success_rate=Decimal(str(metrics.success_rate)), **_ended(started_at, at), **asdict(metrics),
    )


def fail_event(
    spark: SparkSession, run_id: str, started_at: dt.datetime, at: dt.datetime, message: str
) -> DataFrame:
    return events(
        spark, run_id=run_id, event_seq=_now(), status="failed", error_message=message, **_ended(started_at, at)
    )


def file_events(files: DataFrame, **values: Column) -> DataFrame:
    """One event per row of `files`; columns that are not given are null."""
    fields = [f.split(" ", 1) for f in EVENT_SCHEMA.split(", ")]
    return files.select(*[values.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in fields])


def start_events(files: DataFrame, at: dt.datetime, version: str) -> DataFrame:
    """Start events of the runs in `files` (`run_id`, `_sourceFile`)."""
    zero = F.lit(0)
    return file_events(
        files, run_id=F.col("run_id"), event_seq=zero, pipeline_version=F.lit(version), source_file=F.col("_sourceFile"),
        started_at=stamp_literal(at), status=F.lit("running"), parse_error_count=zero,
        **dict.fromkeys(COUNT_COLUMNS, zero),
    )


def _ended_columns(started_at: dt.datetime, at: dt.datetime) -> dict[str, Column]:
    ended = _ended(started_at, at)
    return {"completed_at": stamp_literal(at), "execution_time_ms": F.lit(ended["execution_time_ms"])}


def fail_events(files: DataFrame, started_at: dt.datetime, at: dt.datetime, message: Column) -> DataFrame:
    return file_events(files, run_id=F.col("run_id"), event_seq=F.lit(_now()), status=F.lit("failed"), error_message=message,
                       **_ended_columns(started_at, at))


def complete_events(figures: DataFrame, started_at: dt.datetime, at: dt.datetime) -> DataFrame:
    """End events from one row per run: `run_id`, the counts, `parse_error_count` and `dq_report`."""
    rate = F.when(F.col("records_parsed") > 0, F.floor(
        F.col("records_api_success") / F.nullif("records_parsed", F.lit(0)) * 10000 + 0.5) / 100).otherwise(0.0)
    return file_events(
        figures, run_id=F.col("run_id"), event_seq=F.lit(_now()), dq_report=F.col("dq_report"), success_rate=rate,
        status=F.when(F.col("records_api_failed") == 0, "success").otherwise("partial"),
        **{c: F.col(c) for c in [*COUNT_COLUMNS, "parse_error_count"]}, **_ended_columns(started_at, at),
    )


def fold_events(log: DataFrame) -> DataFrame:
    """Current state of each run: for every column the latest event that sets it.

    A second start of a known run is ignored, so of several start events (`event_seq` 0) the earliest
    counts; of several ends the one logged last. Runs without a start event do not exist.
    """
    begun = F.col("event_seq") == 0
    # Starts sort before ends; among starts the earliest must win, so its order value is the largest.
    started, ended = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("started_at", "completed_at"))
    place = F.when(begun, -started).otherwise(ended)
    rank = F.struct(
        F.when(begun, 0).otherwise(1).alias("kind"), F.when(begun, 0).otherwise(F.col("event_seq")).alias("seq"),
        place.alias("place"))
    columns = [c for c in RUN_COLUMNS if c != "run_id" and c in log.columns]
    state = log.groupBy("run_id").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns],
        F.max(begun).alias("_begun"),
    )
    return state.where("_begun").drop("_begun")


def one_row(**frames: DataFrame) -> DataFrame:
    """One row from frames of one row each, every frame read as one scalar subquery."""
    spark = next(iter(frames.values())).sparkSession
    parts = [frame.select(F.struct("*")).scalar().alias(name) for name, frame in frames.items()]
    return spark.range(1).select(*parts).select(*[f"{name}.*" for name in frames])


def run_metrics(parse: DataFrame, validation: DataFrame, new_rows: DataFrame, delivery: DataFrame) -> DataFrame:
    """The metrics row of a run from its one-row counts; `new_rows` has `records_new` and `records_loaded`."""
    merged = one_row(
        parse=parse.select("rows_in_file", "total_rows", "parse_errors"),
        validation=validation.select("valid", "invalid"),
        new=new_rows.select("records_new", "records_loaded"),
        delivery=delivery.select(F.col("total").alias("sent"), "success", "failed"),
    )
    rate = F.when(
        F.col("total_rows") > 0, half_up(F.col("success") / F.nullif("total_rows", F.lit(0)) * 10000) / 100
    ).otherwise(0.0)
    return merged.select(
        F.col("rows_in_file").alias("records_in_file"),
        F.col("total_rows").alias("records_parsed"),
        F.col("valid").alias("records_valid"),
        F.col("invalid").alias("records_invalid"),
        "records_new",
        "records_loaded",
        F.col("sent").alias("records_api_sent"),
        F.col("success").alias("records_api_success"),
        F.col("failed").alias("records_api_failed"),
        F.col("parse_errors").alias("parse_error_count"),
        rate.cast("double").alias("success_rate"),
        F.when(F.col("failed") == 0, "success").otherwise("partial").alias("status"),
    )


def report_summary(parse: DataFrame, validation: DataFrame, transform_errors: DataFrame, delivery: DataFrame
                   ) -> DataFrame:
    """The nine counts of the final report. `sent_to_api` is the number of valid rows, as published."""
    merged = one_row(
        parse=parse.select("rows_in_file", "total_rows"),
        validation=validation.select("valid", "invalid"),
        transform=transform_errors.agg(F.count(F.lit(1)).alias("transform_errors")),
        delivery=delivery.select("success", "failed"),
    )
    return merged.select(
        F.col("rows_in_file").alias("total_rows_in_file"),
        F.col("total_rows").alias("successfully_parsed"),
        F.col("valid").alias("passed_validation"),
        F.col("invalid").alias("failed_validation"),
        F.col("valid").alias("sent_to_api"),
        F.col("success").alias("api_success"),
        F.col("failed").alias("api_failed"),
        F.col("success").alias("overall_success"),
        (F.col("invalid") + F.col("failed") + F.col("transform_errors")).alias("overall_failed"),
    )


def _named(company: str) -> Column:
    return F.coalesce(F.nullif(F.col(company), F.lit("")), F.lit("(unknown)"))


def error_union(
    parse_errors: DataFrame, invalid: DataFrame, transform_errors: DataFrame, outcomes: DataFrame
) -> DataFrame:
    """Errors of all stages, each with its own fields; the others are null."""
    parts = [
        parse_errors.select(F.lit("parse").alias("stage"), "message"),
        invalid.select(
            F.lit("validation").alias("stage"), F.col("_rowNumber").alias("row_number"),
            _named("company_name").alias("company"), "errors",
        ),
        transform_errors.select(F.lit("transform").alias("stage"), F.col("_rowNumber").alias("row_number"), "error"),
        outcomes.where(F.col("status") == "failed").select(
            F.lit("api").alias("stage"), _named("name").alias("company"), "error", "attempts"
        ),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union


def delivered_customers(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") == "success").select("name", "email", F.col("response_id").alias("id"))
