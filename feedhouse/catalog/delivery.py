"""Delivery outcomes, run log, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.catalog import relations as rel
from feedhouse.catalog.feed import parsed_lines
from feedhouse.catalog.mapping import mapped_feed, number_rule
from feedhouse.catalog.quality import enriched_feed
from feedhouse.catalog.registry import query
from feedhouse.catalog.warehouse import end_stamp
from feedhouse.fixed import DEFAULT_MAPPING
from feedhouse.functions.times import elapsed_ms
from feedhouse.operators import delivery, history, rules, runs
from feedhouse.operators.mapping import map_rows
from feedhouse.sources.records import parse_summary, split_malformed


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.delivery_outcomes(rel.delivery_attempts(spark, sf_dir), ["name", "email"])


@query("delivery_outcome", """
    select name, email, status, cast(attempts as integer) as attempts, cast(made as integer) as attempts_made, error,
      response_id, cast(case made when 1 then 0 when 2 then 500 else 1500 end as bigint) as waited_ms
    from delivery_outcomes""")
def delivery_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(spark, sf_dir)


@query("delivery_summary", """
    select count(*) as total, count(*) filter (where status = 'success') as success,
      count(*) filter (where status = 'failed') as failed from delivery_outcomes""")
def delivery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.delivery_summary(outcomes(spark, sf_dir))


@query("delivered_customers", "select name, email, response_id as id from delivery_outcomes where status = 'success'")
def delivered_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.delivered_customers(outcomes(spark, sf_dir))


@query("payload_batches", """
    select (place - 1) // 5 as batch_id, string_agg(payload, '|' order by place) as payloads, count(*) as n
    from (select row_number() over (order by row_number) as place,
            cast(json_object('name', name, 'email', email) as varchar) as payload from mapped_feed) x
    group by 1""")
def payload_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = delivery.payload_batches(mapped_feed(spark, sf_dir).customers.select("_rowNumber", "name", "email"))
    return batches.select(
        "batch_id", F.array_join("payloads", "|").alias("payloads"), F.size("payloads").cast("bigint").alias("n")
    )


# --- run log ------------------------------------------------------------------------------------


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end events. Every seventh run is started a second time, which must change nothing."""
    log = rel.pipeline_runs(spark, sf_dir)
    g = F.substring("run_id", 5, 9).cast("int")
    start = log.select(
        "run_id", F.lit(0).alias("event_seq"), "pipeline_version", "source_file", "started_at",
        F.lit("running").alias("status"), F.lit(0).cast("bigint").alias("records_parsed"),
        F.lit(0).cast("bigint").alias("records_api_success"),
    )
    again = start.where(g % 7 == 0).withColumns(
        {"started_at": F.col("started_at") + F.expr("interval 1 hour"), "source_file": F.lit("again.csv")}
    )
    end = log.where(F.col("status") != "failed").select(
        "run_id", F.lit(1).alias("event_seq"), end_stamp().alias("completed_at"), "execution_time_ms",
        "records_parsed", "records_api_success", "success_rate", "status",
    )
    fail = log.where(F.col("status") == "failed").select(
        "run_id", F.lit(1).alias("event_seq"), end_stamp().alias("completed_at"), "execution_time_ms",
        "status", F.concat(F.lit("stopped "), "run_id").alias("error_message"),
    )
    union = start.unionByName(again)
    for part in (end, fail):
        union = union.unionByName(part, allowMissingColumns=True)
    return union


@query("run_log_update", """
    select run_id, pipeline_version, source_file, started_at,
      started_at + execution_time_ms * interval 1 millisecond as completed_at, execution_time_ms,
      case when status = 'failed' then 0 else records_parsed end as records_parsed,
      case when status = 'failed' then 0 else records_api_success end as records_api_success,
      case when status <> 'failed' then success_rate end as success_rate, status,
      case when status = 'failed' then 'stopped ' || run_id end as error_message
    from pipeline_runs""")
def run_log_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.fold_events(run_events(spark, sf_dir))


@query("run_duration", "select run_id, execution_time_ms as elapsed_ms from pipeline_runs")
def run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = rel.pipeline_runs(spark, sf_dir).withColumn("completed_at", end_stamp())
    return log.select("run_id", elapsed_ms(F.col("started_at"), F.col("completed_at")).alias("elapsed_ms"))


@query("last_checkpoint", """
    select strftime(started_at, '%Y-%m-%dT%H:%M:%S.%gZ') as last_successful_run, run_id as last_run_id
    from pipeline_runs where status in ('success', 'partial') order by started_at desc, run_id desc limit 1""")
def last_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.last_checkpoint(rel.pipeline_runs(spark, sf_dir))


# --- metrics and reports ------------------------------------------------------------------------

# Transform errors come from a Python rule on postal codes of the valid rows.
_CHECKED = "select * from checked_feed where ((row_number - 2) // 2) % 59 <> 0"
_TRANSFORM_SQL = f"select row_number, postal_code from ({_CHECKED}) c where errors = '' and postal_code = 'n/a'"


def parsed_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(parsed lines, rows, parse errors)"""
    parsed = parsed_lines(spark, sf_dir)
    return parsed, *split_malformed(parsed, rel.FEED_FIELDS)


def transform_errors(valid: DataFrame) -> DataFrame:
    config = {
        "fieldMappings": {"code": {"from": "postal_code", "transform": "number"}},
        "transforms": {**DEFAULT_MAPPING["transforms"], "number": number_rule()},
    }
    return map_rows(valid, config, rel.RUN_AT, on_error="reject").errors


@query("run_metrics", f"""
    select f.n as records_in_file, p.n as records_parsed, p.valid as records_valid, p.n - p.valid as records_invalid,
      i.n as records_new, i.clean as records_loaded, d.n as records_api_sent, d.ok as records_api_success,
      d.n - d.ok as records_api_failed, f.n - p.n as parse_error_count,
      floor(d.ok / p.n * 10000 + 0.5) / 100 as success_rate,
      case when d.n = d.ok then 'success' else 'partial' end as status
    from (select count(*) as n from customer_feed) f,
      (select count(*) as n, count(*) filter (where errors = '') as valid from ({_CHECKED}) c) p,
      (select count(*) filter (where not loaded) as n, count(*) filter (where not loaded and issues = '') as clean
       from issue_feed) i,
      (select count(*) as n, count(*) filter (where status = 'success') as ok from delivery_outcomes) d""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, rows, _ = parsed_rows(spark, sf_dir)
    new = history.new_rows(enriched_feed(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("records_new"), F.count(F.when(F.col("_isClean"), 1)).alias("records_loaded")
    )
    rates = delivery.delivery_summary(outcomes(spark, sf_dir))
    return runs.run_metrics(
        parse_summary(parsed, rel.FEED_FIELDS),
        rules.validation_summary(rules.validate(rows)),
        new,
        rates,
    )


@query("report_summary", f"""
    select f.n as total_rows_in_file, p.n as successfully_parsed, p.valid as passed_validation,
      p.n - p.valid as failed_validation, p.valid as sent_to_api, d.ok as api_success, d.n - d.ok as api_failed,
      d.ok as overall_success, p.n - p.valid + d.n - d.ok + t.n as overall_failed
    from (select count(*) as n from customer_feed) f,
      (select count(*) as n, count(*) filter (where errors = '') as valid from ({_CHECKED}) c) p,
      (select count(*) as n, count(*) filter (where status = 'success') as ok from delivery_outcomes) d,
      (select count(*) as n from ({_TRANSFORM_SQL}) t) t""")
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, rows, _ = parsed_rows(spark, sf_dir)
    validated = rules.validate(rows)
    return runs.report_summary(
        parse_summary(parsed, rel.FEED_FIELDS),
        rules.validation_summary(validated),
        transform_errors(rules.valid_rows(validated)),
        delivery.delivery_summary(outcomes(spark, sf_dir)),
    )


@query("error_union", f"""
    select 'parse' as stage, 'Row ' || row_number || ': column count mismatch (expected 11, got 9)' as message,
      cast(null as bigint) as row_number, cast(null as varchar) as company, '' as errors,
      cast(null as varchar) as error, cast(null as integer) as attempts
    from customer_feed where ((row_number - 2) // 2) % 59 = 0
    union all
    select 'validation', null, row_number, case when company_name = '' then '(unknown)' else company_name end, errors,
      null, null
    from ({_CHECKED}) c where errors <> ''
    union all
    select 'transform', null, row_number, null, '', 'not a number: ' || postal_code, null from ({_TRANSFORM_SQL}) t
    union all
    select 'api', null, null, name, '', error, cast(attempts as integer) from delivery_outcomes where status = 'failed'
    """)
def error_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows, parse_errors = parsed_rows(spark, sf_dir)
    validated = rules.validate(rows)
    union = runs.error_union(
        parse_errors,
        rules.invalid_rows(validated),
        transform_errors(rules.valid_rows(validated)),
        outcomes(spark, sf_dir),
    )
    return union.withColumn("errors", F.concat_ws("; ", "errors"))


