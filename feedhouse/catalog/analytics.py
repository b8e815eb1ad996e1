"""The six views and five reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from feedhouse.catalog import relations as rel
from feedhouse.catalog.registry import query
from feedhouse.plans import analytics

AS_OF = dt.date(2001, 8, 1)


def rounded_sql(numerator: str, denominator: str, digits: int) -> str:
    """Round half up in whole numbers; null for a zero denominator."""
    scale = 10**digits
    return (
        f"cast((2 * {scale} * cast({numerator} as hugeint) + {denominator}) // nullif(2 * {denominator}, 0) as double)"
        f" / {scale}"
    )


def percent_sql(part: str, whole: str) -> str:
    return rounded_sql(f"100 * {part}", whole, 2)


_DAILY_SQL = f"""
    select full_date, year, month, month_name, day_name, total_imports, valid_imports, invalid_imports, api_success,
      {percent_sql("api_success", "total_imports")} as daily_success_rate
    from (
      select d.full_date, d.year, d.month, d.month_name, d.day_name, count(import_key) as total_imports,
        count(*) filter (where was_valid) as valid_imports, count(*) filter (where not was_valid) as invalid_imports,
        count(*) filter (where f.api_success) as api_success
      from fact_customer_imports f join dim_import_date d on d.date_key = f.date_key group by all) x"""

_COUNTRY_SQL = f"""
    select country, country_code, region, unique_customers, total_imports, valid_imports,
      {percent_sql("valid_imports", "total_imports")} as validity_rate
    from (
      select coalesce(country_name, 'Unknown') as country, coalesce(country_code, 'XX') as country_code,
        coalesce(region, 'Unknown') as region, count(distinct u.customer_key) as unique_customers,
        count(import_key) as total_imports, count(*) filter (where was_valid) as valid_imports
      from fact_customer_imports f left join dim_customer u on u.customer_key = f.customer_key
        left join dim_country c on c.country_key = f.country_key
      group by country_name, c.country_code, c.region) x"""


@query("run_health", f"""
    select run_id, started_at, strftime(started_at, '%Y-%m-%d') as run_date, source_file, records_in_file,
      records_parsed, records_valid, records_invalid, records_loaded, records_api_success, records_api_failed,
      execution_time_ms, {rounded_sql("execution_time_ms", "1000", 2)} as execution_time_sec, success_rate, status,
      pipeline_version
    from pipeline_runs""")
def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = analytics.run_health(rel.pipeline_runs(spark, sf_dir))
    return analytics.ordered(view, "vw_pipeline_health")


@query("daily_import_volume", _DAILY_SQL)
def daily_import_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, dates = rel.fact_customer_imports(spark, sf_dir), rel.dim_import_date(spark, sf_dir)
    return analytics.ordered(analytics.daily_import_volume(facts, dates), "vw_daily_import_volume")


@query("daily_volume_recent", f"""
    select full_date, total_imports, valid_imports, invalid_imports, daily_success_rate from ({_DAILY_SQL}) v
    where full_date >= date '2001-08-01' - interval 30 day""")
def daily_volume_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, dates = rel.fact_customer_imports(spark, sf_dir), rel.dim_import_date(spark, sf_dir)
    return analytics.recent_daily_volume(facts, dates, AS_OF)


@query("customer_by_country", _COUNTRY_SQL)
def customer_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = analytics.customer_by_country(
        rel.fact_customer_imports(spark, sf_dir), rel.dim_customer(spark, sf_dir), rel.dim_country(spark, sf_dir)
    )
    return analytics.ordered(view, "vw_customer_by_country")


@query("top_countries", f"""
    select country, unique_customers, validity_rate from ({_COUNTRY_SQL}) v
    order by unique_customers desc, country_code limit 10""")
def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_countries(
        rel.fact_customer_imports(spark, sf_dir), rel.dim_customer(spark, sf_dir), rel.dim_country(spark, sf_dir)
    )


@query("validity_summary", f"""
    select import_date, valid_count, invalid_count, total_count,
      {percent_sql("valid_count", "total_count")} as validity_pct
    from (
      select strftime(imported_at, '%Y-%m-%d') as import_date, count(*) filter (where was_valid) as valid_count,
        count(*) filter (where not was_valid) as invalid_count, count(*) as total_count
      from fact_customer_imports group by 1) x""")
def validity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = analytics.validity_summary(rel.fact_customer_imports(spark, sf_dir))
    return analytics.ordered(view, "vw_validity_summary")


@query("company_size_distribution", f"""
    select company_size, customer_count, {percent_sql("customer_count", "total")} as pct_of_total
    from (
      select case when trim(coalesce(company_size, '')) = '' then 'Not Specified' else trim(company_size) end
          as company_size,
        customer_count, cast(sum(customer_count) over () as bigint) as total
      from (select company_size, count(distinct customer_key) as customer_count from dim_customer group by 1) g) x""")
def company_size_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = analytics.company_size_distribution(rel.dim_customer(spark, sf_dir))
    return analytics.ordered(view, "vw_company_size_distribution")


_CENTS = "cast(round(success_rate * 100) as bigint)"


@query("run_success_trend", f"""
    select run_date, total_runs, successful_runs, {rounded_sql("cents", "(rated * 100)", 2)} as avg_success_rate,
      {rounded_sql("ms", "total_runs", 0)} as avg_execution_ms, total_records_loaded
    from (
      select strftime(started_at, '%Y-%m-%d') as run_date, count(*) as total_runs,
        count(*) filter (where status = 'success') as successful_runs, sum({_CENTS}) as cents,
        count(success_rate) as rated, sum(execution_time_ms) as ms,
        cast(sum(records_loaded) as bigint) as total_records_loaded
      from pipeline_runs group by 1) x""")
def run_success_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = analytics.run_success_trend(rel.pipeline_runs(spark, sf_dir))
    return analytics.ordered(view, "vw_pipeline_success_trend")


@query("run_stats_global", f"""
    select total_runs, successful, {rounded_sql("cents", "(rated * 100)", 2)} as avg_success_rate,
      total_records_loaded, {rounded_sql("ms", "(total_runs * 1000)", 2)} as avg_run_time_sec
    from (
      select count(*) as total_runs, count(*) filter (where status = 'success') as successful, sum({_CENTS}) as cents,
        count(success_rate) as rated, sum(execution_time_ms) as ms,
        cast(sum(records_loaded) as bigint) as total_records_loaded
      from pipeline_runs) x""")
def run_stats_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.run_stats(rel.pipeline_runs(spark, sf_dir))


@query("worst_runs", """
    select run_id, started_at, records_invalid, records_api_failed, success_rate, status from pipeline_runs
    order by records_invalid desc nulls first, run_id limit 5""")
def worst_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.worst_runs(rel.pipeline_runs(spark, sf_dir))


@query("new_vs_returning", """
    select p.run_id, p.started_at, count(distinct u.customer_key) as total_customers,
      count(*) filter (where cast(first_seen_at as date) = cast(started_at as date)) as new_customers,
      count(*) filter (where cast(first_seen_at as date) < cast(started_at as date)) as returning_customers
    from pipeline_runs p join fact_customer_imports f on f.pipeline_run_id = p.run_id
      join dim_customer u on u.customer_key = f.customer_key
    group by p.run_id, p.started_at""")
def new_vs_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.new_vs_returning(
        rel.pipeline_runs(spark, sf_dir), rel.fact_customer_imports(spark, sf_dir), rel.dim_customer(spark, sf_dir)
    )
