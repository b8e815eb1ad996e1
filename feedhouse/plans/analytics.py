"""Six views and five reports over the warehouse tables.

Views return unsorted frames; `ordered` adds the published order as a last step, and top-k reports sort and
cut in one step. Facts are combined on their join keys before they meet a dimension, so a key that holds a
large share of the facts reaches a join as one row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedhouse.functions.numbers import count_where, percent, rounded_ratio
from feedhouse.functions.times import day_text


def run_health(runs: DataFrame) -> DataFrame:
    return runs.select(
        "run_id", "started_at", day_text(F.col("started_at")).alias("run_date"), "source_file",
        "records_in_file", "records_parsed", "records_valid", "records_invalid", "records_loaded",
        "records_api_success", "records_api_failed", "execution_time_ms",
        rounded_ratio(F.col("execution_time_ms"), F.lit(1000), 2).alias("execution_time_sec"),
        "success_rate", "status", "pipeline_version",
    )


def daily_import_volume(facts: DataFrame, dates: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Imports per day. `since` limits both sides before any work is done: the date key of a fact is its day.

    Facts of a warehouse lie in folders by month, and meet the dates by month too, so a condition on the days of the
    result leaves folders out unread.
    """
    if since is not None:
        facts = facts.where(F.col("date_key") >= since.year * 10000 + since.month * 100 + since.day)
        if "import_month" in facts.columns:
            facts = facts.where(F.col("import_month") >= since.strftime("%Y-%m"))
        dates = dates.where(F.col("full_date") >= F.lit(since))
    keys = ["date_key", *[c for c in ("import_month",) if c in facts.columns]]
    per_key = facts.groupBy(*keys).agg(
        F.count("import_key").alias("total_imports"),
        count_where(F.col("was_valid")).alias("valid_imports"),
        count_where(~F.col("was_valid")).alias("invalid_imports"),
        count_where(F.col("api_success")).alias("api_success"),
    )
    days = dates.select("date_key", "full_date", "year", "month", "month_name", "day_name",
                        F.date_format("full_date", "yyyy-MM").alias("import_month"))
    return per_key.join(days, keys).groupBy("full_date", "year", "month", "month_name", "day_name").agg(
        *[F.sum(c).alias(c) for c in ("total_imports", "valid_imports", "invalid_imports", "api_success")]
    ).withColumn("daily_success_rate", percent(F.col("api_success"), F.col("total_imports")))


def customer_by_country(facts: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Customers and imports per country, with one row for facts without a known country.

    The country dimension is bounded by its two-letter code and joined on the map side. Facts are then
    combined per country and customer, so that a customer is one row per country: no distinct count is
    left to do, and neither a large customer nor a large country reaches the customer join as many rows.
    """
    names = ["country_name", "country_code", "region"]
    # Countries count as one when all their names agree; facts of unknown countries share the null group.
    groups = F.broadcast(
        countries.select("country_key", *names, F.min("country_key").over(Window.partitionBy(*names)).alias("group_key"))
    )
    per_customer = (
        facts.join(groups.select("country_key", "group_key"), "country_key", "left")
        .groupBy("group_key", "customer_key")
        .agg(F.count("import_key").alias("imports"), count_where(F.col("was_valid")).alias("valid"))
    )
    known = customers.select("customer_key", F.lit(True).alias("known"))
    per_country = (
        per_customer.join(known, "customer_key", "left")
        .groupBy("group_key")
        .agg(
            F.count("known").alias("unique_customers"),
            F.sum("imports").alias("total_imports"),
            F.sum("valid").alias("valid_imports"),
        )
    )
    named = groups.where(F.col("country_key") == F.col("group_key")).select("group_key", *names)
    return per_country.join(named, "group_key", "left").select(
        F.coalesce("country_name", F.lit("Unknown")).alias("country"),
        F.coalesce("country_code", F.lit("XX")).alias("country_code"),
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        "unique_customers", "total_imports", "valid_imports",
        percent(F.col("valid_imports"), F.col("total_imports")).alias("validity_rate"),
    )


def validity_summary(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy(F.to_date("imported_at").alias("import_date"))
        .agg(
            count_where(F.col("was_valid")).alias("valid_count"),
            count_where(~F.col("was_valid")).alias("invalid_count"),
            F.count(F.lit(1)).alias("total_count"),
        )
        .withColumn("validity_pct", percent(F.col("valid_count"), F.col("total_count")))
        .withColumn("import_date", day_text(F.col("import_date")))
    )


def company_size_distribution(customers: DataFrame) -> DataFrame:
    """Customers per company size. Sizes are told apart by their raw text, so null, empty and blank sizes
    give rows of their own with the same label. `customer_key` is the primary key, so rows are customers.
    """
    per_size = customers.groupBy("company_size").agg(F.count("customer_key").alias("customer_count"))
    total = per_size.agg(F.sum("customer_count")).scalar()
    label = F.coalesce(F.nullif(F.trim("company_size"), F.lit("")), F.lit("Not Specified"))
    return per_size.select(
        label.alias("company_size"), "customer_count", percent(F.col("customer_count"), total).alias("pct_of_total")
    )


def _rate_cents() -> Column:
    return F.round(F.col("success_rate") * 100).cast("bigint")


def run_success_trend(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy(day_text(F.col("started_at")).alias("run_date"))
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            count_where(F.col("status") == "success").alias("successful_runs"),
            rounded_ratio(F.sum(_rate_cents()), F.count("success_rate") * 100, 2).alias("avg_success_rate"),
            rounded_ratio(F.sum("execution_time_ms"), F.count("execution_time_ms"), 0).alias("avg_execution_ms"),
            F.sum("records_loaded").alias("total_records_loaded"),
        )
    )


# View -> the column its rows are listed by, descending; nulls come first, as in the published views.
VIEW_ORDER = {
    "vw_pipeline_health": "started_at",
    "vw_daily_import_volume": "full_date",
    "vw_customer_by_country": "unique_customers",
    "vw_validity_summary": "import_date",
    "vw_company_size_distribution": "customer_count",
    "vw_pipeline_success_trend": "run_date",
}


def ordered(view: DataFrame, name: str) -> DataFrame:
    return view.orderBy(F.col(VIEW_ORDER[name]).desc_nulls_first())


def views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six views over `pipeline_runs`, `fact_customer_imports`, `dim_customer`, `dim_country` and
    `dim_import_date`."""
    runs, facts = tables["pipeline_runs"], tables["fact_customer_imports"]
    customers, countries, dates = tables["dim_customer"], tables["dim_country"], tables["dim_import_date"]
    return {
        "vw_pipeline_health": run_health(runs),
        "vw_daily_import_volume": daily_import_volume(facts, dates),
        "vw_customer_by_country": customer_by_country(facts, customers, countries),
        "vw_validity_summary": validity_summary(facts),
        "vw_company_size_distribution": company_size_distribution(customers),
        "vw_pipeline_success_trend": run_success_trend(runs),
    }


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register tables and views by their published names, for `spark.sql`."""
    frames = {**tables, **views(tables)}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


def top_countries(facts: DataFrame, customers: DataFrame, countries: DataFrame, limit: int = 10) -> DataFrame:
    """Countries with the most customers; the code decides ties."""
    view = customer_by_country(facts, customers, countries)
    top = view.orderBy(F.desc_nulls_first("unique_customers"), "country_code").limit(limit)
    return top.select("country", "unique_customers", "validity_rate")


def recent_daily_volume(
    facts: DataFrame, dates: DataFrame, as_of: dt.date | None = None, days: int = 30
) -> DataFrame:
    """Days from `days` before `as_of` (today by default), oldest first."""
    since = (as_of or dt.datetime.now(dt.timezone.utc).date()) - dt.timedelta(days=days)
    view = daily_import_volume(facts, dates, since)
    return view.select(
        "full_date", "total_imports", "valid_imports", "invalid_imports", "daily_success_rate"
    ).orderBy(F.asc_nulls_last("full_date"))


def run_stats(runs: DataFrame) -> DataFrame:
    """One row for all runs."""
    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.sum(F.when(F.col("status") == "success", 1).otherwise(0)).alias("successful"),
        rounded_ratio(F.sum(_rate_cents()), F.count("success_rate") * 100, 2).alias("avg_success_rate"),
        F.sum("records_loaded").alias("total_records_loaded"),
        rounded_ratio(F.sum("execution_time_ms"), F.count("execution_time_ms") * 1000, 2).alias("avg_run_time_sec"),
    )


def worst_runs(runs: DataFrame, limit: int = 5) -> DataFrame:
    """Runs with the most invalid records, unknown counts first; the run id decides ties."""
    return (
        runs.orderBy(F.desc_nulls_first("records_invalid"), "run_id")
        .limit(limit)
        .select("run_id", "started_at", "records_invalid", "records_api_failed", "success_rate", "status")
    )


def new_vs_returning(runs: DataFrame, facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct customers per run, latest run first, and its facts split by whether the customer was first seen on the day of
    the run or before.

    Facts shrink to one row per run and customer, and after the customer join to one row per run and
    first-seen day, before the run itself is joined.
    """
    per_pair = facts.groupBy("pipeline_run_id", "customer_key").agg(F.count(F.lit(1)).alias("imports"))
    seen = customers.select("customer_key", F.to_date("first_seen_at").alias("seen_on"))
    per_day = per_pair.join(seen, "customer_key").groupBy("pipeline_run_id", "seen_on").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("imports").alias("imports")
    )
    started = runs.select(F.col("run_id").alias("pipeline_run_id"), "started_at")
    day = F.to_date("started_at")
    return per_day.join(started, "pipeline_run_id").groupBy(
        F.col("pipeline_run_id").alias("run_id"), "started_at"
    ).agg(
        F.sum("customers").alias("total_customers"),
        F.sum(F.when(F.col("seen_on") == day, F.col("imports")).otherwise(0)).alias("new_customers"),
        F.sum(F.when(F.col("seen_on") < day, F.col("imports")).otherwise(0)).alias("returning_customers"),
    ).orderBy(F.desc_nulls_first("started_at"))
