"""The inputs of the registered queries, derived from the test tables: as DataFrames, and as SQL.

The tables hold no customer feed, so one is built from `customer`, with defects at fixed customer numbers.
The rows of one market segment stand for an earlier load.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.fixed import COUNTRY_CODES
from feedhouse.operators.delivery import status_text
from feedhouse.sources.seeds import spread_days

RUN_ID = "run-now"
RUN_AT = dt.datetime(2001, 8, 2, 6, 0, 0)
RUN_AT_SQL = "timestamp '2001-08-02 06:00:00'"
EARLIER_SEGMENT = "MACHINERY"

FEED_FIELDS = [
    "company_name", "contact_email", "contact_first_name", "contact_last_name", "phone_number", "tax_id",
    "company_size", "address", "city", "country", "postal_code",
]


# Columns the queries use. A stated schema saves reading file footers before the query starts.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(c: Column) -> Column:
    return c.cast("string")


def row_number() -> Column:
    return F.col("_rowNumber").alias("row_number")


def user_email(k: Column) -> Column:
    return F.concat(F.lit("user"), text(k), F.lit("@example.com"))


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty feed. Row numbers leave room for a second copy of every 101st row right after it."""
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    base = table(spark, sf_dir, "customer").select(
        (k * 2 + 2).alias("_rowNumber"),
        F.when(k % 53 == 0, "").otherwise(F.concat(F.lit("  "), "c_name")).alias("company_name"),
        F.when(k % 47 == 0, "").when(k % 43 == 0, "not-an-email")
        .when(k % 31 == 0, F.concat(F.lit("USER"), text(k - 1), F.lit("@EXAMPLE.COM")))
        .otherwise(user_email(k)).alias("contact_email"),
        F.when(k % 29 == 0, " ").otherwise(F.concat(F.lit("First"), text(k))).alias("contact_first_name"),
        F.concat(F.lit("Last"), text(k)).alias("contact_last_name"),
        F.when(k % 7 < 5, "").when(k % 11 == 0, "ext. twelve")
        .otherwise(F.concat(F.lit("+1-555-"), F.lpad(text(k % 10000), 4, "0"))).alias("phone_number"),
        F.concat(F.lit("TAX-"), text(k)).alias("tax_id"),
        F.col("c_mktsegment").alias("company_size"),
        F.concat(text(k), F.lit(' Main St, Unit "'), text(k % 9), F.lit('"')).alias("address"),
        F.concat(F.lit("City "), text(nk)).alias("city"),
        F.when(nk % 5 == 4, "USA").when(nk % 5 == 3, "jp").when(nk % 5 == 2, "").when(nk % 5 == 1, "DE")
        .otherwise("US").alias("country"),
        F.when(k % 61 == 0, "n/a").otherwise(F.lpad(text(k), 6, "0")).alias("postal_code"),
        (k % 101 == 0).alias("_twice"),
    )
    copies = F.when(F.col("_twice"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = base.select("*", F.explode(copies).alias("_copy"))
    return rows.select((F.col("_rowNumber") + F.col("_copy")).alias("_rowNumber"), *FEED_FIELDS)


def earlier_rows(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("company_size") == EARLIER_SEGMENT)


def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 of the 25 nations, so that some country keys are missing. Codes of two nations equal seeded ones."""
    n = F.col("n_nationkey")
    regions = table(spark, sf_dir, "region")
    letters = F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXY"), n + 1, F.lit(1))
    code = F.when(n == 3, "DE").when(n == 7, "US").otherwise(F.concat(letters, F.lit("C")))
    return (
        table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).where(n < 20)
        .select(
            (n + 1).cast("bigint").alias("country_key"), code.alias("country_code"),
            F.col("n_name").alias("country_name"), F.col("r_name").alias("region"),
        )
    )


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    start = F.lit(dt.datetime(1995, 1, 1)).cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "customer")
        .join(first_orders(spark, sf_dir), F.col("o_custkey") == k, "left")
        .select(
            (k + 1).alias("customer_key"),
            F.col("c_name").alias("company_name"),
            user_email(k).alias("contact_email"),
            F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, "  ")
            .when(k % 23 == 0, F.concat("c_mktsegment", F.lit(" "))).otherwise(F.col("c_mktsegment"))
            .alias("company_size"),
            F.coalesce("first_order", start).alias("first_seen_at"),
        )
    )


def fact_customer_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    day = F.col("o_orderdate")
    return (
        table(spark, sf_dir, "orders").join(nations, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("import_key"),
            (F.col("o_custkey") + 1).alias("customer_key"),
            F.when(F.col("c_nationkey") < 20, F.col("c_nationkey") + 1).cast("bigint").alias("country_key"),
            (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_key"),
            F.concat(F.lit("run-"), text(F.col("o_orderkey") % 50)).alias("pipeline_run_id"),
            F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderstatus") != "P").alias("was_valid"),
            (F.col("o_orderpriority") != "1-URGENT").alias("api_success"),
            day.alias("imported_at"),
        )
    )


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty runs, counted from the orders. Success rates are exact to the cent."""
    g = F.col("o_orderkey") % 50
    counts = table(spark, sf_dir, "orders").groupBy(g.alias("g")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("inv"),
        F.sum(F.when(F.col("o_orderpriority") != "1-URGENT", 1).otherwise(0)).alias("ok"),
    )
    return counts.selectExpr(
        "concat('run-', cast(g as string)) as run_id",
        "'1.0.0' as pipeline_version",
        "timestamp_ntz'1998-01-01 06:00:00' + make_dt_interval(cast(g % 8 as int)) as started_at",
        "'orders.csv' as source_file",
        "n + g % 3 as records_in_file",
        "n as records_parsed",
        "n - inv as records_valid",
        "case when g % 13 = 5 then null else inv end as records_invalid",
        "ok as records_loaded",
        "ok as records_api_success",
        "n - ok as records_api_failed",
        "n * 7 + g * 13 as execution_time_ms",
        "case when g % 11 <> 0 then cast((20000 * ok + n) div (2 * n) as double) / 100 end as success_rate",
        "case when g % 11 = 0 then 'failed' when g % 3 = 0 then 'partial' else 'success' end as status",
    )


def delivery_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four attempts per customer; the fourth is past the limit and must be ignored."""
    k = F.col("c_custkey")
    log = table(spark, sf_dir, "customer").select(
        (k + 1).alias("customer_key"), F.col("c_name").alias("name"), user_email(k).alias("email"), k,
        F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 4)])).alias("attempt"),
    )
    turn = (k * 7 + F.col("attempt") * 3) % 10
    status = (
        F.when(turn == 5, 429).when(turn == 6, 500).when(turn == 7, 404)
        .when(turn == 8, F.lit(None).cast("int")).when(turn == 9, 503).otherwise(201)
    )
    log = log.withColumn("status", status)
    return log.select(
        "customer_key", "name", "email", "attempt", "status",
        F.when(~F.coalesce(F.col("status") == 201, F.lit(False)), status_text(F.col("status"))).alias("error"),
        F.concat(F.lit("id-"), text(k), F.lit("-"), text(F.col("attempt"))).alias("response_id"),
    )


def dim_import_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the years that orders cover."""
    day = F.col("o_orderdate")
    bounds = table(spark, sf_dir, "orders").agg(
        F.trunc(F.min(day).cast("date"), "year").alias("first"),
        F.date_sub(F.add_months(F.trunc(F.max(day).cast("date"), "year"), 12), 1).alias("last"),
    )
    return spread_days(bounds)


# Fixed values for the SQL side: the ASCII part of the white space is all the test tables hold.
_WS = r" \t\n\x0B\f\r"
EMAIL_SQL = rf"'^[^{_WS}@]+@[^{_WS}@]+\.[^{_WS}@]+$'"
PHONE_SQL = rf"'^[0-9{_WS}+\-().]{{7,20}}$'"
CODES_SQL = ", ".join(f"'{c}'" for c in COUNTRY_CODES)

RELATIONS = {
    "customer_feed": """
        select 2 * c_custkey + 2 + copy_no as row_number,
          case when c_custkey % 53 = 0 then '' else '  ' || c_name end as company_name,
          case when c_custkey % 47 = 0 then '' when c_custkey % 43 = 0 then 'not-an-email'
               when c_custkey % 31 = 0 then 'USER' || (c_custkey - 1) || '@EXAMPLE.COM'
               else 'user' || c_custkey || '@example.com' end as contact_email,
          case when c_custkey % 29 = 0 then ' ' else 'First' || c_custkey end as contact_first_name,
          'Last' || c_custkey as contact_last_name,
          case when c_custkey % 7 < 5 then '' when c_custkey % 11 = 0 then 'ext. twelve'
               else '+1-555-' || lpad(cast(c_custkey % 10000 as varchar), 4, '0') end as phone_number,
          'TAX-' || c_custkey as tax_id, c_mktsegment as company_size,
          c_custkey || ' Main St, Unit "' || (c_custkey % 9) || '"' as address,
          'City ' || c_nationkey as city,
          case c_nationkey % 5 when 4 then 'USA' when 3 then 'jp' when 2 then '' when 1 then 'DE' else 'US' end
            as country,
          case when c_custkey % 61 = 0 then 'n/a'
               else lpad(cast(c_custkey as varchar), 6, '0') end
            as postal_code
        from customer join (values (0), (1)) c(copy_no) on copy_no = 0 or c_custkey % 101 = 0""",
    "hashed_feed": """
        select *, sha256(trim(lower(company_name || '|' || contact_email || '|' || tax_id))) as source_hash,
          nullif(trim(lower(contact_email)), '') as email_key
        from customer_feed""",
    "history": """
        select distinct source_hash from hashed_feed where company_size = 'MACHINERY'""",
    "flagged_feed": """
        select f.*, row_number() over (partition by f.source_hash order by row_number) > 1 as repeat_row,
          email_key is not null and row_number() over (partition by email_key order by row_number) > 1
            as repeat_email,
          h.source_hash is not null as loaded
        from hashed_feed f left join history h on h.source_hash = f.source_hash""",
    "issue_feed": f"""
        select *, concat_ws('; ', case when loaded or repeat_row then 'DUPLICATE_ROW' end, own_issues) as issues
        from (
          select *, nullif(concat_ws('; ',
            case when repeat_email then 'DUPLICATE_EMAIL:' || email_key end,
            case when trim(company_name) = '' then 'NULL_REQUIRED:company_name' end,
            case when trim(contact_email) = '' then 'NULL_REQUIRED:contact_email' end,
            case when trim(country) <> '' and upper(trim(country)) not in ({CODES_SQL})
                 then 'INVALID_COUNTRY:' || upper(trim(country)) end,
            case when trim(phone_number) <> '' and not regexp_matches(trim(phone_number), {PHONE_SQL})
                 then 'INVALID_PHONE:' || trim(phone_number) end,
            case when trim(contact_email) <> '' and not regexp_matches(trim(contact_email), {EMAIL_SQL})
                 then 'INVALID_EMAIL_FORMAT:' || trim(contact_email) end), '') as own_issues
          from flagged_feed) x""",
    "checked_feed": f"""
        select *, concat_ws('; ',
            case when trim(company_name) = '' then 'Missing required field: "company_name"' end,
            case when trim(contact_email) = '' then 'Missing required field: "contact_email"' end,
            case when trim(contact_email) <> '' and not regexp_matches(trim(contact_email), {EMAIL_SQL})
                 then 'Invalid email format in field "contact_email": "' || trim(contact_email) || '"' end,
            case when trim(contact_first_name) = '' then 'Field "contact_first_name" must not be empty.' end,
            case when trim(contact_last_name) = '' then 'Field "contact_last_name" must not be empty.' end)
          as errors
        from customer_feed""",
    "mapped_feed": r"""
        select row_number, trim(company_name) as name, lower(trim(contact_email)) as email, trim(tax_id) as tax_id,
          trim(company_size) as company_size, trim(contact_first_name) as first_name,
          trim(contact_last_name) as last_name,
          trim(regexp_replace(phone_number, '[^0-9+\-() ]', '', 'g')) as phone, trim(address) as street,
          trim(city) as city, upper(trim(country)) as country, trim(postal_code) as postal_code
        from customer_feed""",
    "dim_country": """
        select cast(n_nationkey + 1 as bigint) as country_key,
          case n_nationkey when 3 then 'DE' when 7 then 'US'
               else substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) || 'C' end as country_code,
          n_name as country_name, r_name as region
        from nation join region on n_regionkey = r_regionkey where n_nationkey < 20""",
    "dim_customer": """
        select c_custkey + 1 as customer_key, c_name as company_name,
          'user' || c_custkey || '@example.com' as contact_email,
          case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then '  '
               when c_custkey % 23 = 0 then c_mktsegment || ' ' else c_mktsegment end as company_size,
          coalesce(first_order, timestamp '1995-01-01 00:00:00') as first_seen_at
        from customer left join (select o_custkey, min(o_orderdate) as first_order from orders group by o_custkey) o
          on o_custkey = c_custkey""",
    "fact_customer_imports": """
        select o_orderkey as import_key, o_custkey + 1 as customer_key,
          case when c_nationkey < 20 then cast(c_nationkey + 1 as bigint) end as country_key,
          cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as integer) as date_key,
          'run-' || (o_orderkey % 50) as pipeline_run_id,
          case when o_orderkey % 97 <> 0 then o_orderstatus <> 'P' end as was_valid,
          o_orderpriority <> '1-URGENT' as api_success, o_orderdate as imported_at
        from orders join customer on c_custkey = o_custkey""",
    "pipeline_runs": """
        select 'run-' || g as run_id, '1.0.0' as pipeline_version,
          timestamp '1998-01-01 06:00:00' + to_days(cast(g % 8 as integer)) as started_at,
          'orders.csv' as source_file, n + g % 3 as records_in_file, n as records_parsed, n - inv as records_valid,
          case when g % 13 = 5 then null else inv end as records_invalid, ok as records_loaded,
          ok as records_api_success, n - ok as records_api_failed, n * 7 + g * 13 as execution_time_ms,
          case when g % 11 <> 0 then cast((20000 * ok + n) // (2 * n) as double) / 100 end as success_rate,
          case when g % 11 = 0 then 'failed' when g % 3 = 0 then 'partial' else 'success' end as status
        from (
          select o_orderkey % 50 as g, count(*) as n, cast(count(*) filter (where o_orderstatus = 'P') as bigint) as inv,
            cast(count(*) filter (where o_orderpriority <> '1-URGENT') as bigint) as ok
          from orders group by 1) x""",
    "delivery_attempts": """
        select customer_key, name, email, attempt, status,
          case when status = 201 then null when status is null then 'network error' else 'HTTP ' || status end as error,
          'id-' || (customer_key - 1) || '-' || attempt as response_id
        from (
          select c_custkey + 1 as customer_key, c_name as name, 'user' || c_custkey || '@example.com' as email, attempt,
            case (c_custkey * 7 + attempt * 3) % 10 when 5 then 429 when 6 then 500 when 7 then 404 when 8 then null
              when 9 then 503 else 201 end as status
          from customer, unnest([1, 2, 3, 4]) as a(attempt)) x""",
    "delivery_outcomes": """
        select customer_key, name, email, made, last_status,
          case when last_status = 201 then 'success' else 'failed' end as status,
          case when last_status = 201 then made else 3 end as attempts,
          case when last_status = 201 then null else last_error end as error,
          case when last_status = 201 then last_response end as response_id
        from (
          select customer_key, name, email, min(attempt) as made, arg_min(coalesce(status, -1), attempt) as last_status,
            arg_min(error, attempt) filter (where error is not null) as last_error,
            arg_min(response_id, attempt) as last_response
          from delivery_attempts
          where attempt = 3 or (attempt < 3 and status in (201, 404))
          group by customer_key, name, email) x""",
    "dim_import_date": """
        select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as full_date,
          cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month,
          strftime(d, '%B') as month_name, cast(weekofyear(d) as integer) as week_of_year,
          cast(dayofweek(d) as integer) as day_of_week, strftime(d, '%A') as day_name,
          dayofweek(d) in (0, 6) as is_weekend, cast(quarter(d) as integer) as fiscal_quarter
        from (
          select unnest(generate_series(date_trunc('year', min(o_orderdate)),
            date_trunc('year', max(o_orderdate)) + interval 1 year - interval 1 day, interval 1 day)) as d
          from orders) x""",
}


def _needed(sql: str) -> list[str]:
    """Relations a text uses, directly or not, in definition order."""
    found = {name for name in RELATIONS if re.search(rf"\b{name}\b", sql)}
    for name in list(found):
        found |= set(_needed(RELATIONS[name]))
    return [name for name in RELATIONS if name in found]


def with_relations(sql: str) -> str:
    parts = [f"{name} as ({RELATIONS[name]})" for name in _needed(sql)]
    return f"with {', '.join(parts)} {sql}" if parts else sql
