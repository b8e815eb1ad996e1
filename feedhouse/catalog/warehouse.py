"""Seeds, staging, dimension, facts, constraint checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.catalog import relations as rel
from feedhouse.catalog.feed import ROWS_PER_FILE, write_files
from feedhouse.catalog.quality import enriched_feed
from feedhouse.catalog.registry import query
from feedhouse.catalog.relations import RUN_AT, RUN_AT_SQL, RUN_ID, row_number
from feedhouse.fixed import COUNTRY_SEED, STAGING_COLUMNS
from feedhouse.functions.text import empty_to_null
from feedhouse.operators import checks, delivery, dimension, facts, history, quality, rules, staging
from feedhouse.operators.mapping import map_rows
from feedhouse.operators.runs import one_row
from feedhouse.operators.spread import key_counts, settle_keyed
from feedhouse.sources import seeds
from feedhouse.sources.records import field_names, read_feed
from feedhouse.sources.tables import settle


def plain(name: str) -> Column:
    """A stamp without zone, as the SQL side holds it."""
    return F.col(name).cast("timestamp_ntz").alias(name)


# --- seeds and dates ----------------------------------------------------------------------------


@query("seed_insert_absent", f"""
    select country_code, country_name, region from dim_country
    union all
    select * from (values {", ".join(map(str, COUNTRY_SEED))}) s(country_code, country_name, region)
    where country_code not in (select country_code from dim_country)""")
def seed_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = rel.dim_country(spark, sf_dir).drop("country_key")
    return seeds.insert_absent(existing, seeds.country_seed(spark), "country_code")


@query("dim_date", "select * from dim_import_date")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.dim_import_date(spark, sf_dir)


# --- staging ------------------------------------------------------------------------------------

_STAGED_SQL = ", ".join(f"nullif({f}, '') as {t}" for f, t in STAGING_COLUMNS.items())


@query("staging_load", f"""
    select 'feed.csv' as source_file, row_number as source_row, source_hash, '{RUN_ID}' as pipeline_run_id,
      {RUN_AT_SQL} as ingested_at, '1.0.0' as pipeline_version, {_STAGED_SQL}, issues = '' as is_valid,
      case when issues = '' then '[]' else '["' || replace(issues, '; ', '","') || '"]' end as quality_issues
    from issue_feed where not loaded and not repeat_row""")
def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging.staging_rows(enriched_feed(spark, sf_dir), RUN_ID, RUN_AT, source_file="feed.csv")
    return rows.withColumn("ingested_at", plain("ingested_at"))


@query("mark_processed", """
    select f.row_number, r.run_id is not null as is_processed,
      r.started_at + r.execution_time_ms * interval 1 millisecond as processed_at
    from customer_feed f left join pipeline_runs r
      on r.run_id = 'run-' || (f.row_number % 50) and r.status in ('success', 'partial')""")
def mark_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed rows stand for staged rows of fifty runs."""
    staged = rel.customer_feed(spark, sf_dir).select(
        row_number(), F.concat(F.lit("run-"), (F.col("_rowNumber") % 50).cast("string")).alias("pipeline_run_id")
    )
    ended = rel.pipeline_runs(spark, sf_dir).where(F.col("status").isin("success", "partial")).select(
        "run_id", end_stamp().alias("processed_at")
    )
    marked = staging.with_processed(staged, ended, order="row_number")
    return marked.select("row_number", "is_processed", "processed_at")


def end_stamp() -> Column:
    return F.col("started_at") + F.expr("make_dt_interval(0, 0, 0, cast(execution_time_ms / 1000 as decimal(18, 6)))")


# --- dimension ----------------------------------------------------------------------------------

_CURRENT_SQL = """
    select c_custkey + 1 as customer_key, 'Old ' || c_name as company_name,
      'user' || c_custkey || '@example.com' as contact_email, 'Old' as contact_first,
      cast(null as varchar) as contact_last, cast(null as varchar) as phone_number, 'OLD-' || c_custkey as tax_id,
      c_mktsegment as company_size, cast(null as varchar) as address, 'Town' as city, 'US' as country_code,
      cast(null as varchar) as postal_code, timestamp '2000-01-01 00:00:00' as first_seen_at,
      timestamp '2000-01-01 00:00:00' as last_updated_at, 'run-old' as source_run_id,
      c_custkey % 2 = 0 as is_active
    from customer where c_mktsegment in ('MACHINERY', 'BUILDING')"""


def current_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension before the load: the customers of two market segments."""
    k = F.col("c_custkey")
    none, old = F.lit(None).cast("string"), F.lit(dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc))
    return rel.table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("MACHINERY", "BUILDING")).select(
        (k + 1).alias("customer_key"), F.concat(F.lit("Old "), "c_name").alias("company_name"),
        rel.user_email(k).alias("contact_email"), F.lit("Old").alias("contact_first"), none.alias("contact_last"),
        none.alias("phone_number"), F.concat(F.lit("OLD-"), k.cast("string")).alias("tax_id"),
        F.col("c_mktsegment").alias("company_size"), none.alias("address"), F.lit("Town").alias("city"),
        F.lit("US").alias("country_code"), none.alias("postal_code"), old.alias("first_seen_at"),
        old.alias("last_updated_at"), F.lit("run-old").alias("source_run_id"), (k % 2 == 0).alias("is_active"),
    )


def valid_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped valid rows, written once because several steps read them; an email can come twice."""
    valid = rules.valid_rows(rules.validate(rel.customer_feed(spark, sf_dir)))
    return settle(map_rows(valid, run_at=RUN_AT).customers, "customers").frame


_VALID_SQL = "select * from mapped_feed where row_number in (select row_number from checked_feed where errors = '')"

_INCOMING_SQL = f"""
    select email as contact_email, count(*) over (partition by email) as n,
      row_number() over (partition by email order by row_number desc) as from_last,
      first_value(nullif(tax_id, '')) over (partition by email order by row_number) as tax_id, name as company_name,
      nullif(first_name, '') as contact_first, nullif(last_name, '') as contact_last,
      nullif(phone, '') as phone_number, nullif(company_size, '') as company_size, nullif(street, '') as address,
      nullif(city, '') as city, nullif(substr(country, 1, 2), '') as country_code,
      nullif(postal_code, '') as postal_code
    from ({_VALID_SQL}) v"""


def _merged_sql() -> str:
    replaced = ", ".join(
        f"case when n.contact_email is not null then n.{c} else o.{c} end as {c}" for c in dimension.REPLACED
    )
    return f"""
        select coalesce(o.customer_key, k.new_key) as customer_key,
          coalesce(o.contact_email, n.contact_email) as contact_email, {replaced},
          case when o.contact_email is not null then o.tax_id else n.tax_id end as tax_id,
          coalesce(o.first_seen_at, {RUN_AT_SQL}) as first_seen_at,
          case when n.contact_email is not null then {RUN_AT_SQL} else o.last_updated_at end as last_updated_at,
          case when n.contact_email is not null then '{RUN_ID}' else o.source_run_id end as source_run_id,
          coalesce(o.is_active, true) as is_active
        from ({_CURRENT_SQL}) o
        full join (select * from ({_INCOMING_SQL}) i where from_last = 1) n on n.contact_email = o.contact_email
        left join (
          select contact_email, row_number() over (order by contact_email)
            + (select max(customer_key) from ({_CURRENT_SQL}) m) as new_key
          from (select distinct contact_email from ({_INCOMING_SQL}) i
                where contact_email not in (select contact_email from ({_CURRENT_SQL}) c)) d
        ) k on k.contact_email = n.contact_email"""


@query("dim_upsert", _merged_sql())
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = dimension.one_per_email(dimension.dimension_columns(valid_customers(spark, sf_dir)))
    incoming = settle(arriving, "incoming").frame
    merged = dimension.merge_customers(current_dimension(spark, sf_dir), incoming, RUN_ID, RUN_AT)
    return merged.withColumns({c: plain(c) for c in ("first_seen_at", "last_updated_at")})


@query("surrogate_keys", f"""
    select contact_email, row_number() over (order by contact_email)
      + (select max(customer_key) from ({_CURRENT_SQL}) m) as customer_key
    from (select distinct email_key as contact_email from hashed_feed where email_key is not null) e
    where contact_email not in (select contact_email from ({_CURRENT_SQL}) c)""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = current_dimension(spark, sf_dir)
    keyed = quality.with_keys(rel.customer_feed(spark, sf_dir).select("contact_email"))
    emails = keyed.where(F.col("_emailKey").isNotNull()).select(F.col("_emailKey").alias("contact_email")).distinct()
    fresh = emails.join(current.select("contact_email"), "contact_email", "left_anti")
    return dimension.surrogate_keys(fresh, current.agg(F.max("customer_key")).first()[0] + 1)


# --- facts --------------------------------------------------------------------------------------

_OUTCOMES_SQL = "select * from delivery_outcomes where error is distinct from 'HTTP 404'"


def kept_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes per email, without those of rejected requests, so that some emails have none."""
    outcomes = delivery.delivery_outcomes(rel.delivery_attempts(spark, sf_dir), ["email", "customer_key"])
    kept = outcomes.where(~F.col("error").eqNullSafe("HTTP 404"))
    return delivery.last_per_email(kept, "customer_key")


@query("fact_delivery_flags", f"""
    select d.contact_email, d.customer_key, o.email is not null as api_sent,
      coalesce(o.status = 'success', false) as api_success, cast(coalesce(o.attempts, 0) as integer) as api_attempts
    from dim_customer d left join ({_OUTCOMES_SQL}) o on o.email = d.contact_email""")
def fact_delivery_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = rel.dim_customer(spark, sf_dir).select("contact_email", "customer_key")
    return facts.with_delivery(keys, kept_outcomes(spark, sf_dir))


@query("fact_load", f"""
    select d.customer_key, c.country_key, 20010802 as date_key, '{RUN_ID}' as pipeline_run_id,
      'feed.csv' as source_file, v.row_number as source_row, true as was_valid, o.email is not null as api_sent,
      coalesce(o.status = 'success', false) as api_success, cast(coalesce(o.attempts, 0) as integer) as api_attempts,
      {RUN_AT_SQL} as imported_at, '2001-08' as import_month
    from ({_VALID_SQL}) v join ({_CURRENT_SQL}) d on d.contact_email = v.email
      left join dim_country c on c.country_code = substr(v.country, 1, 2)
      left join ({_OUTCOMES_SQL}) o on o.email = v.email""")
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = valid_customers(spark, sf_dir)
    counted = key_counts(customers.select(F.col("email").alias("contact_email")), "contact_email")
    keys = facts.email_keys(current_dimension(spark, sf_dir), counted)
    settled = settle_keyed(facts.with_delivery(keys, kept_outcomes(spark, sf_dir)), "customer-keys")
    rows = facts.fact_rows(customers, settled, rel.dim_country(spark, sf_dir), RUN_ID, RUN_AT, "feed.csv")
    return rows.withColumn("imported_at", plain("imported_at"))


FEED_RANGES = [("1996_01", "1996-01-01", "1996-02-01"), ("1997_q2", "1997-04-01", "1997-07-01")]


@query("fact_partition_label", """
    select import_key, strftime(imported_at, '%Y-%m') as import_month,
      case when imported_at >= timestamp '1996-01-01' and imported_at < timestamp '1996-02-01' then '1996_01'
           when imported_at >= timestamp '1997-04-01' and imported_at < timestamp '1997-07-01' then '1997_q2'
           else 'default' end as partition_label
    from fact_customer_imports""")
def fact_partition_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = rel.fact_customer_imports(spark, sf_dir)
    labels = facts.partition_columns(F.col("imported_at"), FEED_RANGES)
    return loaded.select("import_key", *[c.alias(name) for name, c in labels.items()])


@query("fk_violations", f"""
    select import_key, 'customer_key' as constraint_name, customer_key as bad_key from fact_customer_imports
    where customer_key not in (select customer_key from ({_CURRENT_SQL}) c)
    union all
    select import_key, 'country_key', country_key from fact_customer_imports
    where country_key is not null and country_key not in (select country_key from dim_country where region <> 'ASIA')
    union all
    select import_key, 'date_key', date_key from fact_customer_imports
    where date_key not in (select date_key from dim_import_date)""")
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts against a dimension of two segments, countries of four regions, and all dates."""
    countries = rel.dim_country(spark, sf_dir).where(F.col("region") != "ASIA")
    return facts.reference_violations(
        rel.fact_customer_imports(spark, sf_dir),
        "import_key",
        {
            "customer_key": (current_dimension(spark, sf_dir), "customer_key"),
            "country_key": (countries, "country_key"),
            "date_key": (rel.dim_import_date(spark, sf_dir), "date_key"),
        },
    )


@query("load_counts", """
    select count(*) filter (where not loaded) as staging_attempted,
      count(*) filter (where not loaded and not repeat_row) as staging_loaded,
      count(*) filter (where not loaded and issues = '') as dimension_loaded,
      count(*) filter (where not loaded and issues = '') as fact_loaded
    from issue_feed""")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by a load of the clean new rows; rows a conflict rule ignores are not counted."""
    enriched = settle(enriched_feed(spark, sf_dir), "rows").frame
    new = history.new_rows(enriched)
    customers = settle(map_rows(quality.clean_rows(new), run_at=RUN_AT).customers, "customers").frame
    incoming = settle(dimension.one_per_email(dimension.dimension_columns(customers)), "incoming").frame
    merged = dimension.merge_customers(current_dimension(spark, sf_dir), incoming, RUN_ID, RUN_AT)
    per_email = facts.email_keys(merged, incoming.select("contact_email", "n"))
    keys = settle_keyed(facts.with_delivery(per_email, None), "customer-keys")
    rows = facts.fact_rows(customers, keys, rel.dim_country(spark, sf_dir), RUN_ID, RUN_AT, "feed.csv")

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    return one_row(
        attempted=counted(new, "staging_attempted"),
        staged=counted(staging.staging_rows(enriched, RUN_ID, RUN_AT, source_file="feed.csv"), "staging_loaded"),
        upserted=keys.frame.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("dimension_loaded")),
        facts=counted(rows, "fact_loaded"),
    )


# --- constraints --------------------------------------------------------------------------------


def nulled_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = rel.customer_feed(spark, sf_dir)
    return feed.select("_rowNumber", *[empty_to_null(F.col(f)).alias(f) for f in rel.FEED_FIELDS])


@query("check_not_null", """
    select cast(row_number as varchar) as key, 'staging' as stage, concat_ws('; ',
      case when company_name = '' then 'null value in column company_name' end,
      case when contact_email = '' then 'null value in column contact_email' end) as error
    from customer_feed where company_name = '' or contact_email = ''""")
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checks.check_rows(nulled_feed(spark, sf_dir), not_null=["company_name", "contact_email"])
    return checks.rejects(checked, "staging", "_rowNumber")


@query("check_unique", """
    select email_key, count(*) as n_rows from hashed_feed where email_key is not null
    group by email_key having count(*) > 1""")
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = quality.with_keys(rel.customer_feed(spark, sf_dir))
    return checks.repeated_keys(keyed, "_emailKey").withColumnRenamed("_emailKey", "email_key")


@query("check_length", """
    select cast(row_number as varchar) as key, 'staging' as stage, concat_ws('; ',
      case when length(contact_email) > 18 then 'value too long for column contact_email (18)' end,
      case when length(tax_id) > 6 then 'value too long for column tax_id (6)' end) as error
    from customer_feed where length(contact_email) > 18 or length(tax_id) > 6""")
def check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checks.check_rows(nulled_feed(spark, sf_dir), lengths={"contact_email": 18, "tax_id": 6})
    return checks.rejects(checked, "staging", "_rowNumber")


@query("check_numeric_range", """
    select cast(o_orderkey as varchar) as key, 'runs' as stage,
      'value out of range for column o_totalprice (7,2)' as error
    from orders where o_totalprice is not null and try_cast(o_totalprice as decimal(7, 2)) is null""")
def check_numeric_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checks.check_rows(rel.table(spark, sf_dir, "orders"), ranges={"o_totalprice": (7, 2)})
    return checks.rejects(checked, "runs", "o_orderkey")


@query("apply_defaults", f"""
    select import_key, was_valid, api_success, false as api_sent, cast(0 as integer) as api_attempts,
      {RUN_AT_SQL} as imported_at
    from fact_customer_imports""")
def apply_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that have a default: two flags that are given keep their nulls, three that are absent get it."""
    loaded = rel.fact_customer_imports(spark, sf_dir).select("import_key", "was_valid", "api_success")
    defaults = {
        "api_sent": F.lit(False), "api_attempts": F.lit(0), "imported_at": F.lit(RUN_AT).cast("timestamp_ntz"),
    }
    return checks.with_defaults(loaded, defaults)


@query("load_errors", f"""
    select 'staging' as stage, cast(row_number as varchar) as key, 'value too long for column tax_id (6)' as error
    from issue_feed where not loaded and not repeat_row and length(tax_id) > 6
    union all
    select 'dim_customer', email, 'null value in column phone_number' from ({_VALID_SQL}) v where phone = ''
    union all
    select 'fact', cast(import_key as varchar), 'missing customer_key ' || customer_key from fact_customer_imports
    where customer_key not in (select customer_key from ({_CURRENT_SQL}) c)""")
def load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of the three load steps; limits are tighter than the shipped ones, so that there are some."""
    staged = staging.staging_rows(enriched_feed(spark, sf_dir), RUN_ID, RUN_AT, source_file="feed.csv")
    upserts = dimension.dimension_columns(valid_customers(spark, sf_dir))
    violations = facts.reference_violations(
        rel.fact_customer_imports(spark, sf_dir), "import_key",
        {"customer_key": (current_dimension(spark, sf_dir), "customer_key")},
    )
    return checks.load_errors(
        checks.rejects(checks.check_rows(staged, lengths={"tax_id": 6}), "staging", "source_row"),
        checks.rejects(checks.check_rows(upserts, not_null=["phone_number"]), "dim_customer", "contact_email"),
        checks.reference_errors(violations, "import_key"),
    )


# --- several files ------------------------------------------------------------------------------

_FILES = 3


@query("multi_file_load", f"""
    with feed as (
      select c_custkey as k, cast((c_custkey % {_FILES}) * 4000 + c_custkey // 250000 as varchar) as file, c_name as name,
        'm' || (c_custkey // 4) || '@x.co' as email
      from customer),
    clean as (
      select * from (select *, row_number() over (partition by file, email order by k) as place from feed) f
      where place = 1),
    ranked as (
      select *, row_number() over (partition by email order by file, k) as early,
        row_number() over (partition by email order by file desc, k desc) as late
      from clean)
    select email as contact_email, max(case when late = 1 then name end) as company_name,
      max(case when early = 1 then 'T' || k end) as tax_id, count(*) as n
    from ranked group by email""")
def multi_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files or more, emails shared between and within them: the upsert of the rows that are clean in their file."""
    k = F.col("c_custkey")
    fields = F.concat_ws(",", "c_name", F.concat(F.lit("m"), rel.text(F.floor(k / 4)), F.lit("@x.co")),
                         F.concat(F.lit("T"), rel.text(k)))
    lines = rel.table(spark, sf_dir, "customer").select(
        ((k % _FILES) * (4000 * ROWS_PER_FILE) + k).alias("place"), fields.alias("line"))
    rows = read_feed(spark, write_files(lines, "company_name,contact_email,tax_id", "files")).rows
    keyed = quality.with_keys(rows)
    flagged = quality.flag_duplicate_emails(keyed, quality.find_repeated_emails(keyed, "_rowOrder"), "_rowOrder")
    customers = map_rows(flagged.where(~F.col("_duplicateEmail")), keep=("_sourceFile", "_rowNumber", "_rowOrder")).customers
    upserts = dimension.one_per_email(dimension.dimension_columns(customers), "_rowOrder")
    return upserts.select("contact_email", "company_name", "tax_id", "n")


@query("multi_file_history", f"""
    with feed as (
      select *, 1 + row_number() over (partition by file_no order by k) as row_number from (
        select c_custkey as k, c_custkey // 4 as g, cast((c_custkey % {_FILES}) * 4000 + c_custkey // 250000 as integer)
          as file_no, case when c_custkey % 7 = 0 then ' ' else c_mktsegment end as phone
        from customer) f),
    kept as (select g, min(cast(file_no as varchar)) as first_file from feed where g % 11 <> 0 group by g),
    flagged as (
      select f.*, coalesce(k.first_file < cast(f.file_no as varchar), false) as loaded,
        row_number() over (partition by f.g, file_no order by f.k) > 1 as later
      from feed f left join kept k on k.g = f.g)
    select file_no, row_number, loaded, loaded or later as duplicate_row,
      not (loaded or later) and g % 11 <> 0 as staged, not loaded and phone <> ' ' as becomes_fact,
      case when phone = ' ' then 'Missing required field: "phone.no"' else '' end as errors
    from flagged""")
def multi_file_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows repeated within and across files, some too long for staging, and a rule on a field named `phone.no`.

    What staging took from an earlier file counts as loaded, so files together give what they give one by one.
    """
    k = F.col("c_custkey")
    group = rel.text(F.floor(k / 4))
    tax = F.when(F.floor(k / 4) % 11 == 0, F.repeat(F.lit("9"), 101)).otherwise(F.lit("T"))
    fields = F.concat_ws(",", F.concat(F.lit("Firm "), group), F.concat(F.lit("m"), group, F.lit("@x.co")), tax,
                         F.when(k % 7 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")))
    lines = rel.table(spark, sf_dir, "customer").select(
        ((k % _FILES) * (4000 * ROWS_PER_FILE) + k).alias("place"), fields.alias("line"))
    feed = read_feed(spark, write_files(lines, "company_name,contact_email,tax_id,phone.no", "files"))
    kept = staging.insertable(feed.rows.columns)
    enriched = quality.enrich(feed.rows, None, "_rowOrder", feed_rows=feed.lines, kept=kept)
    checked = rules.validate(enriched, {"required": ["phone.no"]}, field_names(feed.header))
    return checked.select(
        F.regexp_extract("_sourceFile", r"file_no=(\d+)", 1).cast("int").alias("file_no"),
        F.col("_rowNumber").alias("row_number"), F.col("_loaded").alias("loaded"),
        F.col("_duplicateRow").alias("duplicate_row"), (~F.col("_duplicateRow") & kept).alias("staged"),
        (~F.col("_loaded") & (F.size("errors") == 0)).alias("becomes_fact"),
        F.concat_ws("; ", "errors").alias("errors"))
