"""Validation and data quality of the feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.catalog.registry import query
from feedhouse.catalog.relations import FEED_FIELDS, customer_feed, earlier_rows, row_number
from feedhouse.fixed import EXPECTED_FIELDS
from feedhouse.operators import history as past
from feedhouse.operators import quality, rules

FEED_SQL = ", ".join(FEED_FIELDS)


def loaded_before(feed: DataFrame) -> DataFrame:
    return quality.with_keys(earlier_rows(feed)).select(F.col("_sourceHash").alias("source_hash"))


def enriched_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = customer_feed(spark, sf_dir)
    return quality.enrich(feed, loaded_before(feed))


def joined(name: str) -> Column:
    return F.concat_ws("; ", name)


# --- validation ---------------------------------------------------------------------------------


@query("validate_rows", "select row_number, errors from checked_feed")
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.validate(customer_feed(spark, sf_dir)).select(row_number(), joined("errors").alias("errors"))


@query("valid_rows", f"select row_number, {FEED_SQL} from checked_feed where errors = ''")
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.valid_rows(rules.validate(customer_feed(spark, sf_dir))).select(row_number(), *FEED_FIELDS)


@query("invalid_rows", "select row_number, company_name, contact_email, errors from checked_feed where errors <> ''")
def invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rules.invalid_rows(rules.validate(customer_feed(spark, sf_dir)))
    return bad.select(row_number(), "company_name", "contact_email", joined("errors").alias("errors"))


@query("validation_summary", """
    select count(*) as total, count(*) filter (where errors = '') as valid,
      count(*) filter (where errors <> '') as invalid from checked_feed""")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.validation_summary(rules.validate(customer_feed(spark, sf_dir)))


# --- duplicates ---------------------------------------------------------------------------------


@query("dq_duplicate_rows", """
    select row_number, source_hash from flagged_feed where repeat_row""")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = quality.with_keys(customer_feed(spark, sf_dir).select("_rowNumber", *quality.HASH_FIELDS))
    hashes = quality.find_repeated_rows(keyed)
    flagged = quality.flag_duplicate_rows(keyed, hashes)
    return flagged.where("_duplicateRow").select(row_number(), F.col("_sourceHash").alias("source_hash"))


@query("dq_duplicate_emails", """
    select row_number, email_key from flagged_feed where repeat_email""")
def duplicate_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = quality.with_keys(customer_feed(spark, sf_dir).select("_rowNumber", "contact_email"))
    emails = quality.find_repeated_emails(keyed)
    flagged = quality.flag_duplicate_emails(keyed, emails)
    return flagged.where("_duplicateEmail").select(row_number(), F.col("_emailKey").alias("email_key"))


@query("dq_duplicates_vs_loaded", """
    select row_number, loaded, loaded or repeat_row as duplicate_row from flagged_feed""")
def duplicates_vs_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = customer_feed(spark, sf_dir)
    keyed = quality.with_keys(feed.select("_rowNumber", *quality.HASH_FIELDS))
    hashes = quality.find_repeated_rows(keyed, loaded_before(feed))
    flagged = quality.flag_duplicate_rows(keyed, hashes)
    return flagged.select(row_number(), F.col("_loaded").alias("loaded"), F.col("_duplicateRow").alias("duplicate_row"))


@query("source_hash", "select row_number, source_hash from hashed_feed")
def source_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_keys(customer_feed(spark, sf_dir)).select(row_number(), F.col("_sourceHash").alias("source_hash"))


# --- row issues ---------------------------------------------------------------------------------


@query("dq_row_issues", "select row_number, issues from issue_feed")
def row_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_feed(spark, sf_dir).select(row_number(), joined("_qualityIssues").alias("issues"))


@query("dq_enriched", f"""
    select row_number, {FEED_SQL}, source_hash, issues, issues = '' as is_clean from issue_feed""")
def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_feed(spark, sf_dir).select(
        row_number(), *FEED_FIELDS, F.col("_sourceHash").alias("source_hash"), joined("_qualityIssues").alias("issues"),
        F.col("_isClean").alias("is_clean"),
    )


@query("row_issue_list", """
    select row_number, unnest(string_split(issues, '; ')) as issue from issue_feed where issues <> ''""")
def row_issue_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = quality.row_issue_list(enriched_feed(spark, sf_dir))
    return listed.select(row_number(), F.explode("issue_types").alias("issue"))


@query("duplicate_list", """
    select row_number, company_name as company, source_hash as hash from flagged_feed where loaded or repeat_row""")
def duplicate_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_list(enriched_feed(spark, sf_dir)).withColumnRenamed("_rowNumber", "row_number")


@query("clean_new_rows", f"""
    select row_number, {FEED_SQL} from issue_feed where issues = '' and not loaded""")
def clean_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_rows(past.new_rows(enriched_feed(spark, sf_dir))).select(row_number(), *FEED_FIELDS)


@query("incremental_new_rows", "select row_number, source_hash, issues from issue_feed where not loaded")
def incremental_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return past.new_rows(enriched_feed(spark, sf_dir)).select(
        row_number(), F.col("_sourceHash").alias("source_hash"), joined("_qualityIssues").alias("issues")
    )


@query("incremental_skipped", """
    select count(*) as skipped_count, count(distinct source_hash) as skipped_hashes from flagged_feed where loaded""")
def incremental_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted from the combined hashes alone: the feed is not joined again."""
    feed = customer_feed(spark, sf_dir)
    keyed = quality.with_keys(feed.select("_rowNumber", *quality.HASH_FIELDS))
    hashes = quality.find_repeated_rows(keyed, loaded_before(feed)).frame.where("_loaded")
    return hashes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("skipped_count"), F.count(F.lit(1)).alias("skipped_hashes")
    )


# --- dataset figures ----------------------------------------------------------------------------

_COUNTS_SQL = " union all ".join(
    f"select {i} as field_order, '{f}' as field, count(*) filter (where trim({f}) = '') as null_count, "
    f"count(*) as total from customer_feed"
    for i, f in enumerate(EXPECTED_FIELDS, 1)
)
_PROFILE_SQL = (
    "select field_order, field, null_count, null_count / total * 100 as exact_pct, "
    f"floor(null_count / total * 100 * 100 + 0.5) / 100 as null_pct from ({_COUNTS_SQL}) c"
)
_HIGH_SQL = f"""
    select field_order, 'HIGH_NULL_RATE' as type, case when exact_pct > 80 then 'HIGH' else 'MEDIUM' end as severity,
      field, null_pct,
      'Field "' || field || '" is ' || regexp_replace(cast(null_pct as varchar), '\\.0$', '') || '% null' as message
    from ({_PROFILE_SQL}) p where exact_pct > 50"""


@query("null_profile", f"select field, null_count, null_pct from ({_PROFILE_SQL}) p")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(customer_feed(spark, sf_dir)).select("field", "null_count", "null_pct")


@query("high_null_fields", f"select type, severity, field, null_pct, message from ({_HIGH_SQL}) h")
def high_null_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.high_null_fields(quality.null_profile(customer_feed(spark, sf_dir))).drop("field_order")


def drifted(feed: DataFrame) -> tuple[DataFrame, list[str]]:
    """The feed without postal codes and with a column more, and its raw header."""
    changed = feed.drop("postal_code").withColumn("legacy_id", F.col("tax_id"))
    return changed, [c for c in changed.columns if c != "_rowNumber"]


@query("schema_drift", """
    select field, kind, rows_affected from (
      select 'postal_code' as field, 'missing' as kind, count(*) as rows_affected from customer_feed
      union all select 'legacy_id', 'unexpected', count(*) from customer_feed) x""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, header = drifted(customer_feed(spark, sf_dir))
    drift = quality.schema_drift(header)
    fields = [(f, "missing") for f in drift.missing] + [(f, "unexpected") for f in drift.unexpected]
    total = feed.agg(F.count(F.lit(1))).scalar()
    return spark.createDataFrame(fields, "field string, kind string").withColumn("rows_affected", total)


@query("dataset_issues", f"""
    select 1 as issue_order, 'SCHEMA_DRIFT' as type, 'HIGH' as severity, null as field, cast(null as double) as null_pct,
      'Missing expected fields: postal_code' as message
    union all select 2, 'SCHEMA_DRIFT', 'LOW', null, null, 'Unexpected fields found: legacy_id'
    union all select field_order + 2, type, severity, field, null_pct, message from ({_HIGH_SQL}) h
    union all select 13, 'HIGH_NULL_RATE', 'HIGH', 'postal_code', 100.0, 'Field "postal_code" is 100% null'
    where (select count(*) from customer_feed) > 0""")
def dataset_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, header = drifted(customer_feed(spark, sf_dir))
    return quality.dataset_issues(quality.null_profile(feed), quality.schema_drift(header))


@query("quality_summary", """
    select count(*) as total_rows, count(*) filter (where issues = '') as clean_rows,
      count(*) filter (where issues <> '') as rows_with_issues,
      count(*) filter (where loaded or repeat_row) as duplicates_found,
      cast(floor(count(*) filter (where issues = '') / count(*) * 100 + 0.5) as bigint) as quality_score
    from issue_feed""")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(enriched_feed(spark, sf_dir))
