"""Type-1 customer dimension: one row per email, keys given once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.functions.text import country_prefix, empty_to_null
from feedhouse.functions.times import stamp_literal
from feedhouse.operators.ranks import dense_numbers
from feedhouse.operators.spread import lookup, settle_keyed

# Replaced by every load of a known email; tax_id, first_seen_at, is_active and the key are kept.
REPLACED = [
    "company_name", "contact_first", "contact_last", "phone_number", "company_size",
    "address", "city", "country_code", "postal_code",
]

DIM_SCHEMA = (
    "customer_key bigint, company_name string, contact_email string, contact_first string, contact_last string, "
    "phone_number string, tax_id string, company_size string, address string, city string, country_code string, "
    "postal_code string, first_seen_at timestamp, last_updated_at timestamp, source_run_id string, is_active boolean"
)


def part(customers: DataFrame, group: str, name: str) -> Column:
    """`group.name` of a customer object, null where the mapping has no such field."""
    fields = {f.name: f.dataType for f in customers.schema.fields}
    if group in fields and hasattr(fields[group], "fieldNames") and name in fields[group].fieldNames():
        return F.col(f"{group}.{name}")
    return F.lit(None).cast("string")


def flat(customers: DataFrame, name: str) -> Column:
    return F.col(name) if name in customers.columns else F.lit(None).cast("string")


def dimension_columns(customers: DataFrame) -> DataFrame:
    """Customer objects as dimension columns; empty text becomes null except for name and email."""
    return customers.select(
        *[c for c in customers.columns if c.startswith("_")],
        flat(customers, "name").alias("company_name"),
        flat(customers, "email").alias("contact_email"),
        empty_to_null(part(customers, "contact", "firstName")).alias("contact_first"),
        empty_to_null(part(customers, "contact", "lastName")).alias("contact_last"),
        empty_to_null(part(customers, "contact", "phone")).alias("phone_number"),
        empty_to_null(flat(customers, "taxId")).alias("tax_id"),
        empty_to_null(flat(customers, "companySize")).alias("company_size"),
        empty_to_null(part(customers, "address", "street")).alias("address"),
        empty_to_null(part(customers, "address", "city")).alias("city"),
        empty_to_null(country_prefix(part(customers, "address", "country"))).alias("country_code"),
        empty_to_null(part(customers, "address", "postalCode")).alias("postal_code"),
    )


def one_per_email(incoming: DataFrame, order: str = "_rowNumber", **how) -> DataFrame:
    """The net effect of upserting the rows in order: the last row's values, the first row's tax id.

    `n` counts the rows. Only figures are grouped; the rows themselves are not shuffled unless very many
    emails repeat, and a repeated email is combined before anything moves.
    """
    runs = [c for c in ("source_run_id",) if c in incoming.columns]
    columns = ["contact_email", *REPLACED, *runs, "tax_id"]
    counts = incoming.groupBy("contact_email").agg(
        F.min(order).alias("_firstRow"), F.max(order).alias("_lastRow"), F.count(F.lit(1)).alias("n")
    )
    repeats = settle_keyed(counts.where("n > 1"), "repeated-emails")
    if not repeats.rows:
        return incoming.select(*columns, F.lit(1).cast("bigint").alias("n"))
    marked = lookup(incoming.select(order, *columns), repeats, "contact_email", order, **how)
    firsts = marked.where(F.col(order) == F.col("_firstRow")).select(
        "contact_email", F.col("tax_id").alias("_firstTax"), F.lit(1).cast("bigint").alias("n")
    )
    lasts = marked.where(F.col("n").isNull() | (F.col(order) == F.col("_lastRow"))).withColumnRenamed("n", "_rows")
    taxed = lookup(lasts, settle_keyed(firsts, "first-tax-ids"), "contact_email", order, **how)
    tax_id = F.when(F.col("_rows").isNull(), F.col("tax_id")).otherwise(F.col("_firstTax")).alias("tax_id")
    return taxed.select(*columns[:-1], tax_id, F.coalesce("_rows", F.lit(1)).alias("n"))


def surrogate_keys(emails: DataFrame, first_free: int) -> DataFrame:
    """`customer_key` for new emails: growing with the email, dense, starting at `first_free`. Emails alone move."""
    ranked = dense_numbers(emails.select("contact_email"), "contact_email", "_rank", "new-emails")
    return ranked.select("contact_email", (F.col("_rank") + (first_free - 1)).alias("customer_key"))


def bucket_of(email: Column, buckets: int) -> Column:
    """The bucket of an email: the number of the partition that `repartition(buckets, email)` puts it into."""
    return F.pmod(F.hash(email), F.lit(buckets))


def bucket_number(rows: int, known: int, bucket_rows: int) -> int:
    """How many buckets a dimension of `rows` should have: `known` as long as they are not overfull, else a power of two
    that leaves room for four times the rows."""
    if known and rows <= known * bucket_rows:
        return known
    wanted = 1 if rows <= bucket_rows else -(-4 * rows // bucket_rows)
    return max(known, 1 << (wanted - 1).bit_length())


def merge_customers(
    current: DataFrame | None,
    incoming: DataFrame,
    run_id: str,
    run_at: dt.datetime,
    first_free: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """The dimension after the upsert of `incoming` (one row per email, see `one_per_email`).

    Both sides hold an email once, so the join has no hot key, and each row moves once at most. New emails get the next
    keys in email order; only they are sorted, not their rows. With `buckets` a partition of the result holds exactly one
    bucket, and `current` may be cut to the buckets of the incoming emails. A row comes from the run in its own column
    `source_run_id`, where it has one.
    """
    stamp = stamp_literal(run_at)
    if current is None:
        current = incoming.sparkSession.createDataFrame([], DIM_SCHEMA)
    if first_free is None:
        first_free = (current.agg(F.max("customer_key")).first()[0] or 0) + 1
    run = F.col("new.source_run_id") if "source_run_id" in incoming.columns else F.lit(run_id)
    # The dimension is cut to the arriving emails first: a small load then moves no part of a large one for this.
    known = current.select("contact_email").join(incoming.select("contact_email"), "contact_email", "left_semi")
    fresh = incoming.select("contact_email").join(known, "contact_email", "left_anti")
    keys = surrogate_keys(fresh, first_free).withColumnRenamed("customer_key", "_newKey")
    if buckets:
        current, incoming, keys = (df.repartition(buckets, "contact_email") for df in (current, incoming, keys))
    arrived = F.col("new.n").isNotNull()

    def merged(name: str) -> Column:
        if name == "contact_email":
            return F.col(name)
        old = F.col(f"old.{name}")
        if name == "customer_key":
            return F.coalesce(old, F.col("_newKey")).alias(name)
        if name == "is_active":
            return F.when(F.col("old.customer_key").isNull(), F.lit(True)).otherwise(old).alias(name)
        if name == "first_seen_at":
            return F.when(F.col("old.customer_key").isNull(), stamp).otherwise(old).alias(name)
        if name == "tax_id":
            return F.when(F.col("old.customer_key").isNull(), F.col("new.tax_id")).otherwise(old).alias(name)
        value = stamp if name == "last_updated_at" else run if name == "source_run_id" else F.col(f"new.{name}")
        return F.when(arrived, value).otherwise(old).alias(name)

    names = [f.split()[0] for f in DIM_SCHEMA.split(", ")]
    both = incoming.alias("new").join(keys, "contact_email", "left").alias("new")
    rows = current.alias("old").join(both, "contact_email", "full").select(*map(merged, names))
    return rows.withColumn("bucket", bucket_of(F.col("contact_email"), buckets)) if buckets else rows
