"""Import facts: keys looked up, delivery flags, partition labels, reference checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.fixed import FACT_RANGES
from feedhouse.functions.text import country_prefix
from feedhouse.functions.times import date_key, stamp_literal
from feedhouse.operators.dimension import flat, part
from feedhouse.operators.spread import lookup, settle_keyed
from feedhouse.sources.tables import Settled, side_by_side


def country_code(customers: DataFrame) -> Column:
    return F.upper(country_prefix(part(customers, "address", "country")))


def with_delivery(customer_keys: DataFrame, outcomes: DataFrame | None) -> DataFrame:
    """Add delivery flags to one row per email (`contact_email`, `customer_key`, `n`).

    `outcomes` has one row per email. No outcome means not sent, no success, no attempt.
    """
    if outcomes is None:
        return customer_keys.select(
            "*", F.lit(False).alias("api_sent"), F.lit(False).alias("api_success"), F.lit(0).alias("api_attempts")
        )
    found = outcomes.select(F.col("email").alias("contact_email"), F.col("status").alias("_status"), "attempts")
    return customer_keys.join(found, "contact_email", "left").select(
        *customer_keys.columns,
        F.col("_status").isNotNull().alias("api_sent"),
        F.coalesce(F.col("_status") == "success", F.lit(False)).alias("api_success"),
        F.coalesce("attempts", F.lit(0)).cast("int").alias("api_attempts"),
    )


def email_keys(dim_customer: DataFrame, counted: DataFrame) -> DataFrame:
    """`contact_email`, `customer_key`, `n` for the emails in `counted` (`contact_email`, `n`) that have a key."""
    return counted.join(dim_customer.select("contact_email", "customer_key"), "contact_email")


def single_keys(keys: DataFrame) -> DataFrame:
    """The smallest key of each email of `email_keys`, and how many the dimension `held`: a repeated one must not
    multiply facts. Keeps the partitions of the join before it."""
    return keys.groupBy("contact_email").agg(
        F.min("customer_key").alias("customer_key"), F.first("n").alias("n"), F.count(F.lit(1)).alias("held"))


def fact_rows(
    customers: DataFrame,
    keys: Settled,
    dim_country: DataFrame,
    run_id: str | Column,
    run_at: dt.datetime,
    source_file: str | None = None,
    order: str = "_rowNumber",
    **how,
) -> DataFrame:
    """One fact per customer whose email has a key; an unknown country gives a null key.

    `keys` comes from `email_keys` and `with_delivery`. A country code that is there twice gives its smallest key. Spark
    broadcasts the countries as long as their size allows it.
    """
    countries = dim_country.groupBy("country_code").agg(F.min("country_key").alias("country_key"))
    file = F.lit(source_file) if source_file is not None else F.col("_sourceFile")
    place = [c for c in ("_sourceFile", "_rowNumber", "_rowOrder") if c in customers.columns]
    coded = customers.select(
        *place, flat(customers, "email").alias("contact_email"), country_code(customers).alias("country_code")
    )
    stamp = stamp_literal(run_at)
    return (
        lookup(coded, keys, "contact_email", order, how="inner", **how)
        .join(countries, "country_code", "left")
        .select(
            "customer_key",
            "country_key",
            date_key(stamp).alias("date_key"),
            (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("pipeline_run_id"),
            file.cast("string").alias("source_file"),
            F.col("_rowNumber").alias("source_row"),
            F.lit(True).alias("was_valid"),
            "api_sent",
            "api_success",
            "api_attempts",
            stamp.alias("imported_at"),
            F.date_format(stamp, "yyyy-MM").alias("import_month"),
        )
    )


def range_label(imported_at: Column, ranges=FACT_RANGES) -> Column:
    """Name of the half-open range a stamp falls in, else `default`."""
    label = F.lit("default")
    for name, start, end in reversed(ranges):
        inside = (imported_at >= F.lit(start).cast("timestamp")) & (imported_at < F.lit(end).cast("timestamp"))
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def partition_columns(imported_at: Column, ranges=FACT_RANGES) -> dict[str, Column]:
    """The month a fact is stored under, and the named range it would fall in."""
    return {"import_month": F.date_format(imported_at, "yyyy-MM"), "partition_label": range_label(imported_at, ranges)}


def missing_references(facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str | None = None) -> Settled:
    """Fact keys that the dimension lacks, with their row counts; null keys pass.

    Facts are combined per key first, so the join sees each key once.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dimension.select(F.col(dimension_key or key).alias(key))
    return settle_keyed(counts.join(known, key, "left_anti"), f"missing-{key}")


def reference_violations(
    facts: DataFrame, row_key: str, checks: dict[str, tuple[DataFrame, str]], **how
) -> DataFrame:
    """One reject per fact row and failing reference: `row_key`, `constraint_name`, `bad_key`."""
    found = None
    searches = [
        lambda key=key, dim=dim, dim_key=dim_key: missing_references(facts, key, dim, dim_key)
        for key, (dim, dim_key) in checks.items()
    ]
    for key, missing in zip(checks, side_by_side(*searches)):
        rejects = lookup(facts.select(row_key, key), missing, key, row_key, how="inner", **how).select(
            row_key, F.lit(key).alias("constraint_name"), F.col(key).cast("bigint").alias("bad_key")
        )
        found = rejects if found is None else found.unionByName(rejects)
    return found
