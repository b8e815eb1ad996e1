"""Mapping of feed rows to customer objects, and the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.catalog.registry import query
from feedhouse.catalog.relations import RUN_AT, customer_feed, row_number, table
from feedhouse.fixed import DEFAULT_MAPPING, STAGING_COLUMNS
from feedhouse.functions import nested
from feedhouse.functions import text as words
from feedhouse.operators.mapping import Mapped, PythonTransform, flat_customers, map_rows

STAMP = "2001-08-02T06:00:00.000Z"


def mapped_feed(spark: SparkSession, sf_dir: str, config: dict | None = None, **how) -> Mapped:
    return map_rows(customer_feed(spark, sf_dir), config, RUN_AT, **how)


@query("map_flat", "select row_number, name, email, tax_id, company_size from mapped_feed")
def map_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_feed(spark, sf_dir).customers.select(
        row_number(), "name", "email", F.col("taxId").alias("tax_id"), F.col("companySize").alias("company_size")
    )


@query("map_nested", f"""
    select row_number, first_name, last_name, phone, street, city, country, postal_code, 'csv_import' as source,
      '{STAMP}' as imported_at
    from mapped_feed""")
def map_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_feed(spark, sf_dir).customers.select(
        row_number(),
        F.col("contact.firstName").alias("first_name"), F.col("contact.lastName").alias("last_name"), "contact.phone",
        "address.street", "address.city", "address.country", F.col("address.postalCode").alias("postal_code"),
        "metadata.source", F.col("metadata.importedAt").alias("imported_at"),
    )


@query("map_missing_column", "select row_number, '' as fax, '' as other_fax, name from mapped_feed")
def map_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {
        "fieldMappings": {
            "name": {"from": "company_name", "transform": "trim"}, "fax": {"from": "fax_number", "transform": "trim"},
        },
        "nestedMappings": {"contact": {"fax": {"from": "fax_number"}}},
        "transforms": DEFAULT_MAPPING["transforms"],
    }
    customers = mapped_feed(spark, sf_dir, config).customers
    return customers.select(row_number(), "fax", F.col("contact.fax").alias("other_fax"), "name")


@query("map_passthrough", "select row_number, company_name as name, contact_email as email from customer_feed")
def map_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transform that no configuration defines, and one that does not resolve: both pass values through."""
    config = {
        "fieldMappings": {
            "name": {"from": "company_name", "transform": "unknown"},
            "email": {"from": "contact_email", "transform": "broken"},
        },
        "transforms": {"broken": "value => value.trim("},
    }
    return mapped_feed(spark, sf_dir, config).customers.select(row_number(), "name", "email")


@query("map_custom_expr", """
    select row_number, reverse(upper(trim(city))) as city,
      case when postal_code = 'n/a' then postal_code else cast(cast(postal_code as integer) + 1 as varchar) end as code
    from customer_feed""")
def map_custom_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {
        "fieldMappings": {
            "city": {"from": "city", "transform": "shout"}, "code": {"from": "postal_code", "transform": "next"},
        },
        "transforms": {"shout": "reverse(upper(trim(value)))", "next": "cast(value as int) + 1"},
    }
    return mapped_feed(spark, sf_dir, config).customers.select(row_number(), "city", "code")


_BY_SQL = {
    "fieldMappings": {
        "code": {"from": "postal_code", "transform": "next"}, "town": {"from": "city", "transform": "other"},
    },
    "transforms": {"next": "cast(value as int) + 1", "other": "nullif(value, 'City 3')"},
}


@query("map_null_expr", """
    select row_number, nullif(city, 'City 3') as town,
      case when postal_code = 'n/a' then postal_code else cast(cast(postal_code as integer) + 1 as varchar) end as code
    from customer_feed""")
def map_null_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null that an expression gives is kept; only where it fails the raw value passes through."""
    return mapped_feed(spark, sf_dir, _BY_SQL).customers.select(row_number(), "town", "code")


@query("sql_transform_errors", """
    select row_number, 'cast(value as int) + 1 failed for: ' || postal_code as error
    from customer_feed where postal_code = 'n/a'""")
def sql_transform_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_feed(spark, sf_dir, _BY_SQL).errors.select(row_number(), "error")


def number_rule() -> PythonTransform:
    """A Python transform that fails on anything but a whole number."""

    def whole_number(value: str) -> str:
        if not value.isdecimal():
            raise ValueError(f"not a number: {value}")
        return str(int(value))

    return PythonTransform(whole_number)


@query("transform_errors", """
    select row_number, 'not a number: ' || postal_code as error from customer_feed where postal_code = 'n/a'""")
def transform_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a user-written Python transform, one per failing row."""
    config = {
        "fieldMappings": {"code": {"from": "postal_code", "transform": "number"}},
        "transforms": {"number": number_rule()},
    }
    return mapped_feed(spark, sf_dir, config, on_error="reject").errors.select(row_number(), "error")


@query("to_json_payload", f"""
    select row_number, cast(json_object('name', name, 'email', email, 'taxId', tax_id, 'companySize', company_size,
      'contact', json_object('firstName', first_name, 'lastName', last_name, 'phone', phone),
      'address', json_object('street', street, 'city', city, 'country', country, 'postalCode', postal_code),
      'metadata', json_object('source', 'csv_import', 'importedAt', '{STAMP}')) as varchar) as payload
    from mapped_feed""")
def to_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = mapped_feed(spark, sf_dir).customers
    return customers.select(row_number(), nested.record_json(customers.columns[1:]).alias("payload"))


@query("map_flattened", f"""
    select name, email, tax_id as "taxId", company_size as "companySize", first_name as "contact_firstName",
      last_name as "contact_lastName", phone as contact_phone, street as address_street, city as address_city,
      country as address_country, postal_code as "address_postalCode", 'csv_import' as metadata_source,
      '{STAMP}' as "metadata_importedAt"
    from mapped_feed""")
def map_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_customers(mapped_feed(spark, sf_dir).customers)


# --- scalar functions ---------------------------------------------------------------------------


@query("fn_trim", "select row_number, trim(company_name) as company_name from customer_feed")
def fn_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = F.lit("\t" + chr(0xFEFF) + chr(0xA0)), F.lit(chr(0x3000) + " \n")
    padded = F.concat(left, "company_name", right)
    return customer_feed(spark, sf_dir).select(row_number(), words.trimmed(padded).alias("company_name"))


@query("fn_lowercase", "select row_number, lower(trim(contact_email)) as email from customer_feed")
def fn_lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_feed(spark, sf_dir).select(row_number(), words.lowercase(F.col("contact_email")).alias("email"))


@query("fn_uppercase", "select row_number, upper(trim(country)) as country from customer_feed")
def fn_uppercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_feed(spark, sf_dir).select(row_number(), words.uppercase(F.col("country")).alias("country"))


@query("fn_clean_phone", "select row_number, phone from mapped_feed")
def fn_clean_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_feed(spark, sf_dir).select(row_number(), words.clean_phone(F.col("phone_number")).alias("phone"))


@query("fn_country_prefix", "select row_number, substr(country, 1, 2) as prefix from customer_feed")
def fn_country_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_feed(spark, sf_dir).select(row_number(), words.country_prefix(F.col("country")).alias("prefix"))


@query("empty_to_null", "select row_number, " + ", ".join(
    f"nullif({f}, '') as {t}" for f, t in STAGING_COLUMNS.items()) + " from customer_feed")
def empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_feed(spark, sf_dir).select(
        row_number(), *[words.empty_to_null(F.col(f)).alias(t) for f, t in STAGING_COLUMNS.items()]
    )


@query("from_json_props", "select event_id, cast(props->>'$.k' as integer) as k from events")
def from_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", nested.json_fields(F.col("props"), "k int")["k"].alias("k"))
