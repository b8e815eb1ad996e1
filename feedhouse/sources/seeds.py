"""Seed rows and the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.fixed import COUNTRY_SEED, DATE_SPINE
from feedhouse.functions.times import date_key


def country_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_SEED, "country_code string, country_name string, region string")


def insert_absent(existing: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Existing rows, and the seed rows whose key they lack."""
    absent = seed.join(existing.select(key), key, "left_anti")
    return existing.unionByName(absent, allowMissingColumns=True)


def date_columns(day: Column) -> list[Column]:
    weekday = F.dayofweek(day) - 1
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.quarter(day).alias("fiscal_quarter"),
    ]


def date_dimension(spark: SparkSession, first: str = DATE_SPINE[0], last: str = DATE_SPINE[1]) -> DataFrame:
    """One row per day from `first` to `last`; Sunday is day 0, weeks are ISO weeks."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"))
    return spread_days(bounds)


def spread_days(bounds: DataFrame) -> DataFrame:
    """The dimension for one row of `first`, `last`."""
    days = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date"))
    return days.select(*date_columns(F.col("full_date")))
