"""Dates, stamps and durations. The session time zone is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def date_key(c: Column) -> Column:
    """20240131 for 2024-01-31."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def iso_stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def elapsed_ms(start: Column, end: Column) -> Column:
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def stamp_literal(moment: dt.datetime) -> Column:
    """Literal timestamp; a moment without zone is taken as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(int(round(moment.timestamp() * 1_000_000))))
