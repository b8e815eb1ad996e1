"""Feed rows to customer objects, from configuration."""

from __future__ import annotations

import datetime as dt
import json
import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.fixed import DEFAULT_MAPPING, SHIPPED_TRANSFORMS
from feedhouse.functions.text import clean_phone, lowercase, trimmed, uppercase
from feedhouse.functions.times import iso_stamp, stamp_literal, utc_now
from feedhouse.sources.tables import settle

NOW = "__NOW__"

BUILT_IN: dict[str, Callable[[Column], Column]] = {
    "trim": trimmed,
    "lowercase": lowercase,
    "uppercase": uppercase,
    "cleanPhone": clean_phone,
}


def load_config(path: str | None = None) -> dict:
    """Mapping configuration from a JSON file, or the default one."""
    if path is None:
        return DEFAULT_MAPPING
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


class PythonTransform:
    """A user function `str -> str`, run in Arrow batches. An error costs that value, not the run."""

    def __init__(self, fn: Callable[[str], str]):
        self.fn = fn

    def outcome(self, value: Column) -> Column:
        """struct(value, error): on an error the raw value and the error text."""
        fn = self.fn

        def attempt(text: str) -> tuple[str, str | None]:
            try:
                return fn(text), None
            except Exception as error:
                return text, str(error)

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame([attempt(v) for v in batch], columns=["value", "error"], dtype=object)

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        return F.pandas_udf(run, "value string, error string")(value)


# A transform takes the SQL text of the raw value and gives the mapped value.
Transform = Callable[[str], Column]


class SqlTransform:
    """A Spark SQL expression over `value`. What it gives is kept, null too; where it fails, as a cast of a bad value
    does, the raw value passes through and the failure is told. Sessions without ANSI mode give null there instead."""

    def __init__(self, text: str):
        self.text = text

    def outcome(self, raw: str) -> Column:
        """struct(value, error): on an error the raw value and the error text."""
        # The result is marked, so that null is a value like others. The one built-in that takes any failure inside it
        # for null is a conversion to bytes.
        marked = f"transform(array({raw}), value -> coalesce(concat('v', cast(({self.text}) as string)), 'n'))[0]"
        tried = F.expr(f"cast(try_to_binary({marked}, 'utf-8') as string)")
        failed = tried.isNull()
        value = F.when(failed, F.expr(raw)).when(tried != "n", F.substring(tried, 2, 2**31 - 1))
        error = F.when(failed, F.concat(F.lit(f"{self.text} failed for: "), F.expr(raw)))
        return F.struct(value.alias("value"), error.alias("error"))

    def resolves(self, spark: SparkSession) -> bool:
        try:
            spark.range(0).select(self.outcome("''"))
        except (AnalysisException, ParseException):
            return False
        return True


def build_transforms(spark: SparkSession, config: dict) -> dict[str, Transform | SqlTransform | PythonTransform]:
    """Named transforms of a configuration.

    The four shipped names are built in as long as their text is the shipped one, or their name. Any other takes a
    PythonTransform or a Spark SQL expression over `value`; one that does not resolve is left out with a
    warning, and its fields pass through.
    """
    built: dict[str, Transform | SqlTransform | PythonTransform] = {}
    for name, rule in (config.get("transforms") or {}).items():
        if isinstance(rule, PythonTransform):
            built[name] = rule
        elif name in BUILT_IN and rule in (name, SHIPPED_TRANSFORMS[name]):
            built[name] = lambda raw, fn=BUILT_IN[name]: fn(F.expr(raw))
        elif (made := SqlTransform(rule)).resolves(spark):
            built[name] = made
        else:
            warnings.warn(f'transform "{name}" is not a Spark SQL expression over value; its fields pass through')
    return built


def with_columns_of(config: dict, names: dict[str, str]) -> dict:
    """The configuration with its sources named as the columns that hold them (`field_names` of a header)."""

    def renamed(fields: dict) -> dict:
        return {t: {**r, "from": names.get(r["from"], r["from"])} if "from" in r else r for t, r in fields.items()}

    groups = {g: renamed(fields) for g, fields in (config.get("nestedMappings") or {}).items()}
    return {**config, "fieldMappings": renamed(config.get("fieldMappings") or {}), "nestedMappings": groups}


@dataclass
class Mapped:
    customers: DataFrame
    errors: DataFrame


def map_rows(
    rows: DataFrame,
    config: dict | None = None,
    run_at: dt.datetime | None = None,
    keep: Sequence[str] = ("_rowNumber",),
    on_error: str = "raw",
) -> Mapped:
    """Customer objects: flat fields, then one struct per group, after the `keep` columns.

    A transform error is listed with its row; the row stays with the raw value (`on_error='raw'`) or is
    left out (`on_error='reject'`). Built-in transforms have no errors.
    """
    config = config or DEFAULT_MAPPING
    transforms = build_transforms(rows.sparkSession, config)
    stamp = iso_stamp(stamp_literal(run_at or utc_now()))
    outcomes: dict[str, Column] = {}
    slow: list[bool] = []

    def mapped(rule: dict) -> Column:
        if "value" in rule:
            return stamp if rule["value"] == NOW else F.lit(rule["value"])
        source = rule["from"]
        raw = f"coalesce(`{source}`, '')" if source in rows.columns else "''"
        transform = transforms.get(rule.get("transform"))
        if transform is None:
            return F.expr(raw)
        if isinstance(transform, (PythonTransform, SqlTransform)):
            name = f"_outcome{len(outcomes)}"
            slow.append(isinstance(transform, PythonTransform))
            outcomes[name] = transform.outcome(F.expr(raw) if slow[-1] else raw)
            return F.col(name)["value"]
        return transform(raw)

    # Constants are for grouped fields only; a flat rule without a source maps the missing column.
    flat = {t: mapped({"from": r.get("from"), "transform": r.get("transform")})
            for t, r in (config.get("fieldMappings") or {}).items()}
    groups = {
        group: F.struct(*[mapped(rule).alias(target) for target, rule in fields.items()])
        for group, fields in (config.get("nestedMappings") or {}).items()
    }
    columns = [c.alias(name) for name, c in {**flat, **groups}.items()]
    if not outcomes:
        none = rows.sparkSession.createDataFrame([], "_rowNumber bigint, error string")
        return Mapped(rows.select(*keep, *columns), none)
    tried = rows.withColumns(outcomes)
    if any(slow):
        # Written once: customers and errors both come from it, and each value is tried a single time.
        tried = settle(tried, "tried").frame
    first_error = F.coalesce(*[F.col(name)["error"] for name in outcomes])
    errors = tried.where(first_error.isNotNull()).select("_rowNumber", first_error.alias("error"))
    kept = tried.where(first_error.isNull()) if on_error == "reject" else tried
    return Mapped(kept.select(*keep, *columns), errors)


def flat_customers(customers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Grouped fields as plain columns `group_field`."""
    columns = list(keep)
    for field in customers.schema.fields:
        if field.name in keep or field.name.startswith("_"):
            continue
        if hasattr(field.dataType, "fields"):
            columns += [
                F.col(f"{field.name}.{sub.name}").alias(f"{field.name}_{sub.name}") for sub in field.dataType.fields
            ]
        else:
            columns.append(F.col(field.name))
    return customers.select(*columns)
