"""Validation rules from configuration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.fixed import DEFAULT_RULES
from feedhouse.functions.numbers import count_where
from feedhouse.functions.text import compact_texts, is_blank, is_email, trimmed

# A rule gets a configured field and its value, None where rows lack it, and gives the error text, or null where the
# row passes.
Rule = Callable[[str, "Column | None"], Column]


def _required(field: str, value: Column | None) -> Column:
    missing = F.lit(True) if value is None else is_blank(value)
    return F.when(missing, F.lit(f'Missing required field: "{field}"'))


def _email(field: str, value: Column | None) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    value = trimmed(value)
    text = F.concat(F.lit(f'Invalid email format in field "{field}": "'), value, F.lit('"'))
    return F.when((value != "") & ~is_email(value), text)


def _non_empty(field: str, value: Column | None) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    # A null stands for a field that the row's file lacks.
    return F.when(value.isNotNull() & is_blank(value), F.lit(f'Field "{field}" must not be empty.'))


# In the order their errors are listed; other names in a configuration are ignored.
RULES: dict[str, Rule] = {"required": _required, "email": _email, "nonEmpty": _non_empty}


def error_list(
    columns: list[str], rules: dict[str, list[str]] | None = None, names: dict[str, str] | None = None
) -> Column:
    """The ordered error texts of a row.

    `names` gives the columns that hold the fields of a header (`field_names`); without it fields are columns. Texts
    have the configured name. Names are told apart by case.
    """
    rules = DEFAULT_RULES if rules is None else rules
    names = {c: c for c in columns} if names is None else {f: c for f, c in names.items() if c in columns}

    def value(field: str) -> Column | None:
        return F.col("`" + names[field].replace("`", "``") + "`") if field in names else None

    texts = [rule(field, value(field)) for name, rule in RULES.items() for field in rules.get(name) or []]
    return compact_texts(*texts) if texts else F.array().cast("array<string>")


def validate(
    rows: DataFrame, rules: dict[str, list[str]] | None = None, names: dict[str, str] | None = None
) -> DataFrame:
    """Add `errors`, the ordered error texts of each row."""
    return rows.withColumn("errors", error_list(rows.columns, rules, names))


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") == 0).drop("errors")


def invalid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("errors") > 0)


def validation_summary(validated: DataFrame) -> DataFrame:
    good = F.size("errors") == 0
    return validated.agg(
        F.count(F.lit(1)).alias("total"), count_where(good).alias("valid"), count_where(~good).alias("invalid")
    )
