"""Table constraints as splits: rows that pass, and rejects with the reason."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedhouse.functions.text import compact_texts


def null_error(column: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit(f"null value in column {column}"))


def length_error(column: str, limit: int) -> Column:
    return F.when(F.char_length(column) > limit, F.lit(f"value too long for column {column} ({limit})"))


def range_error(column: str, precision: int, scale: int, kind: str = "double") -> Column:
    """Values that do not fit `decimal(precision, scale)` after rounding half up. A comparison, since a cast
    of each value is many times slower."""
    limit = Decimal(10) ** (precision - scale) - Decimal(5).scaleb(-scale - 1)
    text = F.lit(f"value out of range for column {column} ({precision},{scale})")
    value = F.abs(F.col(column))
    # Decimals are compared as decimals, exactly; NaN and infinity of other types are out of range.
    bound = F.lit(limit) if kind.startswith("decimal") else F.lit(float(limit))
    return F.when(~((value if kind.startswith("decimal") else value.cast("double")) < bound), text)


def check_rows(
    df: DataFrame,
    not_null: Sequence[str] = (),
    lengths: dict[str, int] | None = None,
    ranges: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Add `_rejects`, the constraint errors of each row; an over-long value is an error, never cut."""
    tests = [null_error(c) for c in not_null]
    tests += [length_error(c, n) for c, n in (lengths or {}).items() if c in df.columns]
    kinds = dict(df.dtypes)
    tests += [range_error(c, p, s, kinds[c]) for c, (p, s) in (ranges or {}).items()]
    return df.withColumn("_rejects", compact_texts(*tests))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_rejects") == 0).drop("_rejects")


def rejects(checked: DataFrame, stage: str, key: str) -> DataFrame:
    """One row per rejected row: `stage`, `key`, `error`."""
    return checked.where(F.size("_rejects") > 0).select(
        F.lit(stage).alias("stage"), F.col(key).cast("string").alias("key"), F.concat_ws("; ", "_rejects").alias("error")
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-null keys that occur more than once, with their counts."""
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    )


def repeat_errors(repeated: DataFrame, stage: str, key: str) -> DataFrame:
    """Repeated keys (`key`, `n_rows`) in the form of `rejects`."""
    text = F.concat(F.lit(f"repeated {key} ("), F.col("n_rows").cast("string"), F.lit(" rows)"))
    return repeated.select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("key"), text.alias("error"))


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add absent columns from `defaults`. A null that is given stays null, as in an insert that names the column."""
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})


def reference_errors(violations: DataFrame, row_key: str) -> DataFrame:
    """Reference violations in the form of `rejects`."""
    text = F.concat(F.lit("missing "), "constraint_name", F.lit(" "), F.col("bad_key").cast("string"))
    return violations.select(
        F.lit("fact").alias("stage"), F.col(row_key).cast("string").alias("key"), text.alias("error")
    )


def load_errors(*parts: DataFrame) -> DataFrame:
    """Rejects of all load steps in one table."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
