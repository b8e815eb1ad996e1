"""Data quality of a feed: row issues, duplicates, null rates, drift, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.fixed import (
    COUNTRY_CODES, DQ_REQUIRED_FIELDS, EXPECTED_FIELDS, HASH_FIELDS, NULL_RATE_HIGH, NULL_RATE_WARN,
)
from feedhouse.functions.numbers import count_where, half_up, number_text
from feedhouse.functions.text import (
    compact_texts, content_hash, is_blank, is_email, is_phone, trimmed, uppercase,
)
from feedhouse.operators.history import staged_among
from feedhouse.operators.spread import lookup, settle_keyed
from feedhouse.sources.tables import Settled, side_by_side


def field_or_null(columns: Sequence[str], name: str) -> Column:
    return F.col(name) if name in columns else F.lit(None).cast("string")


def in_file(key: Column) -> Column:
    """A key that holds within its file only."""
    return F.concat(F.col("_sourceFile"), F.lit("\x01"), key)


def with_keys(rows: DataFrame) -> DataFrame:
    """Add `_sourceHash`, `_emailKey` and `_emailScope`, the keys duplicates are found by.

    A blank email has no key. An email repeats within its file only, so files loaded together give the same rows
    as files loaded one by one; `_emailScope` is the email in its file, where rows know their file.
    """
    email = F.nullif(trimmed(F.lower(field_or_null(rows.columns, "contact_email"))), F.lit(""))
    scope = in_file(email) if "_sourceFile" in rows.columns else email
    return rows.withColumns({
        "_sourceHash": content_hash([field_or_null(rows.columns, f) for f in HASH_FIELDS]),
        "_emailKey": email,
        "_emailScope": scope,
    })


@dataclass
class Repeats:
    """Keys that need attention: hashes seen twice or loaded before, and emails seen twice.

    `contested` has the first row per file of hashes that more than one file may bring first.
    """

    hashes: Settled
    emails: Settled
    contested: Settled | None = None


def hash_profile(
    keyed: DataFrame, history: DataFrame | None, order: str, feed_rows: int | None = None, kept: Column | None = None
) -> DataFrame:
    """First place, count and loaded flag of each hash that occurs twice or was loaded before.

    `_keptRow` is the first place of a row that staging takes (`kept`; all by default), `_refused` whether there is
    one that it does not take, `_spans` whether the hash is in several files.

    Rows are combined per hash before anything is shuffled, and history is joined to the combined rows,
    so a hash held by any share of the rows costs one record per input partition. Where the number of rows is known
    (`feed_rows`) the feed's hashes are sent to the history instead, which then is read but not moved.
    """
    kept = F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))
    file = F.col("_sourceFile") if "_sourceFile" in keyed.columns else F.lit("")
    firsts = keyed.groupBy("_sourceHash").agg(
        F.min(order).alias("_firstRow"), F.min(F.when(kept, F.col(order))).alias("_keptRow"),
        F.max(~kept).alias("_refused"), (F.min(file) != F.max(file)).alias("_spans"), F.count(F.lit(1)).alias("n"),
    )
    if history is None:
        return firsts.where("n > 1").withColumn("_loaded", F.lit(False))
    if feed_rows is None:
        loaded = history.select(F.col("source_hash").alias("_sourceHash")).distinct()
    else:
        loaded = staged_among(keyed.select("_sourceHash"), history, feed_rows)
    loaded = loaded.withColumn("_loaded", F.lit(True))
    return (
        firsts.join(loaded, "_sourceHash", "left")
        .withColumn("_loaded", F.coalesce("_loaded", F.lit(False)))
        .where("n > 1 or _loaded")
    )


def email_profile(keyed: DataFrame, order: str) -> DataFrame:
    """First place and count of each email that occurs twice in a file. Blank emails are left out beforehand."""
    return (
        keyed.where(F.col("_emailScope").isNotNull())
        .groupBy("_emailScope")
        .agg(F.min(order).alias("_firstEmailRow"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def contested_profile(keyed: DataFrame, hashes: Settled, order: str, reload: bool) -> Settled | None:
    """First place and count per file of the hashes that more than one file may bring first; None if there are none.

    Loaded one by one, a file meets what earlier files left in staging. So a row counts as the first of its file where
    no earlier file had it staged: where staging refused it there, or in a reload, which looks at no history.
    """
    open_hashes = hashes.frame.where(F.col("_spans") & (F.lit(reload) | F.col("_refused")))
    if open_hashes.isEmpty():
        return None
    scoped = keyed.join(open_hashes.select("_sourceHash"), "_sourceHash", "left_semi")
    firsts = scoped.groupBy(in_file(F.col("_sourceHash")).alias("_hashScope")).agg(
        F.min(order).alias("_firstInFile"), F.count(F.lit(1)).alias("n"))
    return settle_keyed(firsts, "contested-hashes")


def find_repeated_rows(
    keyed: DataFrame, history: DataFrame | None = None, order: str = "_rowNumber", feed_rows: int | None = None,
    kept: Column | None = None,
) -> Settled:
    return settle_keyed(hash_profile(keyed, history, order, feed_rows, kept), "hashes")


def find_repeated_emails(keyed: DataFrame, order: str = "_rowNumber") -> Settled:
    return settle_keyed(email_profile(keyed, order), "emails")


def find_repeats(
    keyed: DataFrame, history: DataFrame | None = None, order: str = "_rowNumber", feed_rows: int | None = None,
    kept: Column | None = None, reload: bool = False,
) -> Repeats:
    hashes, emails = side_by_side(
        lambda: find_repeated_rows(keyed, history, order, feed_rows, kept), lambda: find_repeated_emails(keyed, order)
    )
    contested = contested_profile(keyed, hashes, order, reload) if "_sourceFile" in keyed.columns else None
    return Repeats(hashes, emails, contested)


def flag_duplicate_rows(
    keyed: DataFrame, hashes: Settled, order: str = "_rowNumber", contested: Settled | None = None,
    reload: bool = False, **how,
) -> DataFrame:
    """Add `_loaded` (hash in history), `_duplicateRow` (loaded, or not the first row with its hash) and `_met`.

    Where rows know their file, `order` is a struct of file and row, and what staging took from an earlier file counts
    as loaded, except in a reload; `_met` says that an earlier file had the row staged.
    """
    found = lookup(keyed, hashes, "_sourceHash", order, **how)
    loaded = F.coalesce("_loaded", F.lit(False))
    later = F.coalesce(F.col(order) > F.col("_firstRow"), F.lit(False))
    extra = ["_firstRow", "_keptRow", "_refused", "_spans", "n"]
    if "_sourceFile" not in keyed.columns:
        found = found.withColumns({"_loaded": loaded, "_duplicateRow": loaded | later, "_met": F.lit(False)})
        return found.drop(*extra)
    met = F.coalesce(F.col("_keptRow.file") < F.col(f"{order}.file"), F.lit(False))
    if not reload:
        loaded = loaded | met
    if contested is not None:
        found = lookup(found.drop("n").withColumn("_hashScope", in_file(F.col("_sourceHash"))), contested,
                       "_hashScope", order, **how)
        later = F.when(F.col("_firstInFile").isNotNull(), F.col(order) > F.col("_firstInFile")).otherwise(later)
        extra += ["_firstInFile", "_hashScope"]
    return found.withColumns({"_loaded": loaded, "_duplicateRow": loaded | later, "_met": met}).drop(*extra)


def flag_duplicate_emails(keyed: DataFrame, emails: Settled, order: str = "_rowNumber", **how) -> DataFrame:
    """Add `_duplicateEmail`: not the first row of its file with its email, whatever the state of that first row."""
    found = lookup(keyed, emails, "_emailScope", order, **how)
    later = F.coalesce(F.col(order) > F.col("_firstEmailRow"), F.lit(False))
    return found.withColumn("_duplicateEmail", later).drop("_firstEmailRow", "n")


def format_issues(columns: Sequence[str], country_codes: Sequence[str] = COUNTRY_CODES) -> list[Column]:
    """Issues a row shows by itself, in report order; null where there is none."""
    country = uppercase(field_or_null(columns, "country"))
    phone = trimmed(field_or_null(columns, "phone_number"))
    email = trimmed(field_or_null(columns, "contact_email"))
    nulls = [
        F.when(is_blank(field_or_null(columns, f)), F.lit(f"NULL_REQUIRED:{f}")) for f in DQ_REQUIRED_FIELDS
    ]
    return [
        *nulls,
        F.when((country != "") & ~country.isin(list(country_codes)), F.concat(F.lit("INVALID_COUNTRY:"), country)),
        F.when((phone != "") & ~is_phone(phone), F.concat(F.lit("INVALID_PHONE:"), phone)),
        F.when((email != "") & ~is_email(email), F.concat(F.lit("INVALID_EMAIL_FORMAT:"), email)),
    ]


def enrich(
    rows: DataFrame,
    history: DataFrame | None = None,
    order: str = "_rowNumber",
    country_codes: Sequence[str] = COUNTRY_CODES,
    feed_rows: int | None = None,
    kept: Column | None = None,
    reload: bool = False,
    **how,
) -> DataFrame:
    """Add `_sourceHash`, `_qualityIssues`, `_isClean` and the flags `_loaded`, `_duplicateRow`, `_met`.

    `history` holds the column `source_hash` of rows loaded before; `feed_rows` is the number of rows where
    it is known; `kept` tells the rows that staging takes. Files loaded together, in the order of their names, give
    the same flags as one by one. A reload looks at no history, that of earlier files included.
    """
    keyed = with_keys(rows)
    repeats = find_repeats(keyed, history, order, feed_rows, kept, reload)
    flagged = flag_duplicate_rows(keyed, repeats.hashes, order, repeats.contested, reload, **how)
    flagged = flag_duplicate_emails(flagged, repeats.emails, order, **how)
    issues = compact_texts(
        F.when(F.col("_duplicateRow"), F.lit("DUPLICATE_ROW")),
        F.when(F.col("_duplicateEmail"), F.concat(F.lit("DUPLICATE_EMAIL:"), F.col("_emailKey"))),
        *format_issues(rows.columns, country_codes),
    )
    return (
        flagged.withColumn("_qualityIssues", issues)
        .withColumn("_isClean", F.size("_qualityIssues") == 0)
        .select(*rows.columns, "_sourceHash", "_qualityIssues", "_isClean", "_loaded", "_duplicateRow", "_met")
    )


def clean_rows(enriched: DataFrame) -> DataFrame:
    return enriched.where("_isClean")


def null_counts(columns: Sequence[str]) -> list[Column]:
    """One count of blank values per expected field; an absent field is blank everywhere."""
    return [count_where(is_blank(field_or_null(columns, f))).alias(f) for f in EXPECTED_FIELDS]


def null_profile(rows: DataFrame) -> DataFrame:
    """Field, blank count and percentage (rounded and exact), from one pass over the rows."""
    counts = rows.agg(F.count(F.lit(1)).alias("_total"), *null_counts(rows.columns))
    return profile_from_counts(counts)


def profile_from_counts(counts: DataFrame) -> DataFrame:
    """The profile for one row of `_total` and one count per expected field."""
    pairs = ", ".join(f"'{f}', coalesce(`{f}`, 0)" for f in EXPECTED_FIELDS)
    long = counts.selectExpr(
        "_total", f"stack({len(EXPECTED_FIELDS)}, {pairs}) as (field, null_count)"
    )
    exact = F.when(F.col("_total") > 0, F.col("null_count") / F.col("_total") * 100).otherwise(F.lit(0.0))
    place = F.array_position(F.array(*[F.lit(f) for f in EXPECTED_FIELDS]), F.col("field"))
    return long.select(
        place.cast("int").alias("field_order"), "field", "null_count",
        exact.alias("exact_pct"), half_up(exact, 2).alias("null_pct"),
    )


def high_null_fields(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("exact_pct") > NULL_RATE_WARN).select(
        "field_order",
        F.lit("HIGH_NULL_RATE").alias("type"),
        F.when(F.col("exact_pct") > NULL_RATE_HIGH, "HIGH").otherwise("MEDIUM").alias("severity"),
        "field",
        "null_pct",
        F.concat(F.lit('Field "'), "field", F.lit('" is '), number_text(F.col("null_pct")), F.lit("% null"))
        .alias("message"),
    )


def quality_summary(enriched: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    counts = enriched.agg(
        total.alias("total_rows"),
        count_where(F.col("_isClean")).alias("clean_rows"),
        count_where(~F.col("_isClean")).alias("rows_with_issues"),
        count_where(F.col("_duplicateRow")).alias("duplicates_found"),
    )
    counts = counts.na.fill(0)
    return counts.withColumn("quality_score", quality_score(F.col("clean_rows"), F.col("total_rows")))


def quality_score(clean: Column, total: Column) -> Column:
    """Clean share in whole percent; 100 for an empty feed."""
    return F.when(total > 0, half_up(clean / F.nullif(total, F.lit(0)) * 100)).otherwise(100).cast("bigint")


def row_issue_list(enriched: DataFrame, row: str = "_rowNumber") -> DataFrame:
    """Rows with issues, unsorted; `ordered_issues` gives them in row order."""
    return enriched.where(~F.col("_isClean")).select(row, F.col("_qualityIssues").alias("issue_types"))


def ordered_issues(enriched: DataFrame, order: str = "_rowOrder") -> DataFrame:
    """Rows with issues in the order of files and rows, for export: a range sort, no single task."""
    place = [c for c in ("_sourceFile", "_rowNumber") if c in enriched.columns]
    return enriched.where(~F.col("_isClean")).orderBy(order).select(*place, F.col("_qualityIssues").alias("issue_types"))


def duplicate_list(enriched: DataFrame, row: str = "_rowNumber") -> DataFrame:
    company = field_or_null(enriched.columns, "company_name")
    return enriched.where("_duplicateRow").select(
        row, company.alias("company"), F.col("_sourceHash").alias("hash")
    )


@dataclass
class Drift:
    missing: list[str]
    unexpected: list[str]


def schema_drift(header: Sequence[str]) -> Drift:
    """Header against the expected fields, with raw names: a padded name counts as drift."""
    return Drift(
        [f for f in EXPECTED_FIELDS if f not in header],
        [h for h in header if h not in EXPECTED_FIELDS and h != "_rowNumber"],
    )


ISSUE_SCHEMA = "issue_order int, type string, severity string, field string, null_pct double, message string"


def drift_issues(spark: SparkSession, drift: Drift) -> DataFrame:
    found = []
    if drift.missing:
        text = f"Missing expected fields: {', '.join(drift.missing)}"
        found.append((1, "SCHEMA_DRIFT", "HIGH", None, None, text))
    if drift.unexpected:
        text = f"Unexpected fields found: {', '.join(drift.unexpected)}"
        found.append((2, "SCHEMA_DRIFT", "LOW", None, None, text))
    return spark.createDataFrame(found, ISSUE_SCHEMA)


def dataset_issues(profile: DataFrame, drift: Drift) -> DataFrame:
    """Drift first, then fields with a high null rate in field order."""
    nulls = high_null_fields(profile).withColumn("issue_order", F.col("field_order") + 2).drop("field_order")
    return drift_issues(profile.sparkSession, drift).unionByName(nulls)


def file_report(at: str) -> Column:
    """The quality report of a file as JSON, from its row of figures: `_names` (raw header), `total`, `clean`,
    `duplicates` and `null_<field>` per expected field."""
    expected = F.array(*[F.lit(f) for f in EXPECTED_FIELDS])
    missing = F.array_except(expected, F.col("_names"))
    unexpected = F.filter("_names", lambda n: ~n.isin([*EXPECTED_FIELDS, "_rowNumber"]))
    total, clean = F.col("total"), F.col("clean")
    exact = {f: F.when(total > 0, F.col(f"null_{f}") / total * 100).otherwise(F.lit(0.0)) for f in EXPECTED_FIELDS}
    rounded = {f: half_up(e, 2) for f, e in exact.items()}

    def issue(kind: str, severity: Column | str, message: Column, **more: Column) -> Column:
        severity = F.lit(severity) if isinstance(severity, str) else severity
        none = {"field": F.lit(None).cast("string"), "null_pct": F.lit(None).cast("double")}
        return F.struct(F.lit(kind).alias("type"), severity.alias("severity"),
                        *[more.get(c, n).alias(c) for c, n in none.items()], message.alias("message"))

    def drift(names: Column, severity: str, text: str) -> Column:
        found = issue("SCHEMA_DRIFT", severity, F.concat(F.lit(text), F.concat_ws(", ", names)))
        return F.when(F.size(names) > 0, found)

    def high(field: str) -> Column:
        severity = F.when(exact[field] > NULL_RATE_HIGH, "HIGH").otherwise("MEDIUM")
        text = F.concat(F.lit(f'Field "{field}" is '), number_text(rounded[field]), F.lit("% null"))
        return F.when(exact[field] > NULL_RATE_WARN, issue(
            "HIGH_NULL_RATE", severity, text, field=F.lit(field), null_pct=rounded[field]))

    issues = F.array_compact(F.array(
        drift(missing, "HIGH", "Missing expected fields: "), drift(unexpected, "LOW", "Unexpected fields found: "),
        *map(high, EXPECTED_FIELDS)))
    summary = F.struct(
        total.alias("totalRows"), clean.alias("cleanRows"), (total - clean).alias("rowsWithIssues"),
        F.col("duplicates").alias("duplicatesFound"), quality_score(clean, total).alias("qualityScore"))
    return F.to_json(F.struct(
        F.lit(at).alias("generatedAt"), summary.alias("summary"),
        F.struct(missing.alias("missingFields"), unexpected.alias("unexpectedFields")).alias("schemaDrift"),
        F.struct(*[rounded[f].alias(f) for f in EXPECTED_FIELDS]).alias("nullPercentages"),
        issues.alias("datasetIssues")))
