"""The load job: feed files to quality report, staging, customer dimension, facts and run log."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.fixed import (
    COUNTRY_CODES, CUSTOMER_LENGTHS, DATE_SPINE, DEFAULT_MAPPING, EXPECTED_FIELDS, STAGING_LENGTHS,
)
from feedhouse.functions.numbers import count_where
from feedhouse.functions.times import date_key, stamp_literal, utc_now
from feedhouse.operators import checks, delivery, dimension, facts, history, quality, rules, runs, staging
from feedhouse.operators.mapping import map_rows, with_columns_of
from feedhouse.operators.ranks import growing_key
from feedhouse.operators.spread import settle_keyed
from feedhouse.plans.schemas import TABLES
from feedhouse.session import delete_path, require_utc, scratch_path
from feedhouse.sources import seeds
from feedhouse.sources.records import Feed, field_names, read_feed
from feedhouse.sources.tables import EventLog, Settled, Warehouse, Written, settle

ORDER = "_rowOrder"
KEEP = ("_sourceFile", "_rowNumber", ORDER)
MAPPED = {"fieldMappings", "nestedMappings"}

# Customer objects in, attempt log out: `email`, `attempt`, `status`, and optionally `error`, `response_id`, `name`
# and `_rowOrder` (needed only where an email is sent more than once).
Deliver = Callable[[DataFrame], DataFrame]


@dataclass
class LoadResult:
    run_id: str
    status: str
    metrics: runs.RunMetrics
    dq_report: dict
    report: dict
    counts: dict
    # Where the run wrote its row, error and outcome tables and its report.
    folder: str
    tables: dict[str, DataFrame] = field(default_factory=dict)


def read_table(warehouse: Warehouse, name: str) -> DataFrame | None:
    return warehouse.read(name, TABLES[name])


def run_events(warehouse: Warehouse) -> EventLog:
    return EventLog(warehouse.spark, warehouse.root, "run_events", runs.EVENT_SCHEMA)


def run_log(warehouse: Warehouse) -> DataFrame:
    """`pipeline_runs`: the current state of every run; empty where nothing ran yet."""
    return runs.fold_events(run_events(warehouse).read())


def log_event(warehouse: Warehouse, event: DataFrame) -> None:
    run_events(warehouse).append(event.coalesce(1))


def processed_staging(warehouse: Warehouse) -> DataFrame:
    """Staging with `is_processed` and `processed_at`."""
    ended = run_log(warehouse).where(F.col("status").isin("success", "partial"))
    ended = ended.select("run_id", F.col("completed_at").alias("processed_at"))
    staged = read_table(warehouse, "stg_customers")
    if staged is None:
        staged = warehouse.spark.createDataFrame([], TABLES["stg_customers"])
    return staging.with_processed(staged, ended)


def warehouse_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The tables the views read; a table nothing was loaded to yet is empty."""
    tables = {}
    for name, schema in TABLES.items():
        found = read_table(warehouse, name)
        tables[name] = found if found is not None else warehouse.spark.createDataFrame([], schema)
    tables["pipeline_runs"] = run_log(warehouse)
    return tables


UNIQUE = {
    "stg_customers": ["source_hash"], "dim_customer": ["contact_email", "customer_key"],
    "dim_country": ["country_code", "country_key"], "dim_import_date": ["date_key"],
}
REFERENCES = {"customer_key": "dim_customer", "country_key": "dim_country", "date_key": "dim_import_date"}


def constraint_errors(warehouse: Warehouse, since: str | None = None) -> DataFrame:
    """`stage`, `key`, `error` for stored rows that break a constraint: keys that occur more than once, and references of
    facts that lead nowhere, of the months from `since` (yyyy-MM) on if given, whose folders alone are read then.

    A load keeps both by construction, as it numbers keys and looks references up; it lists itself what it cannot
    keep: emails that the stored dimension has twice, and a day without a date row. This is for tables that something
    else has written to.
    """
    tables = warehouse_tables(warehouse)
    parts = [
        checks.repeat_errors(checks.repeated_keys(tables[name], key), name, key)
        for name, keys in UNIQUE.items() for key in keys
    ]
    rows = tables["fact_customer_imports"]
    if since is not None:
        rows = rows.where(F.col("import_month") >= since)
    violations = facts.reference_violations(
        rows, "import_key", {key: (tables[name], key) for key, name in REFERENCES.items()})
    return checks.load_errors(*parts, checks.reference_errors(violations, "import_key"))


def prepare(warehouse: Warehouse, at: dt.datetime | None = None, spine: tuple[str, str] = DATE_SPINE) -> None:
    """Create the warehouse if need be and seed the country and date dimensions, each key once."""
    at = at or utc_now()
    warehouse.create()
    spark, written, load_id = warehouse.spark, {}, f"seed-{uuid.uuid4()}"
    existing = read_table(warehouse, "dim_country")
    if existing is None:
        existing = spark.createDataFrame([], TABLES["dim_country"])
    merged = seeds.insert_absent(existing, seeds.country_seed(spark), "country_code")
    absent = merged.where(F.col("country_key").isNull()).coalesce(1)
    if absent.limit(1).count():
        free = warehouse.last_key("dim_country") + 1
        added = absent.withColumns(
            {"country_key": growing_key(free), "is_valid": F.lit(True), "created_at": stamp_literal(at)}
        )
        path = warehouse.new_path("dim_country", load_id)
        done = settle(added, "dim_country", path, last=F.max("country_key"))
        written["dim_country"] = Written(path, last_key=done.stats["last"], rows=done.rows)
    if read_table(warehouse, "dim_import_date") is None:
        path = warehouse.new_path("dim_import_date", load_id)
        settle(seeds.date_dimension(spark, *spine).coalesce(1), "dim_import_date", path)
        written["dim_import_date"] = Written(path)
    if written:
        warehouse.commit(load_id, written, at)


def assess(
    feed: Feed, loaded: DataFrame | None, validation: dict | None, country_codes: Sequence[str], path: str,
    reload: bool = False,
) -> Settled:
    """All rows with errors, issues and flags, written once; every count of the reports is taken on the way."""
    kept = staging.insertable(feed.rows.columns)
    enriched = quality.enrich(feed.rows, loaded, ORDER, country_codes, feed.lines, kept, reload)
    assessed = rules.validate(enriched, validation, field_names(feed.header))
    figures = {
        "valid": count_where(F.size("errors") == 0),
        "clean": count_where(F.col("_isClean")),
        "duplicates": count_where(F.col("_duplicateRow")),
        "new": count_where(~F.col("_loaded")),
        **{f"null_{f}": c for f, c in zip(EXPECTED_FIELDS, quality.null_counts(feed.rows.columns))},
    }
    return settle(assessed, "rows", path, **figures)


def quality_report(spark: SparkSession, header: Sequence[str], assessed: Settled, at: dt.datetime) -> dict:
    """Summary, drift, null rates and dataset issues. Row issues and duplicates stay in the row table."""
    stats = {name: value or 0 for name, value in assessed.stats.items()}
    counts = [(assessed.rows, *[stats[f"null_{f}"] for f in EXPECTED_FIELDS])]
    schema = ", ".join(f"{c} bigint" for c in ["_total", *EXPECTED_FIELDS])
    profile = quality.profile_from_counts(spark.createDataFrame(counts, schema))
    drift = quality.schema_drift(header)
    issues = quality.dataset_issues(profile, drift).orderBy("issue_order").drop("issue_order").collect()
    score = int(stats["clean"] / assessed.rows * 100 + 0.5) if assessed.rows else 100
    return {
        "generatedAt": at.isoformat(),
        "summary": {
            "totalRows": assessed.rows,
            "cleanRows": stats["clean"],
            "rowsWithIssues": assessed.rows - stats["clean"],
            "duplicatesFound": stats["duplicates"],
            "qualityScore": score,
        },
        "schemaDrift": {"missingFields": drift.missing, "unexpectedFields": drift.unexpected},
        "nullPercentages": {r.field: r.null_pct for r in profile.collect()},
        "datasetIssues": [{k: v for k, v in r.asDict().items() if v is not None} for r in issues],
    }


def run_of_file(load: str) -> Column:
    """The run id of a file within a load of many, told from its name."""
    return F.substring(F.sha2(F.concat(F.lit(f"{load}\x01"), F.col("_sourceFile")), 256), 1, 32)


@dataclass
class _Run:
    run_id: str
    at: dt.datetime
    version: str
    # Differs from attempt to attempt, so that a run can be started again under its id.
    load_id: str
    folder: str
    full_reload: bool
    # With a run for each file: `_sourceFile`, `run_id` (see `run_of_file`) and raw header `_names` of each.
    files: DataFrame | None = None
    committed: bool = False

    def of_row(self) -> Column:
        """The run that a row with `_sourceFile` belongs to."""
        return F.lit(self.run_id) if self.files is None else run_of_file(self.run_id)


@dataclass
class _Loaded:
    written: dict[str, Written] = field(default_factory=dict)
    errors: list[DataFrame] = field(default_factory=list)
    counts: dict = field(default_factory=dict)
    facts: DataFrame | None = None


def _load_staging(
    wh: Warehouse, assessed: DataFrame, new: int, loaded: DataFrame | None, run: _Run, out: _Loaded
) -> None:
    rows = staging.staging_rows(assessed, run.of_row(), run.at, run.version)
    if run.full_reload and loaded is not None:
        # History was not looked at before; the hash of a staged row still stays unique.
        known = history.staged_among(rows.select(F.col("source_hash").alias("_sourceHash")), loaded, new)
        rows = rows.join(known.withColumnRenamed("_sourceHash", "source_hash"), "source_hash", "left_anti")
    checked = checks.check_rows(rows, lengths=STAGING_LENGTHS)
    path = wh.new_path("stg_customers", run.load_id)
    digits = history.prefix_digits(new)
    placed = checks.accepted(checked).withColumn(history.PREFIX, history.hash_prefix(F.col("source_hash"), digits))
    if digits:
        # Each folder is written by a task per two million rows, about.
        files = max(16**digits, new // history.FOLDER_ROWS)
        salt = F.pmod(F.xxhash64("source_hash"), F.lit(-(-files // 16**digits)))
        placed = placed.repartition(files, history.PREFIX, salt)
    keyed = placed.withColumn("stg_id", growing_key(wh.last_key("stg_customers") + 1))
    done = settle(keyed, "stg_customers", path, history.PREFIX, last=F.max("stg_id"))
    out.written["stg_customers"] = Written(path, last_key=done.stats["last"], rows=done.rows)
    out.errors.append(checks.rejects(checked, "staging", "source_row"))


def _load_customers(
    wh: Warehouse, customers: DataFrame, outcomes: DataFrame | None, run: _Run, out: _Loaded
) -> Settled:
    """Upsert the dimension, writing the buckets of the arriving emails anew; gives key and delivery flags per email."""
    checked = checks.check_rows(
        dimension.dimension_columns(customers).withColumn("source_run_id", run.of_row()),
        not_null=["company_name", "contact_email"],
        lengths=CUSTOMER_LENGTHS,
    )
    out.errors.append(checks.rejects(checked, "dim_customer", "contact_email"))
    arriving = dimension.one_per_email(checks.accepted(checked), ORDER)
    known, rows = wh.bucketing("dim_customer")
    mine = dimension.bucket_of(F.col("contact_email"), known) if known else F.lit(0)
    settled = settle(arriving, "incoming", f"{run.folder}/incoming", customers=F.sum("n"), buckets=F.collect_set(mine))
    incoming = settled.frame
    count = dimension.bucket_number(rows + settled.rows, known, wh.bucket_rows)
    touched = sorted(settled.stats["buckets"]) if count == known else None
    current = wh.read("dim_customer", TABLES["dim_customer"], touched) if known else None
    merged = dimension.merge_customers(
        current, incoming, run.run_id, run.at, wh.last_key("dim_customer") + 1, count)
    path = wh.new_path("dim_customer", run.load_id)
    done = settle(merged, "dim_customer", path, "bucket", last=F.max("customer_key"),
                  added=count_where(F.col("customer_key") > wh.last_key("dim_customer")),
                  buckets=F.collect_set("bucket"))
    total = rows + (done.stats["added"] or 0)
    out.written["dim_customer"] = Written(
        path, replaces=True, last_key=done.stats["last"], rows=total, bucket_count=count,
        buckets=sorted(done.stats["buckets"]))
    keys = facts.single_keys(facts.email_keys(done.frame, incoming.select("contact_email", "n")))
    customer_keys = settle_keyed(facts.with_delivery(keys, outcomes), "customer-keys")
    repeated = customer_keys.frame.where("held > 1").withColumnRenamed("held", "n_rows")
    out.errors.append(checks.repeat_errors(repeated, "dim_customer", "contact_email"))
    return customer_keys


def _load_facts(wh: Warehouse, customers: DataFrame, keys: Settled, run: _Run, out: _Loaded) -> None:
    rows = facts.fact_rows(customers, keys, read_table(wh, "dim_country"), run.of_row(), run.at, order=ORDER)
    # All facts of a run share one day, so its reference is checked once, not per row.
    dates = read_table(wh, "dim_import_date")
    known = dates.where(F.col("date_key") == date_key(stamp_literal(run.at))).limit(1).count()
    if not known:
        text = F.concat(F.lit("missing date_key "), F.col("date_key").cast("string"))
        out.errors.append(
            rows.select(F.lit("fact").alias("stage"), F.col("source_row").cast("string").alias("key"),
                        text.alias("error"))
        )
        rows = rows.limit(0)
    path = wh.new_path("fact_customer_imports", run.load_id, import_month=run.at.strftime("%Y-%m"))
    keyed = rows.drop("import_month").withColumn(
        "import_key", growing_key(wh.last_key("fact_customer_imports") + 1)
    )
    done = settle(keyed, "fact_customer_imports", path, last=F.max("import_key"))
    out.written["fact_customer_imports"] = Written(path, last_key=done.stats["last"], rows=done.rows)
    out.facts = done.frame


def run_load(
    spark: SparkSession,
    paths: str | list[str],
    root: str | None = None,
    *,
    config: dict | None = None,
    gate: str = "clean",
    deliver: Deliver | None = None,
    dry_run: bool = False,
    full_reload: bool = False,
    country_codes: Sequence[str] = COUNTRY_CODES,
    run_id: str | None = None,
    run_at: dt.datetime | None = None,
    version: str = "1.0.0",
    source: Callable[[str], Feed] | None = None,
    also_written: dict[str, Callable[[str], Written]] | None = None,
    label: str | None = None,
    files: DataFrame | None = None,
) -> LoadResult:
    """Load feed files into the warehouse at `root`.

    `gate` picks the rows that become customers: new clean ones, or new valid ones. `full_reload` takes
    rows loaded before as new. All tables of a run appear together when it ends; a failed run leaves them
    as they were. Without a root there is no history and no run log: rows are checked, mapped, delivered
    and reported. A dry run does not deliver either and writes nothing but scratch data.

    All files are one run, unless `files` (a written table of `_sourceFile`, `_names`) asks for a run of its own for each
    of them: rows, customers and facts then carry the id that `run_of_file` gives, and the log has figures and a quality
    report per file.
    """
    if gate not in ("clean", "valid"):
        raise ValueError(f"gate must be 'clean' or 'valid', not {gate!r}")
    require_utc(spark)
    started = utc_now()
    at = run_at or started
    at = at.replace(tzinfo=dt.timezone.utc) if at.tzinfo is None else at.astimezone(dt.timezone.utc)
    run_id = run_id or str(uuid.uuid4())
    warehouse = None if dry_run or root is None else Warehouse(spark, root)
    load_id = f"{run_id}-{uuid.uuid4().hex[:8]}"
    folder = f"{warehouse.root}/runs/{load_id}" if warehouse else scratch_path(spark, "run")
    run = _Run(run_id, at, version, load_id, folder, full_reload)
    if files is not None:
        run.files = files.withColumn("run_id", run_of_file(run_id))
    label = label or (paths if isinstance(paths, str) else ", ".join(paths))
    if warehouse:
        prepare(warehouse, at)
        log_event(warehouse, runs.start_event(spark, run_id, label, at, version) if files is None
                  else runs.start_events(run.files, at, version))
    try:
        return _run(spark, paths, warehouse, run, config or {}, gate, None if dry_run else deliver, country_codes,
                    source, also_written or {}, started)
    except Exception as error:
        # What is committed stays visible: such a run did not fail, even if its end could not be logged.
        if warehouse and not run.committed:
            ended = at + (utc_now() - started)
            log_event(warehouse, runs.fail_event(spark, run_id, at, ended, str(error)) if files is None
                      else runs.fail_events(run.files, at, ended, F.lit(str(error))))
        raise


def _run(spark, paths, warehouse, run, config, gate, deliver, country_codes, source, also_written, started):
    feed = source(f"{run.folder}/feed") if source else read_feed(spark, paths, f"{run.folder}/feed")
    parse_errors = feed.parse_errors.count()
    staged = read_table(warehouse, "stg_customers") if warehouse else None
    loaded = history.loaded_hashes(staged)
    assessed = assess(
        feed, None if run.full_reload else loaded, config.get("validationRules"), country_codes, f"{run.folder}/rows",
        run.full_reload,
    )
    stats = {name: value or 0 for name, value in assessed.stats.items()}
    rows = assessed.frame
    # Headers differ from file to file; their drift is in the reports of the files.
    header = feed.header if run.files is None else EXPECTED_FIELDS
    dq_report = quality_report(spark, header, assessed, run.at)

    passing = F.col("_isClean") if gate == "clean" else F.size("errors") == 0
    mapping = with_columns_of(config if config.keys() & MAPPED else DEFAULT_MAPPING, field_names(feed.header))
    mapped = map_rows(history.new_rows(rows).where(passing), mapping, run.at, KEEP)
    customers = settle(mapped.customers, "customers", f"{run.folder}/customers")
    metrics = runs.RunMetrics(
        records_in_file=assessed.rows + parse_errors, records_parsed=assessed.rows, records_valid=stats["valid"],
        records_invalid=assessed.rows - stats["valid"], records_new=stats["new"], records_api_sent=customers.rows,
        parse_error_count=parse_errors,
    )
    outcomes = None
    if deliver and customers.rows:
        log = deliver(customers.frame)
        if "name" not in log.columns:
            log = log.withColumn("name", F.lit(None).cast("string"))
        keys = [c for c in (ORDER, "name", "email") if c in log.columns]
        outcomes = settle(
            delivery.delivery_outcomes(log, keys), "outcomes", f"{run.folder}/outcomes",
            success=count_where(F.col("status") == "success"),
        )
        metrics.records_api_success = outcomes.stats["success"] or 0
        metrics.records_api_failed = outcomes.rows - metrics.records_api_success

    out = _Loaded()
    if warehouse and stats["new"]:
        _load_staging(warehouse, rows, stats["new"], loaded, run, out)
        out.counts = {"stagingAttempted": stats["new"], "stagingLoaded": out.written["stg_customers"].rows}
        if customers.rows:
            per_email = None
            if outcomes is not None:
                order = ORDER if ORDER in outcomes.frame.columns else "attempts"
                per_email = delivery.last_per_email(outcomes.frame, order)
            email_keys = _load_customers(warehouse, customers.frame, per_email, run, out)
            _load_facts(warehouse, customers.frame, email_keys, run, out)
            metrics.records_loaded = out.written["fact_customer_imports"].rows
            out.counts |= {"dimensionLoaded": email_keys.stats["total"] or 0, "factLoaded": metrics.records_loaded}
        rejected = settle(checks.load_errors(*out.errors), "load-errors", f"{run.folder}/load_errors")
        out.counts["errors"] = rejected.rows

    result = _report(spark, feed, assessed, mapped.errors, outcomes, metrics, dq_report, run, out, warehouse)
    if warehouse:
        for name, write in also_written.items():
            out.written[name] = write(run.load_id)
        if out.written:
            warehouse.commit(run.run_id, out.written, run.at)
        run.committed = True
        ended = run.at + (utc_now() - started)
        if run.files is None:
            event = runs.complete_event(spark, run.run_id, run.at, ended, metrics, json.dumps(dq_report))
        else:
            event = runs.complete_events(
                file_figures(run, feed, rows, customers.frame, outcomes.frame if outcomes else None, out.facts),
                run.at, ended)
        log_event(warehouse, event)
    # The row table holds all that the landed feed did; nothing reads these any more.
    for name in ("feed", "feed-blocks", "incoming"):
        delete_path(spark, f"{run.folder}/{name}")
    return result


def file_figures(
    run: _Run, feed: Feed, rows: DataFrame, customers: DataFrame, outcomes: DataFrame | None, loaded: DataFrame | None
) -> DataFrame:
    """One row per file of a load: run id, counts and quality report. Each table is combined per file before it moves."""
    one = F.count(F.lit(1))
    parts = [
        rows.groupBy("_sourceFile").agg(
            one.alias("total"), count_where(F.size("errors") == 0).alias("records_valid"),
            count_where(F.col("_isClean")).alias("clean"), count_where(F.col("_duplicateRow")).alias("duplicates"),
            count_where(~F.col("_loaded")).alias("records_new"),
            *[c.alias(f"null_{f}") for f, c in zip(EXPECTED_FIELDS, quality.null_counts(feed_columns(rows)))]),
        feed.parse_errors.groupBy("_sourceFile").agg(one.alias("parse_error_count")),
        customers.groupBy("_sourceFile").agg(one.alias("records_api_sent")),
    ]
    if loaded is not None:
        parts.append(loaded.groupBy(F.col("source_file").alias("_sourceFile")).agg(one.alias("records_loaded")))
    if outcomes is not None:
        if ORDER in outcomes.columns:
            sent = outcomes.select(F.col(f"{ORDER}.file").alias("_sourceFile"), "status")
        else:
            emails = customers.select("_sourceFile", F.col("email")).distinct()
            sent = emails.join(outcomes, "email").select("_sourceFile", "status")
        good = F.col("status") == "success"
        parts.append(sent.groupBy("_sourceFile").agg(
            count_where(good).alias("records_api_success"), count_where(~good).alias("records_api_failed")))
    joined = run.files.select("_sourceFile", "run_id", "_names")
    for part in parts:
        joined = joined.join(part, "_sourceFile", "left")
    named = ["total", "clean", "duplicates", "parse_error_count", *runs.COUNT_COLUMNS, *[f"null_{f}" for f in EXPECTED_FIELDS]]
    counts = {c: F.coalesce(F.col(c), F.lit(0)) if c in joined.columns else F.lit(0) for c in named}
    total = counts["total"]
    counts |= {
        "records_parsed": total, "records_in_file": total + counts["parse_error_count"],
        "records_invalid": total - counts["records_valid"],
    }
    filled = joined.select("run_id", "_names", *[c.cast("bigint").alias(n) for n, c in counts.items()])
    return filled.withColumn("dq_report", quality.file_report(run.at.isoformat()))


def feed_columns(rows: DataFrame) -> list[str]:
    """The fields of an assessed feed; those of the load's own begin with an underscore."""
    return [c for c in rows.columns if not c.startswith("_") and c != "errors"]


def _report(spark, feed, assessed, transform_errors, outcomes, metrics, dq_report, run, out, warehouse) -> LoadResult:
    """Write the error table and the one-row summary; give both back with the row table."""
    invalid = rules.invalid_rows(assessed.frame)
    if "company_name" not in invalid.columns:
        invalid = invalid.withColumn("company_name", F.lit(None).cast("string"))
    sent = outcomes.frame if outcomes is not None else spark.createDataFrame(
        [], "name string, email string, status string, error string, attempts int, response_id string"
    )
    errors = settle(
        runs.error_union(feed.parse_errors, invalid, transform_errors, sent), "errors", f"{run.folder}/errors",
        transform=count_where(F.col("stage") == "transform"),
    )
    failed = metrics.records_invalid + metrics.records_api_failed + (errors.stats["transform"] or 0)
    report = {
        "generatedAt": run.at.isoformat(),
        "summary": {
            "totalRowsInFile": metrics.records_in_file,
            "successfullyParsed": metrics.records_parsed,
            "passedValidation": metrics.records_valid,
            "failedValidation": metrics.records_invalid,
            "sentToAPI": metrics.records_valid,
            "apiSuccess": metrics.records_api_success,
            "apiFailed": metrics.records_api_failed,
            "overallSuccess": metrics.records_api_success,
            "overallFailed": failed,
        },
        "errorCount": errors.rows,
    }
    text = json.dumps({"runId": run.run_id, "metrics": asdict(metrics), "report": report, "dqReport": dq_report})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{run.folder}/report")
    tables = {
        "rows": assessed.frame,
        "row_issues": quality.ordered_issues(assessed.frame, ORDER),
        "duplicates": quality.duplicate_list(assessed.frame),
        "errors": errors.frame,
        "delivered": runs.delivered_customers(sent),
        "customers": spark.read.parquet(f"{run.folder}/customers"),
    }
    return LoadResult(run.run_id, metrics.status, metrics, dq_report, report, out.counts, run.folder, tables)
