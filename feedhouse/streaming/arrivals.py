"""Incremental ingest: land the files that arrived, then load what was landed and not loaded yet.

Listing and landing are stateless streaming queries; their checkpoints know the files they have seen, and each batch has
a folder of its own that a repeated batch overwrites, so a restart neither loses nor repeats a file. Batches that were
loaded are recorded and their folders deleted, so what is looked at does not grow with history. Staging hashes keep
a repeated row out in any case.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedhouse.fixed import DEFAULT_MAPPING, DEFAULT_RULES, EXPECTED_FIELDS
from feedhouse.functions.times import utc_now
from feedhouse.operators import runs
from feedhouse.operators.rules import RULES
from feedhouse.plans.load import MAPPED, LoadResult, log_event, prepare, read_table, run_load, run_log, run_of_file
from feedhouse.plans.schemas import LANDED_FILES
from feedhouse.session import delete_path, folder_names
from feedhouse.sources.lines import open_landing, scan_lines
from feedhouse.sources.records import NO_DATA, ROW_NUMBER, Feed, feed_of_files, file_headers
from feedhouse.sources.tables import Warehouse, Written, settle

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
HEADERS = "_sourceFile string, lines bigint, _names array<string>, _places array<int>, _refused string"


def _by_batch(frame: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now, a folder per batch, then stop."""

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(f"{folder}/batch-{number}")

    writer = frame.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def land_arrivals(
    spark: SparkSession, arrivals: str, landing: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Land the lines of the files that are in `arrivals` now, a folder per batch, then stop."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _by_batch(scan_lines(reader, arrivals), landing, checkpoint)


def list_arrivals(spark: SparkSession, arrivals: str, listing: str, checkpoint: str) -> StreamingQuery:
    """List the files that are in `arrivals` now, empty ones included; their contents are not read."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).load(arrivals)
    return _by_batch(files.select(F.col("_metadata.file_path").alias("_sourceFile")), listing, checkpoint)


def pending_batches(warehouse: Warehouse, folder: str, kind: str = "") -> list[str]:
    """Names of landed batches that no committed load has used; batches that were used are gone or named there, with
    `kind` before their name."""
    names = [n for n in folder_names(warehouse.spark, folder) if n.startswith("batch-")]
    used = read_table(warehouse, "landed_files")
    if used is None or not names:
        return names
    done = {r.landed_file for r in used.where(F.col("landed_file").isin([kind + n for n in names])).collect()}
    return [n for n in names if kind + n not in done]


def wanted_fields(config: dict) -> list[str]:
    """The fields that a load looks at: those expected, those of its rules, and the sources of its mapping."""
    checks = config.get("validationRules")
    checks = DEFAULT_RULES if checks is None else checks
    mapping = config if config.keys() & MAPPED else DEFAULT_MAPPING
    groups = [mapping.get("fieldMappings") or {}, *(mapping.get("nestedMappings") or {}).values()]
    names = [*EXPECTED_FIELDS, *[f for rule in RULES for f in checks.get(rule) or []],
             *[r["from"] for fields in groups for r in fields.values() if "from" in r]]
    return [n for n in dict.fromkeys(names) if n != ROW_NUMBER]


def ingest(spark: SparkSession, arrivals: str, root: str, **options) -> list[LoadResult]:
    """Land what arrived and load it; nothing new gives an empty list, else the one result of the load.

    Every file is a run of its own in the log, rows and facts, with the header it has, yet all are one load: the number of
    jobs does not grow with the number of files. Files count as loaded one after the other, by name. A file without a
    data line, blank or empty ones too, is a failed run and keeps no other file back. An error that is not the feed's
    fails the call; what was landed then stays pending. `options` as in run_load.
    """
    warehouse = Warehouse(spark, root)
    prepare(warehouse, options.get("run_at"))
    base = f"{warehouse.root}/landing"
    # Files are listed first: one that arrives in between is landed now, and known by its run when it is listed.
    list_arrivals(spark, arrivals, f"{base}/files", f"{base}/files-checkpoint").awaitTermination()
    land_arrivals(spark, arrivals, f"{base}/lines", f"{base}/checkpoint").awaitTermination()
    lists, batches = pending_batches(warehouse, f"{base}/files", "files/"), pending_batches(warehouse, f"{base}/lines")
    if not lists and not batches:
        return []
    work = f"{base}/work-{uuid.uuid4().hex}"
    wanted = wanted_fields(options.get("config") or {})
    landed = open_landing(spark, [f"{base}/lines/{b}" for b in batches], f"{work}/blocks") if batches else None
    heads = file_headers(landed, wanted) if landed else spark.createDataFrame([], HEADERS)
    load = str(options.pop("run_id", None) or uuid.uuid4())
    empty = spark.createDataFrame([], "_sourceFile string")
    if lists:
        listed = spark.read.schema(empty.schema).parquet(*[f"{base}/files/{b}" for b in lists])
        known = run_log(warehouse).select(F.col("source_file").alias("_sourceFile"))
        empty = listed.join(heads, "_sourceFile", "left_anti").join(known, "_sourceFile", "left_anti")
    refused = empty.distinct().select("_sourceFile", F.lit(NO_DATA).alias("_refused"))
    files = settle(heads.unionByName(refused, allowMissingColumns=True), "files", f"{work}/files").frame
    good = files.where(F.col("_refused").isNull())
    _log_refused(warehouse, files.where(F.col("_refused").isNotNull()), load, options)
    results = []
    if not good.isEmpty():

        def source(target: str) -> Feed:
            return feed_of_files(landed, good, wanted, target)

        results.append(run_load(spark, arrivals, root, source=source, run_id=load, files=good, **options))
    warehouse.refresh()
    load_id = f"landed-{uuid.uuid4()}"
    path = warehouse.new_path("landed_files", load_id)
    names = [*[f"files/{b}" for b in lists], *batches]
    spark.createDataFrame([(b,) for b in names], LANDED_FILES).coalesce(1).write.parquet(path)
    warehouse.commit(load_id, {"landed_files": Written(path)}, utc_now())
    for folder in [*[f"{base}/files/{b}" for b in lists], *[f"{base}/lines/{b}" for b in batches], work]:
        delete_path(spark, folder)
    return results


def _log_refused(warehouse: Warehouse, refused: DataFrame, load: str, options: dict) -> None:
    """A failed run in the log for each file that is no feed, all in one write."""
    if refused.isEmpty():
        return
    at = options.get("run_at") or utc_now()
    runs_of = refused.withColumn("run_id", run_of_file(load))
    started = runs.start_events(runs_of, at, options.get("version", "1.0.0"))
    log_event(warehouse, started.unionByName(runs.fail_events(runs_of, at, at, F.col("_refused"))))
