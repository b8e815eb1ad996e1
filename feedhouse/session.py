"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SCRATCH_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "feedhouse", **conf: str) -> SparkSession:
    """A session with the settings the jobs are planned for; `conf` overrides them."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        # Shuffles carry content hashes as hex text, which zstd halves and the default codec does not.
        "spark.io.compression.codec": "zstd",
        # Remembering the call site of every expression costs several driver calls for each one.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Days and stamps are those of UTC; another session time zone would shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get(SCRATCH_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SCRATCH_SETTING} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="feedhouse-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set(SCRATCH_SETTING, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table; tables of one application share a folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/feedhouse-{app}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; frames that still read it become unusable."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none if it is not there."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(place))


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application; frames that still read them become unusable."""
    folder = f"{scratch_root(spark)}/feedhouse-{spark.sparkContext.applicationId}"
    delete_path(spark, folder)
