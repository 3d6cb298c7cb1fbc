"""Session helpers: a local session, sizing to the input, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

MB = 1024 * 1024
TARGET_SHUFFLE_BYTES = 256 * MB


def local_session(cores: int | str = "*", app: str = "lendlens", **conf: str) -> SparkSession:
    """A single-machine session for tests, the benchmark and small runs."""
    cpus = 8 if cores == "*" else int(cores)
    settings = {
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lendlens-"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(stored_bytes: int, growth: float = 3) -> int:
    """The value for ``spark.sql.shuffle.partitions`` when that much stored input is shuffled.

    The caller sets it once, with the session: AQE merges small partitions but cannot split those of
    an aggregation, so the number has to follow the input. ``growth`` is the size of the shuffled
    rows relative to the stored (compressed) columns. There is no upper bound.
    """
    return max(1, math.ceil(stored_bytes * growth / TARGET_SHUFFLE_BYTES))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path for intermediate tables, under the shared ``spark.checkpoint.dir``.

    Only a local session may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lendlens-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own in which parquet footers answer for counts, minima and maxima.

    Only the session that asks for them has these settings; the caller's stays as it is.
    """
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # A partition column in capitals is only then known as one, and a group by it pushed down.
    other.conf.set("spark.sql.caseSensitive", "true")
    return other


def _folder(spark: SparkSession, path: str):
    """The path and its file system, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, folder = _folder(spark, path)
    return store.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all in it; False if there was none."""
    store, folder = _folder(spark, path)
    return store.delete(folder, True)
