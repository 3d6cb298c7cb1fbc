"""The RAW, CLEAN and ANALYTICS layers as parquet tables under one base folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.operators import profiling
from lendlens.session import folder_exists, footer_session, remove_folder
from lendlens.sources.constants import literal_rows

VERSIONS = "version long, folder string, schema string, partition_by string"
LAYERS = ("raw", "clean", "analytics")
LOANS = "loan_applications"


class LayerStore:
    """Reads and replaces tables below ``{base}/{layer}/{table}``; can expose the tables to Spark SQL."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    # Versions

    def _root(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; layers are {', '.join(LAYERS)}")
        return f"{self.base}/{layer}/{table}"

    def _log(self, layer: str, table: str) -> DataFrame | None:
        """One small row per replace, the newest first; None before the first replace.

        Two writers at once may take the same number. The folder's name then decides, so that every
        reader and the next writer agree on one of them.
        """
        path = f"{self._root(layer, table)}.versions"
        if not folder_exists(self.spark, path):
            return None
        log = self.spark.read.schema(VERSIONS).parquet(path)
        return log.orderBy(F.desc("version"), F.desc("folder"))

    def _current(self, layer: str, table: str) -> Row:
        log = self._log(layer, table)
        if log is None:
            raise ValueError(f"there is no table {layer}.{table} at {self.base}")
        return log.first()

    def _folder(self, layer: str, table: str, version: Row) -> str:
        return f"{self._root(layer, table)}/{version['folder']}"

    def _open(self, layer: str, table: str, version: Row) -> DataFrame:
        """The schema is in the log: nothing is inferred, and an empty partitioned table has its columns."""
        schema = T.StructType.fromJson(json.loads(version["schema"]))
        rows = self.spark.read.schema(schema).parquet(self._folder(layer, table, version))
        return rows.select(*[F.col(f"`{name}`") for name in schema.fieldNames()])

    def path(self, layer: str, table: str) -> str:
        """The folder that holds the table now."""
        return self._folder(layer, table, self._current(layer, table))

    def read(self, layer: str, table: str = LOANS) -> DataFrame:
        return self._open(layer, table, self._current(layer, table))

    # Writing

    def replace(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        max_records_per_file: int = 0,
    ) -> DataFrame:
        """Create or replace a table from a query; executors write, nothing passes the driver.

        Rows go to a new folder, and readers turn to it only when it is complete. A failed replace
        leaves the table as it was. Former folders stay, for readers that are still at work, until
        ``keep_versions`` removes them. With ``partition_by`` a filter on these columns reads the
        matching folders only; an empty text in such a column is read back as NULL.
        """
        root, folder = self._root(layer, table), uuid.uuid4().hex
        log = self._log(layer, table)
        newest = log.first() if log is not None else None
        writer = df.write.option("maxRecordsPerFile", max_records_per_file)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{root}/{folder}")
        version = Row(
            version=newest["version"] + 1 if newest else 0,
            folder=folder,
            schema=df.schema.json(),
            partition_by=json.dumps(list(partition_by)),
        )
        published = literal_rows(self.spark, VERSIONS, [tuple(version)])
        published.write.mode("append").parquet(f"{root}.versions")
        return self._open(layer, table, version)

    def replace_partitions(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        """Replace only the partitions that ``df`` has rows for; the others are not read or written.

        The table must have been replaced with ``partition_by``. Spark stages the new files and moves
        them when all are written, in the current folder: a failed write changes nothing, but a
        reader of the same partitions at that moment may have to start again.
        """
        current = self._current(layer, table)
        names = T.StructType.fromJson(json.loads(current["schema"])).fieldNames()
        partition_by = json.loads(current["partition_by"])
        if not partition_by:
            raise ValueError(f"{layer}.{table} is not partitioned")
        writer = df.select(*[F.col(f"`{name}`") for name in names]).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
        writer.parquet(self._folder(layer, table, current))
        return self._open(layer, table, current)

    def load_raw(self, scored: DataFrame, max_records_per_file: int = 0) -> DataFrame:
        """Replace the RAW loan table, with warehouse-style column names, in a folder per status.

        The status as a folder lets the file footers answer for the bounds of each status.
        """
        renamed = scored.toDF(*[name.upper().replace(" ", "_") for name in scored.columns])
        return self.replace("raw", LOANS, renamed, ["LOAN_STATUS"], max_records_per_file)

    def keep_versions(self, layer: str, table: str, count: int) -> list[str]:
        """Remove the folders of all but the newest ``count`` versions, and return their names.

        The log keeps its rows. Run it when no reader is left on the versions that go.
        """
        if count < 1:
            raise ValueError("the current version cannot be removed")
        log = self._log(layer, table)
        former = log.offset(count).select("folder") if log is not None else None
        folders = [row["folder"] for row in former.toLocalIterator()] if former is not None else []
        root = self._root(layer, table)
        removed = [folder for folder in folders if remove_folder(self.spark, f"{root}/{folder}")]
        for folder in removed:
            remove_folder(self.spark, f"{root}.sketches/{folder}")
        return removed

    # What files and versions know without a scan of the rows

    def bounds(
        self, layer: str, table: str, column: str, class_column: str | None = None
    ) -> dict[object, tuple]:
        """Least and greatest value of a numeric column, from the file footers alone.

        With the class column, which must be the table's only partition column, per class; else
        under the key None. Where footers lack a value (NaN, a file of NULLs only), the column is scanned.
        """
        version = self._current(layer, table)
        schema = T.StructType.fromJson(json.loads(version["schema"]))
        rows = footer_session(self.spark).read.schema(schema).parquet(self._folder(layer, table, version))
        sides = [F.min(column).alias("lo"), F.max(column).alias("hi")]
        try:
            found = (rows.groupBy(class_column) if class_column else rows).agg(*sides).collect()
        except Exception as error:  # the JVM's UnsupportedOperationException and its like
            if "aggregatePushdown" not in str(error):
                raise
            rows = self._open(layer, table, version)
            found = (rows.groupBy(class_column) if class_column else rows).agg(*sides).collect()
        return {row[class_column] if class_column else None: (row["lo"], row["hi"]) for row in found}

    def sketches(self, layer: str, table: str, every_version: bool = False) -> DataFrame:
        """Column sketches of the current version, or of all kept ones; each is made once and stored.

        A version costs one scan, whatever number of versions there is; sketches of all are then
        merged from a few kilobytes per column.
        """
        log = self._log(layer, table)
        versions = log.collect() if every_version else [self._current(layer, table)]
        merged = None
        for version in versions:
            path = f"{self._root(layer, table)}.sketches/{version['folder']}"
            if not folder_exists(self.spark, f"{path}/_SUCCESS"):
                sketches = profiling.column_sketches(self._open(layer, table, version))
                sketches.write.mode("overwrite").parquet(path)
            one = self.spark.read.schema(profiling.SKETCHES).parquet(path)
            merged = one if merged is None else merged.unionByName(one)
        return profiling.merge_sketches(merged)

    # Spark SQL

    def create_namespaces(self, prefix: str = "") -> list[str]:
        """Create one Spark database per layer if missing, and return their names."""
        names = [f"{prefix}{layer}" for layer in LAYERS]
        for layer, name in zip(LAYERS, names):
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.base}/{layer}'"
            )
        return names

    def register(self, layer: str, table: str = LOANS, prefix: str = "") -> str:
        """Make a written table visible to SQL as ``{prefix}{layer}.{table}``."""
        version = self._current(layer, table)
        name, path = f"`{prefix}{layer}`.`{table}`", self._folder(layer, table, version)
        if self.spark.catalog.tableExists(name):
            details = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
            location = details.filter("col_name = 'Location'").first()["data_type"]
            folder = location.rstrip("/").rpartition("/")[0]
            if not _same_place(folder, self._root(layer, table)):
                raise ValueError(f"{name} already exists at {location}")
            self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        fields = T.StructType.fromJson(json.loads(version["schema"])).fields
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
        partition_by = ", ".join(f"`{column}`" for column in json.loads(version["partition_by"]))
        partitioned = f"PARTITIONED BY ({partition_by}) " if partition_by else ""
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned}LOCATION '{path}'")
        if partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return name


def _same_place(one: str, other: str) -> bool:
    """Equal paths; a missing scheme stands for the default file system."""
    (scheme, path), (scheme2, path2) = (_parts(place) for place in (one, other))
    return path == path2 and (scheme == scheme2 or not scheme or not scheme2)


def _parts(place: str) -> tuple[str, str]:
    url = urlsplit(place)
    return f"{url.scheme}//{url.netloc}" if url.scheme else "", url.path.rstrip("/")
