"""Versioned loan tables: delete, read as of an earlier time, restore.

Plain parquet has no DELETE and no time travel. Here every version is a folder with all its rows: a
delete writes the rows that stay, a restore the rows with those that come back. A log has
one small row per version, and a read opens one folder. One writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.operators.bags import bag_difference
from lendlens.sources.constants import literal_rows

LOG_SCHEMA = "version long, committed_at timestamp, operation string, folder string, rows long"


@dataclass(frozen=True)
class Version:
    number: int
    committed_at: datetime
    operation: str
    folder: str
    rows: int


class SnapshotTable:
    def __init__(
        self, spark: SparkSession, base: str, schema: T.StructType, cluster_by: str | None = None
    ):
        """Rows are sorted by ``cluster_by`` in each file; conditions on it then read few pages."""
        self.spark = spark
        self.base = base.rstrip("/")
        self.schema = schema
        self.cluster_by = cluster_by

    # Writing

    def create(self, df: DataFrame, committed_at: datetime | None = None) -> Version:
        """Version 0; an existing table is refused."""
        self.spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(self._log_path())
        if self.versions():
            raise ValueError(f"a table exists at {self.base}")
        return self._publish(0, "create", df, committed_at)

    def delete_where(self, condition: str, committed_at: datetime | None = None) -> Version:
        """Remove rows for which a SQL condition is true; rows where it is NULL stay."""
        latest = self.latest()
        stay = self.read(latest).filter(~F.coalesce(F.expr(condition), F.lit(False)))
        return self._publish(latest.number + 1, "delete", stay, committed_at)

    def restore_where(
        self, condition: str, as_of: Version, committed_at: datetime | None = None
    ) -> Version:
        """Add the matching rows of an earlier version, whether or not they are still there."""
        latest = self.latest()
        rows = self.read(latest).unionByName(self.read(as_of).filter(condition))
        return self._publish(latest.number + 1, "restore", rows, committed_at)

    def restore_missing(
        self, condition: str, as_of: Version, committed_at: datetime | None = None
    ) -> Version:
        """Add only those matching rows (and copies) that the latest version lacks."""
        latest = self.latest()
        earlier, now = (self.read(version).filter(condition) for version in (as_of, latest))
        rows = self.read(latest).unionByName(bag_difference(earlier, now))
        return self._publish(latest.number + 1, "restore missing", rows, committed_at)

    def _publish(
        self, number: int, operation: str, df: DataFrame, committed_at: datetime | None
    ) -> Version:
        """Write all rows to a new folder; one small log row then makes the version visible.

        The number of rows comes from the file footers.
        """
        folder = uuid.uuid4().hex
        rows = df.select(*self.schema.fieldNames())
        if self.cluster_by is not None:
            rows = rows.sortWithinPartitions(self.cluster_by)
        rows.write.parquet(f"{self.base}/{folder}")
        at = committed_at or datetime.now(timezone.utc)
        version = Version(number, at, operation, folder, self._folder(folder).count())
        row = (number, at, operation, folder, version.rows)
        literal_rows(self.spark, LOG_SCHEMA, [row]).write.mode("append").parquet(self._log_path())
        return version

    # Reading

    def versions(self) -> list[Version]:
        """All versions in order; the log has one row for each."""
        log = self.spark.read.schema(LOG_SCHEMA).parquet(self._log_path())
        epoch = datetime.fromtimestamp(0, timezone.utc)
        return [
            Version(
                row["version"],
                epoch + timedelta(microseconds=row["committed_at"]),
                row["operation"],
                row["folder"],
                row["rows"],
            )
            for row in log.withColumn("committed_at", F.unix_micros("committed_at"))
            .orderBy("version")
            .collect()
        ]

    def latest(self) -> Version:
        return self.versions()[-1]

    def version_at(self, moment: datetime) -> Version:
        """The newest version committed at or before a moment."""
        earlier = [v for v in self.versions() if v.committed_at <= moment]
        if not earlier:
            raise ValueError(f"the table has no version at or before {moment.isoformat()}")
        return earlier[-1]

    def version_before(self, seconds: float, now: datetime | None = None) -> Version:
        """The version that was the latest one ``seconds`` ago."""
        return self.version_at((now or datetime.now(timezone.utc)) - timedelta(seconds=seconds))

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, the latest by default: one folder."""
        return self._folder((version or self.latest()).folder)

    def _folder(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/{folder}")

    def _log_path(self) -> str:
        return f"{self.base}/log"
