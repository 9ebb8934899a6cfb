"""Stored tables that are replaced by the switch of a path.

A table is a folder of numbered versions, each written by Spark's own writer.  A version counts from the
moment its ``_manifest.json`` exists, which is written last; a job that dies half-way leaves a folder
nobody reads.  The days of a table kept by day are overwritten inside the newest version, by dynamic partition
overwrite: run again after a crash, the same rows replace the same days.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.sources import files

MANIFEST = "_manifest.json"
APPLIED_FILE = "_applied.json"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"

Days = Sequence[date | None]


def on_days(days: Days, column: str = "event_date") -> Column:
    """Rows of the given days, as literals, so that other partitions are not even listed."""
    known = [day for day in days if day is not None]
    condition = F.col(column).isin(known) if known else F.lit(False)
    return condition | F.col(column).isNull() if None in days else condition


def _as_json(text: str | None):
    try:
        return json.loads(text) if text else None
    except ValueError:  # torn by a crash: as good as not there
        return None


@dataclass(frozen=True)
class StoredTable:
    spark: SparkSession
    path: str
    day_column: str | None = None  # partition column, if the table is kept by day

    def _version_path(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def _folders(self) -> list[int]:
        """Numbers of all version folders, complete or not, oldest first."""
        names = files.child_names(self.spark, self.path)
        return sorted(int(name[2:]) for name in names if name.startswith("v="))

    def _manifest(self, version: int) -> dict | None:
        path = f"{self._version_path(version)}/{MANIFEST}"
        return _as_json(files.read_text(self.spark, path))

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return [v for v in self._folders() if self._manifest(v) is not None]

    def current(self) -> int | None:
        return next((v for v in reversed(self._folders()) if self._manifest(v) is not None), None)

    def _known(self, version: int | None = None) -> tuple[int, dict]:
        """A version, by default the newest complete one, and its manifest."""
        for candidate in reversed(self._folders()) if version is None else [version]:
            manifest = self._manifest(candidate)
            if manifest is not None:
                return candidate, manifest
        raise LookupError(f"nothing stored yet at {self.path}")

    def current_path(self) -> str:
        return self._version_path(self._known()[0])

    def read(self, version: int | None = None) -> DataFrame:
        version, manifest = self._known(version)
        schema = T.StructType.fromJson(manifest["schema"])
        rows = self.spark.read.schema(schema).parquet(self._version_path(version))
        return rows.select(*schema.fieldNames())

    def noted(self) -> dict | None:
        """What was noted with the newest version when it was written."""
        return self._known()[1]["note"] if self.current() is not None else None

    def _writer(self, df: DataFrame, arranged: bool = False):
        if self.day_column is None:
            return df.write.mode("overwrite")
        if not arranged:
            # Gathers a day's rows in few files and splits a day that is too big.
            df = df.hint("rebalance", self.day_column)
        return df.write.mode("overwrite").partitionBy(self.day_column)

    def _next_version(self) -> int:
        return max(self._folders(), default=0) + 1

    def replace(self, df: DataFrame, arranged: bool = False, note: dict | None = None) -> int:
        """Writes ``df`` as the next version.  ``df`` may read the current one.  Rows that
        are already ``arranged`` among the files are left as they are.  ``note`` comes to count at
        the same moment as the rows."""
        version = self._next_version()
        self._writer(df, arranged).parquet(self._version_path(version))
        self._complete(version, df.schema, note)
        return version

    def create(self, schema: T.StructType) -> int:
        """An empty next version, into which parts are then written."""
        version = self._next_version()
        files.make_directory(self.spark, self._version_path(version))
        self._complete(version, schema, None)
        return version

    def _complete(self, version: int, schema: T.StructType, note: dict | None) -> None:
        manifest = {"schema": schema.jsonValue(), "note": note}
        files.write_text(
            self.spark, f"{self._version_path(version)}/{MANIFEST}", json.dumps(manifest)
        )

    def overwrite_days(self, df: DataFrame, days: Days) -> None:
        """Makes the rows of ``days`` those of ``df``, which must hold rows of these days only and not be
        read from this table.  Files of other days are not touched; a day with no rows left goes.

        A table that is not kept by day is written as a whole, as its next version.
        """
        if self.day_column is None:
            other = ~F.coalesce(on_days(days), F.lit(False))
            self.replace(self.read().filter(other).unionByName(df))
            return
        homes = [NULL_DAY if day is None else day.isoformat() for day in days]
        homes = [f"{self.current_path()}/{self.day_column}={day}" for day in homes]
        before = [set(files.child_names(self.spark, home)) for home in homes]
        self._writer(df).option("partitionOverwriteMode", "dynamic").parquet(self.current_path())
        for home, names in zip(homes, before, strict=True):
            if names and names == set(files.child_names(self.spark, home)):  # no row was written
                files.remove(self.spark, home)

    def drop_old(self, keep: int) -> None:
        """Removes all but the newest ``keep`` versions.  Readers of the others must be done."""
        versions = self.versions()
        for version in self._folders():
            # A folder beyond the newest version may be one that is being written.
            if versions and version not in versions[-keep:] and version < versions[-1]:
                files.remove(self.spark, f"{self._version_path(version)}/{MANIFEST}")
                files.remove(self.spark, self._version_path(version))

    def applied(self) -> dict | None:
        """What the stored result reflects, as noted by the last refresh."""
        return _as_json(files.read_text(self.spark, f"{self.path}/{APPLIED_FILE}"))

    def note_applied(self, note: dict) -> None:
        files.write_text(self.spark, f"{self.path}/{APPLIED_FILE}", json.dumps(note))


def write_batch(df: DataFrame, path: str, batch_id: int, column: str = "_batch_id") -> None:
    """Writes one micro-batch under its own id.  A replayed batch replaces itself, so
    a failure between this write and the stream's commit duplicates nothing."""
    (
        df.withColumn(column, F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    """Plain batch append; not protected against being run twice."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
