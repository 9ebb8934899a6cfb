"""Tables of the session's catalog, written by Spark's own writer.

Rows go in with ``INSERT INTO``.  What replaces rows replaces whole partitions, by dynamic partition
overwrite: partitions that a write has no rows for are neither read nor written.

An overwrite takes its rows from a finished copy beside the table.  A job that dies while partitions are
being exchanged leaves that copy, and ``recover`` (which every later overwrite calls first) exchanges them
again; one that dies before leaves the table as it was.  One writer at a time, as always with files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.operators.upsert import upsert
from kerbline.sources import files

DYNAMIC = "spark.sql.sources.partitionOverwriteMode"
ZONE = "spark.sql.session.timeZone"
#: Written by Spark when a folder is complete.
SUCCESS = "_SUCCESS"
#: The log of a stream that owns a folder; batch readers go by it.
SINK_LOG = "_spark_metadata"
#: Files of fewer bytes are merged where there are many; those that an overwrite makes have more, but for the last.
SMALL = 8 << 20


def create_database(spark: SparkSession, name: str, comment: str = "") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_text(comment)}")


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


@dataclass(frozen=True)
class CatalogTable:
    """A Parquet table by name, with or without partition columns."""

    spark: SparkSession
    name: str

    def create(
        self,
        schema: T.StructType,
        partitioned_by: Sequence[str] = (),
        comment: str = "",
        tier: str | None = None,
        replace: bool = False,
    ) -> CatalogTable:
        """The table without rows.  One that is there stays as it is, unless ``replace`` is set: then it is
        dropped first, rows and all."""
        if replace:
            self.drop()
        ordered = [f for f in schema if f.name not in partitioned_by]
        ordered += [schema[name] for name in partitioned_by]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partitioned_by)})" if partitioned_by else ""
        tiers = f" TBLPROPERTIES ('quality' = {_text(tier)})" if tier else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet{parts} COMMENT {_text(comment)}{tiers}"
        )
        return self

    def drop(self) -> None:
        if self.exists():
            files.remove(self.spark, self._copy())
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """The table's rows as of now: another session, such as that of a stream's batches, may have exchanged files."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def partition_columns(self) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]

    def location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter("col_name = 'Location'")
        return rows.first()["data_type"]

    def insert(self, rows: DataFrame) -> None:
        """Adds rows; columns go by name.  Not protected against being run twice."""
        self._ordered(rows).write.mode("append").insertInto(self.name)

    def _ordered(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[f"`{c}`" for c in self.read().columns])

    def in_partitions(self, rows: DataFrame) -> tuple[DataFrame, list]:
        """The table's rows in the partitions that ``rows`` fall into, and these partitions.

        Their values are literals in the condition, so other partitions are not even listed.  What reaches
        the driver is bounded by the number of partitions.
        """
        columns = self.partition_columns()
        if not columns:
            return self.read(), []
        touched = rows.select(*columns).distinct().collect()
        if len(columns) == 1:
            known = [row[0] for row in touched if row[0] is not None]
            condition = F.col(columns[0]).isin(known) if known else F.lit(False)
            if len(known) < len(touched):
                condition = condition | F.col(columns[0]).isNull()
        else:
            condition = _any(
                [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns]) for row in touched]
            )
        return self.read().filter(condition), touched

    def overwrite_partitions(self, rows: DataFrame) -> None:
        """Replaces the partitions that ``rows`` fall into (without partition columns: the table) by these
        rows, which may have been read from the table itself."""
        self.recover()
        columns = self.partition_columns()
        rows = self._ordered(rows)
        if columns:
            # A partition's rows in few files; one that is too big is split.
            rows = rows.hint("rebalance", *columns)
        rows.write.mode("overwrite").parquet(self._copy())
        self.recover()

    def clear_partitions(self, values: Sequence) -> None:
        """Removes the partitions of a table with one partition column that hold the given values."""
        (column,) = self.partition_columns()
        for value in values:
            shown = "NULL" if value is None else _text(str(value))
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({column} = {shown})")

    def file_counts(self, small_bytes: int = SMALL) -> DataFrame:
        """``files, bytes, small`` for each partition that has rows: its files, their bytes, and how many have
        fewer than ``small_bytes``.  Reads no column's data."""
        columns = [f"`{c}`" for c in self.partition_columns()]
        each = self.read().select(*columns, "_metadata.file_path", "_metadata.file_size").distinct()
        size = F.col("file_size")
        counts = each.groupBy(*columns).agg(
            F.count("*").alias("files"), F.sum(size).alias("bytes"), F.count_if(size < small_bytes).alias("small")
        )
        return counts.filter("files > 0")

    def compact(self, where: Column | None = None, most_files: int = 8, small_bytes: int = SMALL) -> list:
        """Writes crowded partitions anew, in few files, and returns them (without partition columns: one empty
        row for the table).

        Crowded are those with more than ``most_files`` files of fewer than ``small_bytes``; ``where``, on the
        partition columns, leaves others alone.  Rows stay the same, and other partitions are not
        read.  What a crash leaves, ``recover`` ends.  A table that a stream's own sink writes is refused: its
        readers go by the sink's log.
        """
        if files.exists(self.spark, f"{self.location().rstrip('/')}/{SINK_LOG}"):
            raise ValueError(f"{self.name} belongs to a stream's sink")
        self.recover()
        counts = self.file_counts(small_bytes)
        if where is not None:
            counts = counts.filter(where)
        columns = self.partition_columns()
        crowded = counts.filter(F.col("small") > most_files).select(*columns)
        if not columns:
            touched = crowded.collect()  # one row at most
            rows = self.read().hint("rebalance")
        else:
            rows, touched = self.in_partitions(crowded)
        if touched:
            self.overwrite_partitions(rows)
        return touched

    def _copy(self) -> str:
        return self.location().rstrip("/") + ".overwriting"

    def recover(self) -> bool:
        """Ends an overwrite that was begun: exchanges the partitions if its rows are complete, else
        forgets them.  Says whether there was something to exchange.  Doing it again changes nothing."""
        copy = self._copy()
        found = files.child_names(self.spark, copy)
        if SUCCESS in found:
            # The setting is one of a session; the caller's stays as it is.
            own = self.spark.newSession()
            own.conf.set(ZONE, self.spark.conf.get(ZONE))
            own.conf.set(DYNAMIC, "dynamic")
            schema = self.read().schema
            own.read.schema(schema).parquet(copy).write.mode("overwrite").insertInto(self.name)
            self.spark.catalog.refreshTable(self.name)
        if found:
            files.remove(self.spark, copy)
        return SUCCESS in found

    def merge(self, source: DataFrame, keys: Sequence[str]) -> list:
        """Upserts ``source`` by ``keys`` and returns the partitions written.

        Partition columns must be keys, so a row can only be matched in its own partition: partitions
        without a row of the source are neither read nor written.  Otherwise as ``upsert``: keys the source does not
        have stay, a null key matches nothing, and a key that occurs twice in the source fails.
        """
        apart = set(self.partition_columns()) - set(keys)
        if apart:
            raise ValueError(f"partition columns that are no keys: {sorted(apart)}")
        self.recover()
        target, touched = self.in_partitions(source)
        if self.partition_columns() and not touched:
            return []
        self.overwrite_partitions(upsert(target, source, keys))
        return touched
