"""Where the tables live, and how they are offered to SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kerbline.operators.cleaning import clean
from kerbline.plans.dashboard import datasets
from kerbline.plans.gold import GOLD_TABLES, ROLLUPS, GoldTable, Rollup
from kerbline.schema import INGEST_TIME, RESCUED, RIDE_SCHEMA
from kerbline.sources import files
from kerbline.sources.rolluplog import RollupLog
from kerbline.sources.snapshots import StoredTable

BRONZE = "bronze_ride_events"
SILVER = "silver_ride_events"
COMMENTS = {
    BRONZE: "Ride events as landed, plus the time of ingest.  Append-only.",
    SILVER: "Typed and enriched rides that meet every quality rule.",
}


def bronze_schema() -> T.StructType:
    return T.StructType(
        [
            *RIDE_SCHEMA.fields,
            T.StructField(RESCUED, T.StringType()),
            T.StructField(INGEST_TIME, T.TimestampType()),
        ]
    )


def silver_schema(spark: SparkSession) -> T.StructType:
    """The cleaned columns, the partition column last: there a reader puts it anyway, and a
    stream started on a still empty folder would otherwise mix up positions later."""
    fields = clean(spark.createDataFrame([], bronze_schema())).schema.fields
    return T.StructType(sorted(fields, key=lambda field: field.name == "event_date"))


@dataclass(frozen=True)
class Warehouse:
    """One base folder on storage that all executors share."""

    spark: SparkSession
    base: str

    @property
    def landing(self) -> str:
        return f"{self.base}/landing"

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver"

    @property
    def quality(self) -> str:
        return f"{self.base}/quality"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    def rollup(self, name: str) -> RollupLog:
        return RollupLog(self.spark, f"{self.base}/rollups/{name}", ROLLUPS[name])

    def store(self, table: GoldTable) -> StoredTable:
        day = "event_date" if table.dated and not table.small else None
        return StoredTable(self.spark, f"{self.base}/gold/{table.name}", day)

    def add_rides(self, rollup: Rollup, rides: DataFrame, batch_id: int) -> None:
        """Adds newly cleaned rides to a roll-up and to those derived from it."""
        log = self.rollup(rollup.name)
        log.add(rides, batch_id)
        for name, child in ROLLUPS.items():
            if child.parent == rollup:
                self.rollup(name).add_parts(child.merged(log.batch(batch_id)), batch_id)

    def create(self) -> Warehouse:
        """Makes the folders, and checks that the time zone is the one they were made with:
        the stored days of events depend on it."""
        for path in (self.landing, self.bronze, self.silver, f"{self.base}/checkpoints"):
            files.make_directory(self.spark, path)
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        known = files.read_text(self.spark, f"{self.base}/_time_zone")
        if known is None:
            files.write_text(self.spark, f"{self.base}/_time_zone", zone)
        elif known != zone:
            raise ValueError(f"{self.base} was made in time zone {known}, the session has {zone}")
        return self

    def read_bronze(self) -> DataFrame:
        return self.spark.read.schema(bronze_schema()).parquet(self.bronze)

    def read_silver(self) -> DataFrame:
        schema = silver_schema(self.spark)
        return self.spark.read.schema(schema).parquet(self.silver).select(*schema.fieldNames())

    def read_gold(self, name: str) -> DataFrame:
        """A stored aggregate table, sorted the way it is meant to be read."""
        table = GOLD_TABLES[name]
        return table.in_order(self.store(table).read())

    def offer_views(self) -> list[str]:
        """Temporary views for SQL under the names of the tables and of the dashboard's
        datasets; returns the names."""
        frames = {BRONZE: self.read_bronze(), SILVER: self.read_silver()}
        for name, table in GOLD_TABLES.items():
            if self.store(table).current() is not None:
                frames[name] = self.store(table).read()
        frames.update(datasets(frames))
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
        return list(frames)

    def offer_database(self, database: str) -> list[str]:
        """The tables in a catalog database, with comment and tier.  Call it again after a
        refresh: a table may have a new version then, or new days.

        Bronze and silver become views on their folders: read as a folder, the sink's log
        decides which files count.
        """
        run = self.spark.sql
        run(f"CREATE DATABASE IF NOT EXISTS {database}")
        done = []
        for name, tier, path in ((BRONZE, "bronze", self.bronze), (SILVER, "silver", self.silver)):
            if files.child_names(self.spark, path):
                run(
                    f"CREATE OR REPLACE VIEW {database}.{name} COMMENT '{COMMENTS[name]}' "
                    f"TBLPROPERTIES ('quality' = '{tier}') AS SELECT * FROM parquet.`{path}`"
                )
                done.append(f"{database}.{name}")
        for name, table in GOLD_TABLES.items():
            store = self.store(table)
            if store.current() is None:
                continue
            full = f"{database}.{name}"
            schema = store.read().schema
            run(f"DROP TABLE IF EXISTS {full}")  # external: only the catalog entry goes
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            by_day = " PARTITIONED BY (event_date)" if store.day_column else ""
            run(
                f"CREATE TABLE {full} ({columns}) USING parquet{by_day} "
                f"LOCATION '{store.current_path()}' COMMENT '{table.comment.replace(chr(39), chr(39) * 2)}'"
            )
            if store.day_column:
                run(f"ALTER TABLE {full} RECOVER PARTITIONS")
            run(f"ALTER TABLE {full} SET TBLPROPERTIES ('quality' = 'gold')")
            done.append(full)
        return done
