"""Bronze and silver as tables of the catalog: streams that write and read them by name.

A table that a stream writes belongs to that stream: its sink's log tells which files count, also to
batch readers, so rows put in by ``INSERT`` would not be seen, and its small files stay.  Silver by day
(``start_days``) is an ordinary table instead, to which each micro-batch adds its rows: its days can be
written anew in few files while the stream goes on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kerbline.operators.cleaning import checked, enrich
from kerbline.sources.landing import landing_path, stream_landing
from kerbline.sources.tables import CatalogTable, create_database
from kerbline.sources.warehouse import BRONZE, COMMENTS, SILVER, bronze_schema, silver_schema

#: Rides by day, and the column that tells which micro-batch a ride came with.
DAYS, BATCH = "silver_days", "batch_id"


def add_batch(table: CatalogTable, rows: DataFrame, batch_id: int, again: bool) -> None:
    """Adds a micro-batch to a table that has its id in ``BATCH``.

    ``again`` says that the batch may be there already, whole or in part: it then replaces itself, in the
    partitions that it falls into.  No others are read.
    """
    rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
    if again:
        table.recover()
        there, _ = table.in_partitions(rows)
        if not there.filter(F.col(BATCH) == batch_id).isEmpty():
            others = there.filter(F.col(BATCH) != batch_id)
            table.overwrite_partitions(others.unionByName(rows))
            return
    table.insert(rows)


@dataclass(frozen=True)
class StreamTables:
    """The tables of one database, and the folder of the streams' checkpoints."""

    spark: SparkSession
    database: str
    checkpoints: str

    @property
    def bronze(self) -> CatalogTable:
        return CatalogTable(self.spark, f"{self.database}.{BRONZE}")

    @property
    def silver(self) -> CatalogTable:
        return CatalogTable(self.spark, f"{self.database}.{SILVER}")

    @property
    def days(self) -> CatalogTable:
        return CatalogTable(self.spark, f"{self.database}.{DAYS}")

    def create(self) -> StreamTables:
        """The database and its empty tables, with comment and tier; what is there stays."""
        create_database(self.spark, self.database, "Ride events by stage")
        self.bronze.create(bronze_schema(), (), COMMENTS[BRONZE], "bronze")
        self.silver.create(silver_schema(self.spark), ("event_date",), COMMENTS[SILVER], "silver")
        by_day = T.StructType([T.StructField(BATCH, T.LongType()), *silver_schema(self.spark)])
        self.days.create(by_day, ("event_date",), COMMENTS[SILVER], "silver")
        return self

    def start_bronze(
        self,
        landing: str | None = None,
        every: str | None = None,
        files_per_trigger: int | None = None,
        archive: str | None = None,
    ) -> StreamingQuery:
        """Landed files into the bronze table.  Without ``every``, what is there now."""
        path = landing_path(self.spark, landing)
        events = stream_landing(self.spark, path, files_per_trigger=files_per_trigger, archive=archive)
        return self._started(events.writeStream, self.bronze, every)

    def read_bronze(self, files_per_trigger: int | None = None) -> DataFrame:
        reader = self.spark.readStream
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.table(self.bronze.name)

    def start_silver(
        self, every: str | None = None, files_per_trigger: int | None = None, gather_days: bool = False
    ) -> StreamingQuery:
        """Cleaned rides from the bronze table into the silver table, by day."""
        rides = self._rides(files_per_trigger)
        if gather_days:
            rides = rides.hint("rebalance", "event_date")
        return self._started(rides.writeStream.partitionBy("event_date"), self.silver, every)

    def _rides(self, files_per_trigger: int | None) -> DataFrame:
        rides = checked(enrich(self.read_bronze(files_per_trigger)))
        return rides.select(*silver_schema(self.spark).fieldNames())

    def start_days(
        self, every: str | None = None, files_per_trigger: int | None = None, compact_every: int = 0, most_files: int = 8
    ) -> StreamingQuery:
        """Cleaned rides from the bronze table into silver by day, batch by batch.

        Only the first batch after a start can be there already, and only it is looked for.  With
        ``compact_every``, crowded days are written anew after every so many batches.
        """
        name, fresh = self.days.name, [True]

        def store(batch: DataFrame, batch_id: int) -> None:
            table = CatalogTable(batch.sparkSession, name)
            add_batch(table, batch, batch_id, again=fresh[0])
            fresh[0] = False
            if compact_every and batch_id % compact_every == compact_every - 1:
                table.compact(most_files=most_files)

        return self._triggered(self._rides(files_per_trigger).writeStream.foreachBatch(store), name, every).start()

    def compact_days(self, where: Column | None = None, most_files: int = 8) -> list:
        """Writes crowded days anew; not while ``start_days`` runs, which does this itself."""
        return self.days.compact(where, most_files)

    def _started(self, writer: DataStreamWriter, table: CatalogTable, every: str | None) -> StreamingQuery:
        return self._triggered(writer.outputMode("append"), table.name, every).toTable(table.name)

    def _triggered(self, writer: DataStreamWriter, name: str, every: str | None) -> DataStreamWriter:
        trigger = {"processingTime": every} if every else {"availableNow": True}
        writer = writer.queryName(name).option("checkpointLocation", f"{self.checkpoints}/{name}")
        return writer.trigger(**trigger)
