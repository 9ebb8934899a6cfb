"""The streaming queries: landing -> bronze -> silver -> aggregate tables.

Each query has its own checkpoint, which remembers what it has taken.  The same functions
serve a bounded run (``available_now``) and a continuous one (a trigger interval).
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kerbline.functions.timeparts import parsed_time
from kerbline.operators.cleaning import checked, clean, enrich
from kerbline.operators.quality import RULE_INPUTS, violations
from kerbline.plans.gold import GOLD_TABLES, PLACE_HOURS, ROLLUPS, ROOTS, AsOf, Rollup
from kerbline.plans.refresh import Outcome, check_modes, compact, refresh
from kerbline.sources.landing import landing_path, stream_landing
from kerbline.sources.snapshots import write_batch
from kerbline.sources.warehouse import Warehouse, bronze_schema, silver_schema
from kerbline.streaming.counts import QUALITY, RuleCounts, mend, silver_name, store_counts

log = logging.getLogger(__name__)


def _started(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_bronze(
    warehouse: Warehouse,
    landing: str | None = None,
    every: str | None = None,
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Ingests landed files, unchanged but for the time of ingest.  The file sink's own log
    makes each file count exactly once."""
    path = landing_path(warehouse.spark, landing, default=warehouse.landing)
    events = stream_landing(
        warehouse.spark,
        path,
        files_per_trigger=files_per_trigger,
        bytes_per_trigger=bytes_per_trigger,
        archive=archive,
    )
    writer = events.writeStream.queryName(f"bronze {warehouse.base}").outputMode("append")
    writer = writer.format("parquet").option("path", warehouse.bronze)
    return _started(writer, warehouse.checkpoint("bronze"), every)


def _bronze_stream(warehouse: Warehouse, files_per_trigger: int | None = None) -> DataFrame:
    reader = warehouse.spark.readStream.schema(bronze_schema())
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(warehouse.bronze)


def start_silver(
    warehouse: Warehouse,
    every: str | None = None,
    gather_days: bool = False,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Cleans bronze into silver, stored by day, and observes on the way how many rides break each rule:
    ``RuleCounts`` stores what is reported.

    Live data falls into one or two days, so by default nothing is shuffled.  Set
    ``gather_days`` when working off a backlog of many days: rows are then rebalanced by
    day, which avoids a file per day *and* task and still splits a day that is too big.
    """
    rides = checked(enrich(_bronze_stream(warehouse, files_per_trigger)), observe=QUALITY)
    if gather_days:
        rides = rides.hint("rebalance", "event_date")
    writer = rides.writeStream.queryName(silver_name(warehouse)).outputMode("append").partitionBy("event_date")
    writer = writer.format("parquet").option("path", warehouse.silver)
    return _started(writer, warehouse.checkpoint("silver"), every)


def start_rule_counts(
    warehouse: Warehouse, every: str | None = None, files_per_trigger: int | None = None
) -> StreamingQuery:
    """Counts, batch by batch, the events of bronze that break each rule.

    A stream of its own, for a silver that is not made here: it reads bronze once more.  Counts are rows of
    a table, stored under the batch's id, so a batch that is repeated is not counted twice.
    """
    needed = bronze_schema()
    used = {name for name in needed.fieldNames() if name in RULE_INPUTS}
    reader = warehouse.spark.readStream.schema(T.StructType([f for f in needed if f.name in used]))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def count(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("event_time", parsed_time(batch))
        write_batch(violations(timed), warehouse.quality, batch_id, "batch_id")

    writer = reader.parquet(warehouse.bronze).writeStream.queryName(f"rules {warehouse.base}")
    return _started(writer.foreachBatch(count), warehouse.checkpoint("rules"), every)


def start_silver_by_batch(
    warehouse: Warehouse, path: str, every: str | None = None
) -> StreamingQuery:
    """The same cleaning as a per-batch function, for sinks that have no streaming form.
    A failing batch is logged and stops the query; when replayed it replaces itself, and so
    do its rule counts, which are taken by the job that writes the rides."""

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        try:
            seen = Observation(QUALITY)
            write_batch(clean(batch, observe=seen), path, batch_id)
            store_counts(warehouse, seen.get, batch_id, f"{warehouse.quality}_by_batch")
        except Exception:
            log.exception("cleaning failed in batch %d", batch_id)
            raise

    writer = _bronze_stream(warehouse).writeStream.queryName(f"silver_by_batch {warehouse.base}")
    return _started(
        writer.foreachBatch(store_batch), warehouse.checkpoint("silver_by_batch"), every
    )


def start_rollup(
    warehouse: Warehouse,
    rollup: Rollup,
    every: str | None = None,
    refresh_tables: bool = False,
    as_of: AsOf = None,
    files_per_trigger: int | None = None,
    most_parts: int = 100,
    keep: int | None = None,
    clocked: bool = True,
) -> StreamingQuery:
    """Adds newly cleaned rides to one roll-up and those derived from it.  With
    ``refresh_tables`` the tables that depend on them follow after each batch, each in the
    mode declared for it (``clocked=False``: but for those that depend on the clock).  Once
    ``most_parts`` batches are there that all tables reflect, they are merged.

    A batch function sees a finished batch, through which no column pruning passes, so the
    stream itself reads only the columns the roll-up needs.
    """
    family = [rollup, *[child for child in ROLLUPS.values() if child.parent == rollup]]
    names = [
        table.name
        for table in GOLD_TABLES.values()
        if table.source in family and (clocked or not table.clocked)
    ]

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        warehouse.add_rides(rollup, batch, batch_id)
        if refresh_tables:
            refresh(warehouse, names, as_of=as_of, keep=keep)
        for member in family:
            compact(warehouse, member, at_least=most_parts)

    schema = silver_schema(warehouse.spark)
    needed = T.StructType([field for field in schema if field.name in rollup.inputs])
    reader = warehouse.spark.readStream.schema(needed)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    writer = reader.parquet(warehouse.silver).writeStream.queryName(f"{rollup.name} {warehouse.base}")
    return _started(writer.foreachBatch(add_batch), warehouse.checkpoint(rollup.name), every)


def start_rollups(warehouse: Warehouse, every: str | None = None, **options) -> list[StreamingQuery]:
    return [start_rollup(warehouse, rollup, every, **options) for rollup in ROOTS]


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Waits until every query has ended.  If one fails the others are stopped, rather than
    left running behind a wait that never returns, and its error is raised."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(1)]
    except Exception:
        for query in waiting:
            query.stop()
        raise


def start_clock(warehouse: Warehouse, every: str, keep: int | None = None) -> StreamingQuery:
    """Refreshes the tables that depend on the clock, also while no ride arrives."""
    names = [table.name for table in GOLD_TABLES.values() if table.clocked]

    needed = {GOLD_TABLES[name].source.name for name in names}

    def tick(batch: DataFrame, batch_id: int) -> None:
        if all(warehouse.rollup(name).latest() is not None for name in needed):
            refresh(warehouse, names, keep=keep)

    ticks = warehouse.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = ticks.writeStream.queryName(f"clock {warehouse.base}").foreachBatch(tick)
    return _started(writer, warehouse.checkpoint("clock"), every)


def start_all(
    warehouse: Warehouse, every: str = "10 seconds", keep: int | None = None, **bronze
) -> list[StreamingQuery]:
    """Continuous operation: tables are refreshed after each batch of cleaned rides, those that
    depend on the clock also in between.  ``keep`` bounds the versions kept of each table.  Rule counts are
    stored by a listener of the session, which stays attached."""
    RuleCounts(warehouse).attach()
    return [
        start_bronze(warehouse, every=every, **bronze),
        start_silver(warehouse, every=every),
        *start_rollups(warehouse, every=every, refresh_tables=True, keep=keep, clocked=False),
        start_clock(warehouse, every, keep),
    ]


def run_once(
    warehouse: Warehouse,
    landing: str | None = None,
    tables: Iterable[str] | None = None,
    mode: str | None = None,
    as_of: AsOf = None,
    gather_days: bool = False,
    files_per_trigger: int | None = None,
    keep: int | None = None,
    archive: str | None = None,
) -> list[Outcome]:
    """Takes in everything that has landed and refreshes the tables, then returns.

    The steps run one after another, so the refresh sees a silver table at rest.
    """
    warehouse.create()
    check_modes(tables, mode)
    bronze = start_bronze(warehouse, landing, files_per_trigger=files_per_trigger, archive=archive)
    await_all([bronze])
    counts = RuleCounts(warehouse).attach()
    try:
        silver = start_silver(warehouse, gather_days=gather_days)
        await_all([silver])
        counts.settle(silver)
    finally:
        counts.detach()
    mend(warehouse)
    await_all(start_rollups(warehouse))
    if warehouse.rollup(PLACE_HOURS.name).latest() is None:
        return []
    return refresh(warehouse, tables, mode, as_of, keep=keep)

