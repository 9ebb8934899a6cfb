"""Rule violations counted while silver is made, so that bronze is read once.

The silver stream carries its counts as observed metrics, and Spark reports them with each micro-batch.  A
listener stores them as rows, under the batch's id.  A report can be lost if the driver dies between a batch's
commit and the listener; ``missing`` tells such batches by their commits, and ``mend`` makes up for them.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from threading import Condition

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from kerbline.functions.timeparts import parsed_time
from kerbline.operators.quality import RIDE_RULES, RIDE_WATCHES, RULE_INPUTS, violations
from kerbline.sources import files
from kerbline.sources.snapshots import write_batch
from kerbline.sources.warehouse import Warehouse

log = logging.getLogger(__name__)

#: Name of the observed metrics, and of the column with the batch's id.
QUALITY, BATCH = "quality", "batch_id"
COUNTS = ("rows_in", *RIDE_RULES, "rows_dropped", *RIDE_WATCHES)


def silver_name(warehouse: Warehouse) -> str:
    return f"silver {warehouse.base}"


def store_counts(warehouse: Warehouse, counts: Mapping[str, int], batch_id: int, path: str | None = None) -> None:
    """One row of counts under a batch's id; a batch that is stored again replaces itself."""
    row = warehouse.spark.createDataFrame(
        [tuple(int(counts[name]) for name in COUNTS)], ", ".join(f"{name} bigint" for name in COUNTS)
    )
    write_batch(row, path or warehouse.quality, batch_id, BATCH)


class RuleCounts(StreamingQueryListener):
    """Stores the counts that the silver stream of one warehouse reports."""

    def __init__(self, warehouse: Warehouse):
        self._warehouse = warehouse
        self._ended: set[str] = set()
        self._change = Condition()

    def attach(self) -> RuleCounts:
        self._warehouse.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self._warehouse.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        found = progress.observedMetrics.get(QUALITY) if progress.name == silver_name(self._warehouse) else None
        if found is not None:
            try:
                store_counts(self._warehouse, found.asDict(), progress.batchId)
            except Exception:  # the stream itself is well; what is missing is made up for later
                log.exception("rule counts of batch %d were not stored", progress.batchId)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def settle(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Waits until all reports of a query that has ended were handled; says whether they were."""
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, seconds)


def missing(warehouse: Warehouse) -> list[int]:
    """Batches of silver that were committed but have no counts."""
    committed = files.child_names(warehouse.spark, f"{warehouse.checkpoint('silver')}/commits")
    known = files.child_names(warehouse.spark, warehouse.quality)
    done = {int(name.split("=")[1]) for name in known if name.startswith(f"{BATCH}=")}
    return sorted(int(name) for name in committed if name.isdigit() and int(name) not in done)


def read_counts(warehouse: Warehouse) -> DataFrame:
    """One row a batch: ``batch_id`` and the counts."""
    schema = ", ".join(f"{name} bigint" for name in (*COUNTS, BATCH))
    return warehouse.spark.read.schema(schema).parquet(warehouse.quality)


def mend(warehouse: Warehouse) -> list[int]:
    """Makes up for lost reports while silver is at rest and has taken all of bronze: what a count of bronze has
    beyond the stored counts goes to the first batch without counts, and the others get zeros.

    Returns the batches that were missing; without any, bronze is not read.
    """
    lost = missing(warehouse)
    if lost:
        bronze = warehouse.read_bronze().select(*RULE_INPUTS)
        whole = violations(bronze.withColumn("event_time", parsed_time(bronze))).first()
        stored = dict.fromkeys(COUNTS, 0)
        if files.child_names(warehouse.spark, warehouse.quality):
            sums = read_counts(warehouse).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in COUNTS])
            stored = sums.first().asDict()
        store_counts(warehouse, {name: whole[name] - stored[name] for name in COUNTS}, lost[0])
        for batch_id in lost[1:]:
            store_counts(warehouse, dict.fromkeys(COUNTS, 0), batch_id)
    return lost
