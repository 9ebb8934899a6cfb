"""A materialized view over a table that arrives in batches: define, query the stored rows, refresh.

A view keeps its additive state beside the rows it shows.  The state's version and the note of
which batches it reflects come to count at the same moment, so a refresh that died is simply run
again and adds no batch twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.plans import orders
from kerbline.sources import files
from kerbline.sources.snapshots import StoredTable, write_batch

BATCH = "_batch_id"


@dataclass(frozen=True)
class View:
    name: str
    comment: str
    source: str  # folder of the source's batches, below the base
    counted: Callable[[DataFrame], DataFrame]
    state: Callable[[DataFrame], DataFrame]
    add: Callable[[DataFrame, DataFrame], DataFrame]
    shown: Callable[[DataFrame], DataFrame]
    modes: tuple[str, ...] = ("full", "incremental")

    def store(self, spark: SparkSession, base: str) -> StoredTable:
        return StoredTable(spark, f"{base}/gold/{self.name}")

    def _state(self, spark: SparkSession, base: str) -> StoredTable:
        return StoredTable(spark, f"{base}/gold/{self.name}_state")

    def add_rows(self, spark: SparkSession, base: str, rows: DataFrame, batch_id: int) -> None:
        """Adds a batch to the source; a batch that is added again replaces itself."""
        write_batch(rows, f"{base}/{self.source}", batch_id, BATCH)

    def latest(self, spark: SparkSession, base: str) -> int | None:
        names = files.child_names(spark, f"{base}/{self.source}")
        return max((int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}=")), default=None)

    def read(self, spark: SparkSession, base: str) -> DataFrame:
        """The rows as of the last refresh."""
        return self.store(spark, base).read()

    def refresh(self, spark: SparkSession, base: str, mode: str) -> str:
        """``full`` reads the whole source, ``incremental`` the batches that came since the last
        refresh; without a new batch nothing is done.  Returns what was done."""
        newest = self.latest(spark, base)
        if newest is None:
            raise LookupError(f"{self.name}: the source has no rows yet")
        store, state = self.store(spark, base), self._state(spark, base)
        if (store.noted() or {}).get("source") == newest:
            return "skipped"
        rows = spark.read.parquet(f"{base}/{self.source}")
        known = (state.noted() or {}).get("source")
        if mode == "incremental" and known is not None:
            if known < newest:
                fresh = self.state(self.counted(rows.filter(F.col(BATCH) > known)))
                state.replace(self.add(state.read(), fresh), note={"source": newest})
        else:
            state.replace(self.state(self.counted(rows)), note={"source": newest})
        store.replace(self.shown(state.read()), note={"source": newest})
        state.drop_old(2)
        return mode


REVENUE_BY_CATEGORY = View(
    "revenue_by_category",
    "Delivered orders, their revenue and mean value per category.",
    "orders",
    orders.delivered_orders,
    orders.category_state,
    orders.add_state,
    orders.shown,
)

VIEWS: dict[str, View] = {view.name: view for view in (REVENUE_BY_CATEGORY,)}
