"""Roll-ups kept as a log: one part per micro-batch, added up when read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.plans.gold import Rollup
from kerbline.sources import files
from kerbline.sources.snapshots import StoredTable, write_batch

BATCH = "_batch_id"
_BATCH_FIELD = T.StructField(BATCH, T.LongType())
MERGED = -1  # id of the part that holds all merged batches


@dataclass(frozen=True)
class RollupLog:
    spark: SparkSession
    path: str
    rollup: Rollup

    @property
    def _table(self) -> StoredTable:
        return StoredTable(self.spark, self.path)

    def add(self, rides: DataFrame, batch_id: int) -> None:
        """Rolls up newly cleaned rides and stores them under their batch id."""
        self.add_parts(self.rollup.of(rides), batch_id)

    def add_parts(self, delta: DataFrame, batch_id: int) -> None:
        if self._table.current() is None:
            self._table.create(T.StructType([*delta.schema.fields, _BATCH_FIELD]))
        write_batch(delta, self._table.current_path(), batch_id, BATCH)

    def batch_ids(self) -> list[int]:
        """Ids of the stored parts, in order; merged batches count as one."""
        if self._table.current() is None:
            return []
        names = files.child_names(self.spark, self._table.current_path())
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))

    def latest(self) -> int | None:
        """Id of the newest batch that contributed rows."""
        return max(self.batch_ids(), default=None)

    def batch(self, batch_id: int) -> DataFrame:
        return self._table.read().filter(F.col(BATCH) == batch_id).drop(BATCH)

    def since(self, batch_id: int | None) -> DataFrame:
        """Parts of the batches after ``batch_id`` (all, if None)."""
        parts = self._table.read()
        if batch_id is not None:
            parts = parts.filter(F.col(BATCH) > batch_id)
        return parts.drop(BATCH)

    def read(self) -> DataFrame:
        return self.since(None)

    def merge_through(self, batch_id: int, at_least: int = 1) -> bool:
        """Adds up the batches up to ``batch_id`` into one part, as a new version, if that many
        are not merged yet; else nothing is written.

        The newest batch always stays apart, because it is the one a restarted stream may
        write again.  Call it from the stream's own batch function or while the stream
        is not running.
        """
        newest = self.latest()
        if newest is None:
            return False
        last = min(batch_id, newest - 1)
        if sum(MERGED < known <= last for known in self.batch_ids()) < at_least:
            return False
        parts = self._table.read()
        old = parts.filter(F.col(BATCH) <= last).drop(BATCH)
        merged = self.rollup.merged(old).withColumn(BATCH, F.lit(MERGED).cast("bigint"))
        kept = parts.filter(F.col(BATCH) > last)
        # Sorted by the grain, which starts with the day if it has one: a read of few days
        # then skips most files, and row groups within a file.
        order = [BATCH, *self.rollup.grain]
        both = merged.unionByName(kept).repartitionByRange(*order).sortWithinPartitions(*order)
        StoredTable(self.spark, self.path, BATCH).replace(both, arranged=True)
        return True

    def drop_old(self, keep: int) -> None:
        self._table.drop_old(keep)
