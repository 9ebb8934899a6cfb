"""Active drivers over any range of days, from one small sketch a day.

An exact distinct count needs every driver of every day again for each new range.  A HyperLogLog sketch of a
day holds ``2**log2_buckets`` registers at most, and the union of days' sketches is the sketch of all their rides: so a
day is counted once, arrives in parts if it must, and any range is answered from a row a day.
The relative standard error is about ``1.04 / sqrt(2**log2_buckets)``: 0.8 % at 14.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch as a power of two: 16 KB a day at most, below 1 % of standard error.
LOG2_BUCKETS = 14


def standard_error(log2_buckets: int = LOG2_BUCKETS) -> float:
    return 1.04 / 2 ** (log2_buckets / 2)


def sketch_days(
    rides: DataFrame, column: str = "driver_id", keys: Sequence[str] = ("event_date",), log2_buckets: int = LOG2_BUCKETS
) -> DataFrame:
    """``keys``, ``rides`` and ``sketch``: one row a day.  Sketches are built in the tasks and only they are
    shuffled.  Null values are not counted; a day of nothing else has an empty sketch."""
    return rides.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rides"), F.hll_sketch_agg(column, F.lit(log2_buckets)).alias("sketch")
    )


def merged(parts: DataFrame, keys: Sequence[str] = ("event_date",)) -> DataFrame:
    """Sketches added up to ``keys``: of old and new rides, or of a finer grain.  A day that got rides again
    is no special case."""
    return parts.groupBy(*keys).agg(F.sum("rides").alias("rides"), F.hll_union_agg("sketch").alias("sketch"))


def _days(first: date | str | None, last: date | str | None, column: str) -> Column:
    inside = F.lit(True)
    if first is not None:
        inside = inside & (F.col(column) >= F.lit(str(first)).cast("date"))
    if last is not None:
        inside = inside & (F.col(column) <= F.lit(str(last)).cast("date"))
    return inside


def active_between(
    sketches: DataFrame,
    first: date | str | None = None,
    last: date | str | None = None,
    by: Sequence[str] = (),
    day: str = "event_date",
) -> DataFrame:
    """``by``, ``days``, ``rides`` and ``active_drivers`` (an estimate) of a range of days, both ends
    included; an end left out is open, and days that are null count only if both are."""
    chosen = sketches.filter(_days(first, last, day))
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return chosen.groupBy(*by).agg(
        F.count_distinct(day).alias("days"),
        F.coalesce(F.sum("rides"), F.lit(0)).alias("rides"),
        F.coalesce(estimate, F.lit(0)).cast("bigint").alias("active_drivers"),
    )


def active_last_days(sketches: DataFrame, span: int = 7, day: str = "event_date") -> DataFrame:
    """For every day the drivers active on it and the ``span - 1`` days before, as ``event_date,
    days, active_drivers``.  Each stored row is sent to ``span`` days, whatever a day's rides."""
    ends = F.explode(F.sequence(F.col(day), F.date_add(day, span - 1))).alias("_end")
    spread = sketches.select(ends, F.col(day).alias("_day"), "sketch")
    known = sketches.select(F.col(day).alias("_end")).distinct()
    summed = spread.join(known, "_end").groupBy("_end")
    return summed.agg(
        F.count_distinct("_day").alias("days"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("active_drivers"),
    ).withColumnRenamed("_end", day)
