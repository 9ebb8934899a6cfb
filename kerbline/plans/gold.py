"""The aggregate tables over cleaned rides.

Each table is declared once: its keys, the measures it shows and the rows it covers.
``build`` computes it from cleaned rides, ``from_rollup`` from a stored roll-up; both
end in the same code.  Builders return unsorted rows (a stored order would be lost);
``in_order`` sorts for reading.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.timeparts import (
    clock,
    first_minute,
    is_weekend,
    minute_of,
    trailing_window,
    whole_minutes,
)
from kerbline.operators import ranking
from kerbline.operators.rollup import (
    Fact,
    Measure,
    count_of,
    latest_of,
    lift,
    mean_of,
    mean_parts,
    percent_of,
    regroup,
    tally,
    total_of,
)
from kerbline.schema import COMPLETED, INGEST_TIME

AsOf = datetime | str | None


def completed() -> Column:
    return F.col("status") == COMPLETED


def _when_completed(column: str) -> Callable[[], Column]:
    return lambda: F.when(completed(), F.col(column))


# Fares and ratings count for completed rides only: a cancelled ride carries a fare too.
RIDE_FACTS: dict[str, Fact] = {
    fact.name: fact
    for fact in (
        tally("rides", lambda: F.col("ride_id").isNotNull()),
        tally("completed", completed),
        tally("served", lambda: completed() & F.col("ride_id").isNotNull()),
        tally("cancelled", lambda: F.col("is_cancelled")),
        *mean_parts("fare", _when_completed("final_fare")),
        *mean_parts("rating", _when_completed("driver_rating")),
        *mean_parts("surge", lambda: F.col("surge_multiplier")),
        *mean_parts("distance", lambda: F.col("distance_km")),
        Fact("ingested", lambda: F.col(INGEST_TIME), F.max),
    )
}


@dataclass(frozen=True)
class Rollup:
    """A stored roll-up: the grain kept, the facts kept at that grain, and the further
    columns of a cleaned ride from which these are computed.  A roll-up with a ``parent``
    is added up from the parent's rows instead of from rides."""

    name: str
    grain: tuple[str, ...]
    facts: tuple[str, ...]
    reads: tuple[str, ...] = ()
    parent: Rollup | None = None
    placed: Callable[[DataFrame], DataFrame] = lambda rides: rides  # adds dimensions to rides

    @property
    def root(self) -> Rollup:
        """The roll-up added up from rides from which this one descends."""
        return self if self.parent is None else self.parent.root

    @property
    def inputs(self) -> set[str]:
        return {*self.grain, *self.reads}

    def chosen(self) -> list[Fact]:
        return [RIDE_FACTS[name] for name in self.facts]

    def of(self, silver: DataFrame) -> DataFrame:
        lifted = lift(self.placed(silver), self.chosen(), self.grain)
        return regroup(lifted, self.grain, self.chosen())

    def merged(self, parts: DataFrame) -> DataFrame:
        return regroup(parts, self.grain, self.chosen())


# Every place-and-time table can be read off the first, every per-driver table (and the
# exact distinct driver count) off the second, so a refresh of all tables scans the
# cleaned rides twice instead of once per table.
PLACE_HOURS = Rollup(
    "place_hours",
    (
        "event_date",
        "event_hour",
        "city",
        "pickup_area",
        "zone_id",
        "status",
        "is_cancelled",
        "cancellation_reason",
    ),
    (
        "rides",
        "completed",
        "cancelled",
        "fare_sum",
        "fare_n",
        "surge_sum",
        "surge_n",
        "distance_sum",
        "distance_n",
    ),
    ("ride_id", "final_fare", "surge_multiplier", "distance_km"),
)
DRIVER_DAYS = Rollup(
    "driver_days",
    ("event_date", "driver_id"),
    (
        "rides",
        "completed",
        "cancelled",
        "fare_sum",
        "fare_n",
        "rating_sum",
        "rating_n",
        "ingested",
    ),
    ("ride_id", "status", "is_cancelled", "final_fare", "driver_rating", INGEST_TIME),
)
def _by_minute(rides: DataFrame) -> DataFrame:
    return rides.withColumn("minute_bucket", minute_of(rides))


# Whole minutes, of which a sliding window is the sum but for the part of its first minute.
MINUTES = Rollup(
    "minutes",
    ("event_date", "minute_bucket"),
    ("completed", "served", "fare_sum"),
    ("ride_id", "event_time", "status", "final_fare"),
    placed=_by_minute,
)
# Totals over all days: kept apart so that a refresh does not add up the whole history.
CITY_TOTALS = Rollup(
    "city_totals", ("city",), ("rides", "completed", "fare_sum", "fare_n"), parent=PLACE_HOURS
)
ROLLUPS = {rollup.name: rollup for rollup in (PLACE_HOURS, DRIVER_DAYS, MINUTES, CITY_TOTALS)}
# Those that are added up from cleaned rides.
ROOTS = tuple(rollup for rollup in ROLLUPS.values() if rollup.parent is None)

Rows = Callable[[DataFrame, AsOf], DataFrame]


def _all_rows(rows: DataFrame, as_of: AsOf) -> DataFrame:
    return rows


@dataclass(frozen=True)
class GoldTable:
    name: str
    comment: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    rollup: Rollup | None = None
    covers: Rows = _all_rows  # which rows count; sees cleaned rides or a roll-up
    edge: Rows | None = None  # cleaned rides that count beside those rows of the roll-up
    distinct: tuple[str, str] | None = None  # (column counted, name shown)
    finish: Callable[[DataFrame], DataFrame] = lambda df: df
    order: Callable[[], Sequence[Column]] = tuple
    clocked: bool = False  # depends on as_of
    small: bool = False  # has so few rows a day that a file for each day would not pay

    @property
    def dated(self) -> bool:
        """Whether one day's rows depend on that day's rides only."""
        return "event_date" in self.keys

    @property
    def source(self) -> Rollup:
        """The roll-up whose batches tell that, and on which days, rides were added."""
        return self.rollup or PLACE_HOURS

    @property
    def modes(self) -> tuple[str, ...]:
        """Refresh modes that give exactly the full recompute's result."""
        allowed = ["full"]
        if self.dated:
            allowed.append("partitions")
        if self.rollup is not None:
            allowed.append("incremental")
        return tuple(allowed)

    def facts(self) -> list[Fact]:
        names = dict.fromkeys(name for measure in self.measures for name in measure.uses)
        return [RIDE_FACTS[name] for name in names]

    def build(self, silver: DataFrame, as_of: AsOf = None) -> DataFrame:
        rows = self.covers(silver, as_of)
        dimensions = [*self.keys]
        if self.distinct:
            dimensions.append(self.distinct[0])
        return self._summarise(lift(rows, self.facts(), dimensions))

    def from_rollup(
        self, parts: DataFrame, as_of: AsOf = None, rides: DataFrame | None = None
    ) -> DataFrame:
        """From a stored roll-up; a table with an ``edge`` also needs the cleaned ``rides``."""
        rows = self.covers(parts, as_of)
        if self.edge is not None:
            facts = self.facts()
            beside = lift(self.edge(rides, as_of), facts, self.keys)
            rows = rows.select(*self.keys, *[fact.name for fact in facts]).unionByName(beside)
        return self._summarise(rows)

    def _summarise(self, parts: DataFrame) -> DataFrame:
        more = []
        if self.distinct:
            # Two levels: one row per distinct value first, so a key with very many rows
            # is spread over its values before they are counted.
            column, shown = self.distinct
            parts = regroup(parts, [*self.keys, column], self.facts())
            more = [F.count(column).alias(shown)]
        merged = regroup(parts, self.keys, self.facts(), *more)
        shown = [measure.column() for measure in self.measures]
        counts = [self.distinct[1]] if self.distinct else []
        return self.finish(merged.select(*self.keys, *shown, *counts))

    def in_order(self, table: DataFrame) -> DataFrame:
        order = self.order()
        return table.orderBy(*order) if order else table


def _cancelled_rows(rows: DataFrame, as_of: AsOf) -> DataFrame:
    return rows.filter("is_cancelled")


def _completed_on_day(rows: DataFrame, as_of: AsOf) -> DataFrame:
    day = F.current_date() if as_of is None else F.to_date(clock(as_of))
    return rows.filter((F.col("event_date") == day) & completed())


def last_minutes(minutes: int) -> Rows:
    def rows_in_window(rows: DataFrame, as_of: AsOf) -> DataFrame:
        if "minute_bucket" in rows.columns:  # a roll-up: the minutes that count as a whole
            inside = whole_minutes(rows, as_of, minutes, "minute_bucket")
            return rows.filter(inside & (F.col("completed") > 0))
        return _by_minute(rows.filter(completed() & trailing_window(rows, as_of, minutes)))

    return rows_in_window


def first_of_last_minutes(minutes: int) -> Rows:
    def rows_at_edge(rides: DataFrame, as_of: AsOf) -> DataFrame:
        return _by_minute(rides.filter(completed() & first_minute(rides, as_of, minutes)))

    return rows_at_edge


def _served(rows: DataFrame, as_of: AsOf) -> DataFrame:
    """Completed rides; in a roll-up by driver, drivers who completed one."""
    return rows.filter(completed() if "status" in rows.columns else F.col("completed") > 0)


def _desc(*names: str) -> Callable[[], Sequence[Column]]:
    return lambda: [F.desc(names[0]), *[F.asc(name) for name in names[1:]]]


LIVE_KPIS = GoldTable(
    "gold_live_kpis",
    "Rides, revenue, cancellation rate and active drivers per day; "
    "a driver is active by being assigned, also to a ride nobody served.",
    ("event_date",),
    (
        count_of("total_rides", "rides"),
        total_of("total_revenue_inr", "fare_sum", digits=None, empty=0.0),
        percent_of("cancellation_rate_pct", "cancelled", "rides"),
        mean_of("avg_fare_inr", "fare", 2),
        latest_of("last_updated", "ingested"),
    ),
    DRIVER_DAYS,
    distinct=("driver_id", "active_drivers"),
    order=lambda: [F.asc("event_date")],
    small=True,
)


def revenue_per_minute_table(minutes: int = 60) -> GoldTable:
    """Revenue per minute of the last ``minutes``, counted back from the clock.  The first
    minute may be cut by the window, so its rides are looked up; the others are stored sums."""
    return GoldTable(
        "gold_revenue_per_minute",
        f"Completed rides and their revenue per minute, from {minutes} minutes ago on.",
        ("minute_bucket",),
        (total_of("revenue_inr", "fare_sum"), count_of("completed_rides", "served")),
        MINUTES,
        covers=last_minutes(minutes),
        edge=first_of_last_minutes(minutes),
        order=lambda: [F.asc("minute_bucket")],
        clocked=True,
    )


REVENUE_PER_MINUTE = revenue_per_minute_table()

RIDES_BY_CITY = GoldTable(
    "gold_rides_by_city",
    "Rides and revenue per city over all days.",
    ("city",),
    (
        count_of("total_rides", "rides"),
        count_of("completed_rides", "completed"),
        total_of("revenue_inr", "fare_sum", empty=0.0),
        mean_of("avg_fare_inr", "fare", 2),
    ),
    CITY_TOTALS,
    order=_desc("total_rides", "city"),
)


def top_zones_table(k: int = 10) -> GoldTable:
    """The ``k`` zones with most revenue on the day of the clock; ties go by zone, then city."""
    order = _desc("total_revenue_inr", "zone_id", "city")
    return GoldTable(
        "gold_top_zones",
        f"The {k} zones with most revenue from completed rides on one day.",
        ("zone_id", "city"),
        (
            total_of("total_revenue_inr", "fare_sum"),
            count_of("completed_rides", "rides"),
            mean_of("avg_fare_inr", "fare", 2),
            mean_of("avg_distance_km", "distance", 1),
        ),
        PLACE_HOURS,
        covers=_completed_on_day,
        finish=lambda table: ranking.top(table, k, *order()),
        order=order,
        clocked=True,
    )


TOP_ZONES = top_zones_table()

STATUS_BREAKDOWN = GoldTable(
    "gold_ride_status_breakdown",
    "Rides per day and status.",
    ("event_date", "status"),
    (count_of("ride_count", "rides"),),
    PLACE_HOURS,
    order=_desc("ride_count", "event_date", "status"),
    small=True,
)

PICKUP_DEMAND = GoldTable(
    "gold_pickup_demand",
    "Demand, cancellations, surge and revenue per day, pickup area and zone.",
    ("event_date", "city", "pickup_area", "zone_id"),
    (
        count_of("total_rides", "rides"),
        count_of("completed_rides", "completed"),
        count_of("cancelled_rides", "cancelled"),
        percent_of("cancellation_rate_pct", "cancelled", "rides"),
        mean_of("avg_surge", "surge", 2),
        total_of("revenue_inr", "fare_sum", empty=0.0),
    ),
    PLACE_HOURS,
    order=_desc("total_rides", "event_date", "city", "pickup_area", "zone_id"),
)

CANCELLATION_ANALYSIS = GoldTable(
    "gold_cancellation_analysis",
    "Cancelled rides per day, city, status and stated reason (a missing reason is a group).",
    ("event_date", "city", "status", "cancellation_reason"),
    (
        count_of("cancellation_count", "rides"),
        mean_of("avg_surge_at_cancel", "surge", 2),
        mean_of("avg_distance_km", "distance", 1),
    ),
    PLACE_HOURS,
    covers=_cancelled_rows,
    order=_desc("cancellation_count", "event_date", "city", "status", "cancellation_reason"),
)

HOURLY_DEMAND = GoldTable(
    "gold_hourly_demand",
    "Demand per day, hour and city.  (Definition of this project.)",
    ("event_date", "event_hour", "city"),
    (
        count_of("total_rides", "rides"),
        count_of("completed_rides", "completed"),
        count_of("cancelled_rides", "cancelled"),
        mean_of("avg_surge", "surge", 2),
        Measure("is_weekend", lambda: is_weekend(F.col("event_date")), ()),
    ),
    PLACE_HOURS,
    order=lambda: [F.asc("event_date"), F.asc("event_hour"), F.asc("city")],
    small=True,
)

DRIVER_LEADERBOARD = GoldTable(
    "gold_driver_leaderboard",
    "Completed rides, revenue and rating per day and driver, ranked by revenue within the "
    "day.  Grouped by driver id alone: one id may appear under several names.  "
    "(Definition of this project.)",
    ("event_date", "driver_id"),
    (
        count_of("completed_rides", "completed"),
        total_of("revenue_inr", "fare_sum"),
        mean_of("avg_rating", "rating", 2),
    ),
    DRIVER_DAYS,
    covers=_served,
    finish=lambda table: ranking.rank_within(table, "event_date", "revenue_inr"),
    order=lambda: [F.asc("event_date"), F.asc("rank"), F.asc("driver_id")],
)

GOLD_TABLES: dict[str, GoldTable] = {
    table.name: table
    for table in (
        LIVE_KPIS,
        REVENUE_PER_MINUTE,
        RIDES_BY_CITY,
        TOP_ZONES,
        STATUS_BREAKDOWN,
        PICKUP_DEMAND,
        CANCELLATION_ANALYSIS,
        HOURLY_DEMAND,
        DRIVER_LEADERBOARD,
    )
}
