"""The seven datasets a dashboard reads, each a query over aggregate tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.functions.timeparts import clock
from kerbline.operators.ranking import share_of_group, top
from kerbline.plans.gold import AsOf
from kerbline.schema import COMPLETED


def _whole(column: str) -> Column:
    return F.round(F.col(column), 0).alias(column)


def kpis(live_kpis: DataFrame, status_breakdown: DataFrame, day: AsOf = None) -> DataFrame:
    """Headline numbers, one row per day (or for one ``day``).

    ``completed_rides_est`` is total rides less the rounded cancellation percentage.  It
    counts rides in progress as completed, so the exact ``completed_rides`` stands next to it.
    """
    if day is not None:
        wanted = F.col("event_date") == F.to_date(clock(day))
        live_kpis, status_breakdown = live_kpis.filter(wanted), status_breakdown.filter(wanted)
    done = status_breakdown.filter(F.col("status") == COMPLETED).select(
        F.col("event_date").alias("_day"), F.col("ride_count").alias("_done")
    )
    kept = F.col("total_rides") * (100 - F.col("cancellation_rate_pct")) / 100
    return live_kpis.join(done, F.col("event_date").eqNullSafe(F.col("_day")), "left").select(
        "event_date",
        "total_revenue_inr",
        "cancellation_rate_pct",
        "active_drivers",
        "avg_fare_inr",
        F.round(kept, 0).cast("bigint").alias("completed_rides_est"),
        F.coalesce("_done", F.lit(0)).cast("bigint").alias("completed_rides"),
    )


def revenue(revenue_per_minute: DataFrame) -> DataFrame:
    return revenue_per_minute.select("minute_bucket", "revenue_inr", "completed_rides").orderBy(
        "minute_bucket"
    )


def statuses(status_breakdown: DataFrame) -> DataFrame:
    """Status counts as stored: one row per day and status, the day not shown."""
    return status_breakdown.select(
        "status", F.col("ride_count").cast("bigint").alias("ride_count")
    ).orderBy(F.desc("ride_count"), "status")


def statuses_summed(status_breakdown: DataFrame) -> DataFrame:
    """One row per status over all days, as a pie needs it."""
    return (
        status_breakdown.groupBy("status")
        .agg(F.sum("ride_count").alias("ride_count"))
        .orderBy(F.desc("ride_count"), "status")
    )


def status_shares(status_breakdown: DataFrame) -> DataFrame:
    """Each status as a percentage of its day."""
    return share_of_group(status_breakdown, "ride_count", ["event_date"], "pct_of_total")


def cities(rides_by_city: DataFrame) -> DataFrame:
    return rides_by_city.select("city", _whole("revenue_inr")).orderBy(
        F.desc("revenue_inr"), "city"
    )


def zones(top_zones: DataFrame, k: int = 10) -> DataFrame:
    shown = top_zones.select(
        "zone_id",
        "city",
        _whole("total_revenue_inr"),
        F.col("completed_rides").cast("bigint").alias("completed_rides"),
        _whole("avg_fare_inr"),
    )
    return top(shown, k, F.desc("total_revenue_inr"), F.asc("zone_id"), F.asc("city"))


def cancel_reasons(cancellation_analysis: DataFrame) -> DataFrame:
    """Cancellations per city and reason over all days; an empty or missing reason shows
    the status instead."""
    reason = F.coalesce(F.nullif("cancellation_reason", F.lit("")), "status")
    return (
        cancellation_analysis.groupBy("city", reason.alias("reason"))
        .agg(F.sum("cancellation_count").cast("bigint").alias("cancellation_count"))
        .orderBy(F.desc("cancellation_count"), "city", "reason")
    )


def pickups(pickup_demand: DataFrame) -> DataFrame:
    """Demand per pickup area and zone over all days; the rate is the ratio of the sums."""
    summed = pickup_demand.groupBy("city", "pickup_area", "zone_id").agg(
        F.sum("total_rides").cast("bigint").alias("total_rides"),
        F.sum("cancelled_rides").cast("bigint").alias("cancelled_rides"),
    )
    rate = F.try_divide(F.col("cancelled_rides") * 100.0, F.col("total_rides"))
    return summed.withColumn("cancel_rate_pct", F.round(rate, 1)).orderBy(
        F.desc("total_rides"), "city", "pickup_area", "zone_id"
    )


# Dataset name -> its query and the aggregate tables it reads.
DATASETS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "ds_kpis": (kpis, ("gold_live_kpis", "gold_ride_status_breakdown")),
    "ds_revenue": (revenue, ("gold_revenue_per_minute",)),
    "ds_status": (statuses, ("gold_ride_status_breakdown",)),
    "ds_cities": (cities, ("gold_rides_by_city",)),
    "ds_zones": (zones, ("gold_top_zones",)),
    "ds_cancel_reasons": (cancel_reasons, ("gold_cancellation_analysis",)),
    "ds_pickup": (pickups, ("gold_pickup_demand",)),
}


def datasets(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every dataset whose tables are there."""
    return {
        name: view(*[tables[table] for table in needed])
        for name, (view, needed) in DATASETS.items()
        if all(table in tables for table in needed)
    }
