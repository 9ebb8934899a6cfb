"""The aggregate tables: special values, equality of the three ways to build them, plans."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kerbline.operators.cleaning import clean
from kerbline.operators.ranking import rank_within
from kerbline.plans import dashboard, gold
from testbed.rides import rides_view
from tests.conftest import SF_DIR, a_ride, bag, plan_of

AS_OF = "2024-01-30 12:00:00"


@pytest.fixture(scope="module")
def silver(spark):
    return clean(rides_view(spark, SF_DIR)).persist()


def test_day_without_completed_rides(rides_of):
    silver = clean(rides_of(a_ride(status="no_driver_found"), a_ride(status="in_progress")))
    (row,) = gold.LIVE_KPIS.build(silver).collect()
    assert row.total_rides == 2 and row.total_revenue_inr == 0.0
    assert row.avg_fare_inr is None and row.cancellation_rate_pct == 50.0
    assert row.active_drivers == 1  # also for a ride nobody served


def test_equal_ride_ids_count_separately(rides_of):
    (row,) = gold.RIDES_BY_CITY.build(clean(rides_of(a_ride(), a_ride()))).collect()
    assert row.total_rides == 2


def test_drivers_counted_once_and_null_driver_not_at_all(rides_of):
    rides = rides_of(a_ride(), a_ride(), a_ride(driver_id="DRV-2"), a_ride(driver_id=None))
    (row,) = gold.LIVE_KPIS.build(clean(rides)).collect()
    assert (row.total_rides, row.active_drivers) == (4, 2)


def test_half_up_rounding(rides_of):
    rides = [a_ride(status="cancelled_by_user"), *[a_ride() for _ in range(15)]]
    (row,) = gold.LIVE_KPIS.build(clean(rides_of(*rides))).collect()
    assert row.cancellation_rate_pct == 6.3  # 6.25


def test_missing_and_empty_reasons(rides_of):
    cancelled = {"status": "cancelled_by_user"}
    rides = rides_of(
        a_ride(**cancelled, cancellation_reason=None),
        a_ride(**cancelled, cancellation_reason=""),
        a_ride(**cancelled, cancellation_reason="Too far"),
    )
    table = gold.CANCELLATION_ANALYSIS.build(clean(rides))
    assert {row.cancellation_reason for row in table.collect()} == {None, "", "Too far"}
    shown = {row.reason: row.cancellation_count for row in dashboard.cancel_reasons(table).collect()}
    assert shown == {"cancelled_by_user": 2, "Too far": 1}


def test_trailing_window_keeps_the_bound_and_the_future(rides_of):
    times = ["10:59:59", "11:00:00", "11:00:59", "12:30:00"]
    rides = rides_of(*[a_ride(event_time=f"2024-03-02T{t}Z", final_fare=9.0) for t in times])
    table = gold.REVENUE_PER_MINUTE.build(clean(rides), datetime(2024, 3, 2, 12))
    assert bag(table) == [
        (datetime(2024, 3, 2, 11, 0), 18.0, 2),
        (datetime(2024, 3, 2, 12, 30), 9.0, 1),
    ]


def test_without_a_clock_the_wall_clock_is_used(rides_of):
    now = rides_of(a_ride()).withColumn("event_time", F.current_timestamp())
    silver = clean(now)
    assert gold.REVENUE_PER_MINUTE.build(silver).count() == 1
    assert gold.TOP_ZONES.build(silver).count() == 1


def test_top_zones_breaks_ties_by_zone_and_stops_at_k(rides_of):
    rides = [a_ride(zone_id=f"Z{i:02d}", ride_id=f"R{i}") for i in range(15)]
    rides.append(a_ride(zone_id="Z14", ride_id="more"))
    table = gold.TOP_ZONES.build(clean(rides_of(*rides)), "2024-03-02")
    assert {row.zone_id for row in table.collect()} == {"Z14", *[f"Z{i:02d}" for i in range(9)]}


def test_other_window_and_k(silver):
    assert gold.top_zones_table(3).build(silver, AS_OF).count() == 3
    hour = gold.REVENUE_PER_MINUTE.build(silver, AS_OF)
    day = gold.revenue_per_minute_table(24 * 60).build(silver, AS_OF)
    assert hour.count() < day.count()


@pytest.mark.parametrize("name", [n for n, t in gold.GOLD_TABLES.items() if t.rollup])
def test_from_rollup_and_in_two_parts(silver, name):
    """A table from rows, from a roll-up, and from the sum of two roll-ups are one table."""
    table = gold.GOLD_TABLES[name]
    direct = bag(table.build(silver, AS_OF))
    assert bag(table.from_rollup(table.rollup.of(silver), AS_OF)) == direct
    early = F.col("event_hour") < 11
    parts = table.rollup.of(silver.filter(early)).unionByName(table.rollup.of(silver.filter(~early)))
    assert bag(table.from_rollup(table.rollup.merged(parts), AS_OF)) == direct


def test_rank_matches_a_plain_window(spark):
    """Ties, nulls, null groups, negative values and values across bands."""
    some = (5000.0, 5000.0, 1.5, 1.5, -3.0, None, 999.99, 1000.0)
    rows = [(group, value) for group in (1, 2, None) for value in some]
    rows += [(1, float(v)) for v in range(0, 9000, 7)]
    frame = spark.createDataFrame(rows, "g int, v double")
    window = "rank() over (partition by g order by v desc nulls last)"
    expected = frame.selectExpr("g", "v", f"cast({window} as bigint) as rank")
    assert bag(rank_within(frame, "g", "v"), "g", "v", "rank") == bag(expected)


def test_rank_has_no_window_over_a_whole_group(silver):
    plan = plan_of(gold.DRIVER_LEADERBOARD.build(silver))
    windows = [line for line in plan.splitlines() if " Window " in line or "+- Window" in line]
    assert windows and all("_band" in line or "_rows" in line for line in windows)


def test_kpis_exact_and_estimated(rides_of):
    rides = [a_ride(), a_ride(), a_ride(status="in_progress"), a_ride(status="no_driver_found")]
    silver = clean(rides_of(*rides))
    live, statuses = gold.LIVE_KPIS.build(silver), gold.STATUS_BREAKDOWN.build(silver)
    (row,) = dashboard.kpis(live, statuses).collect()
    assert (row.completed_rides, row.completed_rides_est) == (2, 3)
    assert dashboard.kpis(live, statuses, "2024-03-02").count() == 1
    assert dashboard.kpis(live, statuses, date(2024, 3, 3)).count() == 0


def test_plans(spark, silver, base):
    silver.write.partitionBy("event_date").parquet(f"{base}/silver")
    stored = spark.read.parquet(f"{base}/silver")
    zones = plan_of(gold.TOP_ZONES.build(stored, AS_OF))
    assert "TakeOrderedAndProject" in zones
    assert "PartitionFilters: [isnotnull(event_date" in zones
    assert "EqualTo(status,completed)" in zones
    minutes = plan_of(gold.REVENUE_PER_MINUTE.build(stored, AS_OF))
    assert "PartitionFilters: [isnotnull(event_date" in minutes
    assert "GreaterThanOrEqual(event_time" in minutes
    statuses = plan_of(gold.STATUS_BREAKDOWN.build(stored))
    assert "ReadSchema: struct<ride_id:string,status:string>" in statuses
    assert statuses.count("Exchange") == 1
    for table in gold.GOLD_TABLES.values():
        assert "Python" not in plan_of(table.build(stored, AS_OF))


def test_large_measures_are_added_up_exactly(rides_of):
    rides = [a_ride(final_fare=fare) for fare in (1e15, 5.0, 3e15)]
    silver = clean(rides_of(*rides))
    row = gold.LIVE_KPIS.build(silver).first()
    assert row["total_revenue_inr"] == 4e15 + 5
    assert row["avg_fare_inr"] == round((4e15 + 5) / 3, 2)
    parts = gold.DRIVER_DAYS.of(silver)
    assert gold.LIVE_KPIS.from_rollup(parts).first() == row


@pytest.mark.parametrize("fare", [float("inf"), 1e25])
def test_a_measure_that_cannot_be_added_up_fails(rides_of, fare):
    silver = clean(rides_of(a_ride(), a_ride(final_fare=fare)))
    with pytest.raises(Exception, match="cannot be added up"):
        gold.LIVE_KPIS.build(silver).collect()


def test_a_missing_measure_is_left_out_of_mean_and_sum(rides_of):
    row = gold.PICKUP_DEMAND.build(clean(rides_of(a_ride(surge_multiplier=None), a_ride(surge_multiplier=2.0)))).first()
    assert (row["avg_surge"], row["total_rides"]) == (2.0, 2)
