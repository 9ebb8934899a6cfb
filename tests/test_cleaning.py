"""Rules one by one, bounds, nulls, times."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kerbline.functions.timeparts import is_peak
from kerbline.operators.cleaning import clean, enrich
from kerbline.operators.quality import RIDE_RULES, rule_counts
from tests.conftest import a_ride, bag

BREAKS = {
    "valid_ride_id": [{"ride_id": None}],
    "valid_fare": [{"final_fare": 0.0}, {"final_fare": -1.0}, {"final_fare": None}],
    "valid_distance": [{"distance_km": 0.49}, {"distance_km": 50.01}, {"distance_km": None}],
    "valid_rating": [{"driver_rating": 0.9}, {"driver_rating": 5.1}, {"driver_rating": None}],
    "valid_status": [{"status": "unknown"}, {"status": None}],
    "valid_vehicle": [{"vehicle_type": "Boat"}, {"vehicle_type": None}],
}
KEEPS = [
    {"distance_km": 0.5},
    {"distance_km": 50.0},
    {"driver_rating": 1.0},
    {"driver_rating": 5.0},
    {"final_fare": 0.01},
    {"status": "in_progress"},
    {"status": "no_driver_found", "cancellation_reason": ""},
    {"event_time": "nope"},
    {"event_time": None},
]


@pytest.mark.parametrize("rule", list(RIDE_RULES))
def test_each_rule_drops_and_is_counted_alone(rides_of, rule):
    rides = rides_of(a_ride(), *[a_ride(**change) for change in BREAKS[rule]])
    assert clean(rides).count() == 1
    counted = {row.rule: row.violations for row in rule_counts(rides).collect()}
    assert counted == {name: len(BREAKS[rule]) if name == rule else 0 for name in RIDE_RULES}


def test_bounds_are_inclusive_and_other_faults_do_not_drop(rides_of):
    rides = rides_of(*[a_ride(ride_id=f"K{i}", **change) for i, change in enumerate(KEEPS)])
    assert clean(rides).count() == len(KEEPS)


def test_a_row_breaking_several_rules_counts_under_each_and_drops_once(rides_of):
    rides = rides_of(a_ride(), a_ride(ride_id=None, final_fare=0.0, event_time="nope"))
    seen = Observation()
    clean(rides, observe=seen).write.format("noop").mode("overwrite").save()
    assert seen.get["rows_in"] == 2
    assert seen.get["valid_ride_id"] == seen.get["valid_fare"] == 1
    assert seen.get["rows_dropped"] == 1
    assert seen.get["parsed_event_time"] == 1  # watched only


def test_offset_moves_the_event_to_the_day_before(rides_of):
    (row,) = enrich(rides_of(a_ride(event_time="2025-01-01T01:30:00+05:30"))).collect()
    assert row.event_date == date(2024, 12, 31)
    assert (row.event_hour, row.event_minute) == (20, 0)


def test_unreadable_time_gives_nulls(rides_of):
    (row,) = enrich(rides_of(a_ride(event_time="nope"))).collect()
    assert row.event_time is None and row.event_date is None and row.is_weekend is None


def test_calendar(rides_of):
    rides = rides_of(
        a_ride(event_time="2024-03-02T00:00:00Z"),
        a_ride(event_time="2024-03-03T00:00:00Z"),
        a_ride(event_time="2024-03-04T00:00:00Z"),
    )
    found = bag(enrich(rides), "day_of_week", "is_weekend")
    assert found == [(1, True), (2, False), (7, True)]


def test_cancelled_flag(rides_of):
    statuses = ["completed", "cancelled_by_user", "cancelled_by_driver", "no_driver_found", None]
    rides = rides_of(*[a_ride(status=status) for status in statuses])
    found = dict(enrich(rides).select("status", "is_cancelled").collect())
    assert found == {
        "completed": False,
        "cancelled_by_user": True,
        "cancelled_by_driver": True,
        "no_driver_found": True,
        None: None,
    }


def test_rescue_column_is_dropped(rides_of):
    with_rescue = rides_of(a_ride()).withColumn("_rescued_data", F.lit(None).cast("string"))
    assert "_rescued_data" not in enrich(with_rescue).columns


def test_peak_hours_in_another_zone(spark):
    times = [datetime(2024, 1, 1, h, m) for h, m in ((2, 29), (2, 30), (4, 29), (4, 30), (12, 30))]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp")
    flags = [row[0] for row in frame.select(is_peak(F.col("t"), "Asia/Kolkata")).collect()]
    assert flags == [False, True, True, False, True]


def test_peak_hour_edges(spark):
    hours = spark.range(24).select(
        "id", is_peak(F.make_timestamp_ntz(*map(F.lit, (2024, 1, 1)), "id", F.lit(0), F.lit(0)))
    )
    assert [row[0] for row in hours.collect() if row[1]] == [8, 9, 18, 19, 20]


def test_rules_reach_the_reader_and_no_python_runs(spark, rides_of, base):
    rides_of(a_ride()).write.parquet(f"{base}/bronze")
    plan = clean(spark.read.parquet(f"{base}/bronze"))._jdf.queryExecution().toString()
    assert "GreaterThan(final_fare,0.0)" in plan
    assert "GreaterThanOrEqual(distance_km,0.5)" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
