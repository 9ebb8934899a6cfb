"""Distinct counts from sketches: error bound, ranges, parts."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from kerbline.plans import sketches


@pytest.fixture(scope="module")
def rides(spark):
    """30 days; on each, drivers of a window that moves on, some many times, and rides without driver."""
    frame = spark.range(60_000).select(
        F.expr("date_add(DATE'2024-01-01', CAST(id % 30 AS INT))").alias("event_date"),
        F.when(F.col("id") % 17 != 0, (F.col("id") % 30) * 400 + F.pmod(F.hash("id"), F.lit(1500))).alias("driver_id"),
    )
    return frame.persist()


@pytest.mark.parametrize("span", [("2024-01-01", "2024-01-30"), ("2024-01-05", "2024-01-05"), ("2024-01-29", None), (None, None)])
def test_any_range_is_within_the_error(rides, span):
    first, last = span
    found = sketches.active_between(sketches.sketch_days(rides), first, last).first()
    chosen = rides.filter(F.col("event_date").between(first or "2000-01-01", last or "2100-01-01"))
    exact = chosen.select("driver_id").distinct().filter("driver_id IS NOT NULL").count()
    assert abs(found["active_drivers"] - exact) <= 4 * sketches.standard_error() * exact
    assert found["rides"] == chosen.count() and found["days"] == chosen.select("event_date").distinct().count()


def test_the_error_falls_with_the_registers(rides):
    exact = rides.select("driver_id").distinct().count() - 1
    for log2 in (8, 12, 16):
        found = sketches.active_between(sketches.sketch_days(rides, log2_buckets=log2)).first()["active_drivers"]
        assert abs(found - exact) <= 4 * sketches.standard_error(log2) * exact


def test_parts_in_any_order_are_within_the_error(rides):
    halves = [sketches.sketch_days(rides.filter(F.pmod(F.hash("driver_id"), F.lit(2)) == i)) for i in (0, 1)]
    estimate = F.hll_sketch_estimate("sketch")

    def shown(days):
        return sorted(days.select("event_date", "rides", estimate).collect())

    exact = {r[0]: r[1:] for r in shown(rides.groupBy("event_date").agg(F.count("*").alias("rides"), F.hll_sketch_agg("driver_id", F.lit(14)).alias("sketch")))}
    for first, second in (halves, halves[::-1]):
        for day, many, found in shown(sketches.merged(first.unionByName(second))):
            assert many == exact[day][0] and abs(found - exact[day][1]) <= 8 * sketches.standard_error() * found


def test_last_days(rides):
    days = sketches.sketch_days(rides)
    found = {r["event_date"]: r for r in sketches.active_last_days(days, 7).collect()}
    assert len(found) == 30 and found[date(2024, 1, 3)]["days"] == 3 and found[date(2024, 1, 20)]["days"] == 7
    week = rides.filter(F.col("event_date").between("2024-01-14", "2024-01-20"))
    exact = week.agg(F.count_distinct("driver_id")).first()[0]
    assert abs(found[date(2024, 1, 20)]["active_drivers"] - exact) <= 4 * sketches.standard_error() * exact


def test_nothing_and_nulls(rides):
    none = sketches.sketch_days(rides.limit(0))
    assert tuple(sketches.active_between(none).first()) == (0, 0, 0)
    nameless = sketches.sketch_days(rides.withColumn("driver_id", F.lit(None).cast("long")))
    assert sketches.active_between(nameless).first()["active_drivers"] == 0


def test_only_sketches_are_shuffled(rides):
    plan = sketches.sketch_days(rides)._jdf.queryExecution().executedPlan().toString()
    exchange = plan[: plan.index("Exchange")]
    assert "partial_" not in exchange and plan.count("Exchange") == 1 and "partial_hll_sketch_agg" in plan
