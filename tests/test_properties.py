"""Random inputs against plain Python."""

from __future__ import annotations

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kerbline.operators.cleaning import clean
from kerbline.operators.ranking import rank_within
from kerbline.operators.upsert import upsert
from kerbline.plans import gold
from kerbline.schema import COMPLETED, STATUSES, VEHICLES
from tests.conftest import a_ride, bag

FEW = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

values = st.one_of(
    st.none(),
    st.integers(-500_000, 5_000_000).map(lambda cents: cents / 100),
    st.sampled_from([0.0, 999.99, 1000.0, 1000.01, 2000.0]),
)


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), values), max_size=60))
def test_rank(spark, rows):
    frame = spark.createDataFrame(rows, "g string, v double")
    found = bag(rank_within(frame, "g", "v"), "g", "v", "rank")
    groups = defaultdict(list)
    for group, value in rows:
        groups[group].append(float("-inf") if value is None else value)
    expected = [
        (g, v, 1 + sum(x > (float("-inf") if v is None else v) for x in groups[g])) for g, v in rows
    ]
    assert found == sorted(expected, key=repr)


tables = st.dictionaries(st.integers(0, 12), st.integers(0, 99))


@FEW
@given(tables, tables)
def test_upsert(spark, target, source):
    def frame(rows):
        return spark.createDataFrame(list(rows.items()), "k int, n int")

    assert dict(bag(upsert(frame(target), frame(source), ["k"]))) == {**target, **source}


rides = st.builds(
    a_ride,
    event_time=st.sampled_from(["2024-03-01T23:59:59Z", "2024-03-02T08:00:00Z", "nope"]),
    status=st.sampled_from([*STATUSES, "unknown"]),
    vehicle_type=st.sampled_from([*VEHICLES, "Boat"]),
    city=st.sampled_from(["Delhi", "Mumbai"]),
    driver_id=st.sampled_from(["D1", "D2", None]),
    final_fare=st.sampled_from([None, 0.0, 80.25, 120.5]),
    cancellation_reason=st.sampled_from([None, "", "Too far"]),
)


@FEW
@given(st.lists(rides, min_size=1, max_size=40), st.lists(st.booleans(), min_size=40, max_size=40))
def test_tables_do_not_depend_on_how_rides_were_split(spark, rides_of, events, late):
    silver = clean(rides_of(*events))
    batches = [
        clean(rides_of(*chosen))
        for side in (False, True)
        if (chosen := [event for event, flag in zip(events, late) if flag is side])
    ]
    for table in (gold.LIVE_KPIS, gold.RIDES_BY_CITY, gold.CANCELLATION_ANALYSIS):
        parts = table.rollup.of(batches[0])
        for batch in batches[1:]:
            parts = parts.unionByName(table.rollup.of(batch))
        assert bag(table.from_rollup(parts)) == bag(table.build(silver))


@FEW
@given(st.lists(rides, min_size=1, max_size=40))
def test_cities_against_plain_python(rides_of, events):
    kept = [
        e
        for e in events
        if e["status"] in STATUSES and e["vehicle_type"] in VEHICLES and (e["final_fare"] or 0) > 0
    ]
    expected = {}
    for city in {e["city"] for e in kept}:
        mine = [e for e in kept if e["city"] == city]
        fares = [e["final_fare"] for e in mine if e["status"] == COMPLETED]
        expected[city] = (len(mine), len(fares), sum(fares), sum(fares) / len(fares) if fares else None)
    found = gold.RIDES_BY_CITY.build(clean(rides_of(*events)))
    for city, rides_, done, revenue, mean in found.collect():
        assert (rides_, done, revenue) == expected[city][:3]
        assert mean is None if expected[city][3] is None else mean == pytest.approx(expected[city][3], abs=0.01)
    assert found.count() == len(expected)
