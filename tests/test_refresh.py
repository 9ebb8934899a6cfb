"""Refresh modes against the full recompute, skipping, versions, recovery."""

from __future__ import annotations

import shutil
from datetime import date
from pathlib import Path

import pyarrow.parquet as parquet
import pytest
from pyspark.sql import functions as F

from kerbline.operators.cleaning import clean
from kerbline.plans import dashboard, gold
from kerbline.plans.refresh import changed_days, compact, refresh
from kerbline.plans.views import VIEWS
from kerbline.sources.scratch import scratch_root
from testbed.rides import rides_view
from kerbline.sources.snapshots import StoredTable, append, on_days
from kerbline.sources.warehouse import Warehouse
from tests.conftest import SF_DIR, a_ride, bag, plan_of

AS_OF = "2024-01-30 12:00:00"


def load(warehouse, silver, batch_id):
    append(silver, warehouse.silver, "event_date")
    for rollup in gold.ROOTS:
        warehouse.add_rides(rollup, silver, batch_id)


@pytest.fixture(scope="module")
def parts(spark):
    """Three loads: most rides, late rides on a few days, rides on one new day."""
    rides = clean(rides_view(spark, SF_DIR))
    times = ("event_time", "_ingest_time")
    rides = rides.withColumns({name: F.col(name).cast("timestamp") for name in times})
    late = F.col("event_date").isin("2024-01-05", "2024-01-09") & (F.col("event_hour") >= 12)
    last = F.col("event_date") == "2024-01-30"
    loads = (~late & ~last, late, last)
    return [rides.filter(load).persist() for load in loads]


@pytest.mark.parametrize("mode", ["full", "partitions", "incremental"])
def test_each_mode_equals_a_full_build(spark, base, parts, mode):
    warehouse = Warehouse(spark, base).create()
    names = [name for name, table in gold.GOLD_TABLES.items() if mode in table.modes]
    for batch_id, part in enumerate(parts):
        load(warehouse, part, batch_id)
        outcomes = refresh(warehouse, names, mode, AS_OF)
        assert [outcome.action for outcome in outcomes] == [mode] * len(names)
        for name in names:
            table = gold.GOLD_TABLES[name]
            expected = table.build(warehouse.read_silver(), AS_OF)
            assert bag(warehouse.store(table).read()) == bag(expected), (name, batch_id)


@pytest.mark.parametrize(
    "at",
    ["2024-01-30 12:00:00", "2024-01-30 12:00:30", "2024-01-30 12:59:59.999", "2024-01-30 00:20:00.001", "2024-03-01 00:00:00"],
)
def test_a_sliding_window_equals_a_full_build(spark, base, parts, at):
    warehouse = Warehouse(spark, base).create()
    table = gold.REVENUE_PER_MINUTE
    for batch_id, part in enumerate(parts):
        load(warehouse, part, batch_id)
    (outcome,) = refresh(warehouse, [table.name], as_of=at)
    assert outcome.action == "incremental"
    stored = warehouse.store(table).read()
    assert bag(stored) == bag(table.build(warehouse.read_silver(), at))


def test_a_sliding_window_opens_one_minute_of_silver(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    load(warehouse, parts[0], 0)
    table = gold.REVENUE_PER_MINUTE
    parts_of = warehouse.rollup(gold.MINUTES.name).read()
    plan = plan_of(table.from_rollup(parts_of, "2024-01-20 12:00:30", warehouse.read_silver()))
    (silver,) = [line for line in plan.splitlines() if "FileScan" in line and base + "/silver" in line]
    assert "PartitionFilters: [isnotnull(event_date" in silver and "= 2024-01-20" in silver
    assert "LessThan(event_time,2024-01-20" in silver and "final_fare" in silver and "city" not in silver


def test_inexact_modes_are_refused(spark, base):
    warehouse = Warehouse(spark, base)
    for name, mode in (
        ("gold_rides_by_city", "partitions"),
        ("gold_revenue_per_minute", "partitions"),
        ("gold_top_zones", "partitions"),
    ):
        with pytest.raises(ValueError, match="not exact"):
            refresh(warehouse, [name], mode, AS_OF)


def test_only_changed_days_are_rewritten(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    name = "gold_pickup_demand"
    load(warehouse, parts[0], 0)
    refresh(warehouse, [name])

    def files():
        path = warehouse.store(gold.GOLD_TABLES[name]).current_path()
        return {day.name: sorted(f.name for f in day.iterdir()) for day in Path(path).glob("event_date=*")}

    before = files()
    load(warehouse, parts[1], 1)
    (outcome,) = refresh(warehouse, [name], "partitions")
    changed = {day for day, file in files().items() if before.get(day) != file}
    assert changed == {f"event_date={day}" for day in outcome.days}
    assert changed == {"event_date=2024-01-05", "event_date=2024-01-09"}


def test_skip_and_clock(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    load(warehouse, parts[0], 0)

    def actions(as_of):
        names = ["gold_top_zones", "gold_live_kpis"]
        return [outcome.action for outcome in refresh(warehouse, names, as_of=as_of)]

    assert actions("2024-01-20") == ["incremental", "incremental"]
    assert actions("2024-01-20") == ["skipped", "skipped"]
    assert actions("2024-01-21") == ["incremental", "skipped"]  # the clock moved
    assert actions(None) == ["incremental", "skipped"]  # the wall clock always moves
    assert actions(None) == ["incremental", "skipped"]


def test_without_a_log_nothing_is_skipped(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    names = ["gold_rides_by_city"]
    for part in parts[1:]:
        append(part, warehouse.silver, "event_date")
        assert refresh(warehouse, names, "full")[0].action == "full"
    expected = gold.RIDES_BY_CITY.build(warehouse.read_silver())
    assert bag(warehouse.store(gold.RIDES_BY_CITY).read()) == bag(expected)


def test_a_refresh_that_died_before_its_note_is_repeated(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    table = gold.HOURLY_DEMAND
    load(warehouse, parts[0], 0)
    refresh(warehouse, [table.name])
    note = warehouse.store(table).applied()
    load(warehouse, parts[1], 1)
    refresh(warehouse, [table.name])
    warehouse.store(table).note_applied(note)  # as if it had died here
    (outcome,) = refresh(warehouse, [table.name])
    assert outcome.action == "incremental"
    expected = table.build(warehouse.read_silver())
    assert bag(warehouse.store(table).read()) == bag(expected)


def test_a_replayed_batch_does_not_count_twice(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    for batch_id, part in ((0, parts[0]), (1, parts[1]), (1, parts[1])):
        for rollup in gold.ROOTS:
            warehouse.add_rides(rollup, part, batch_id)
    cities = warehouse.rollup("city_totals").read().agg(F.sum("rides")).first()[0]
    assert cities == parts[0].count() + parts[1].count()
    total = warehouse.rollup("driver_days").read().agg(F.sum("rides")).first()[0]
    assert total == parts[0].count() + parts[1].count()


def test_compaction_keeps_results_changes_and_the_newest_batch(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    names = ["gold_pickup_demand", "gold_driver_leaderboard", "gold_rides_by_city", "gold_revenue_per_minute"]
    load(warehouse, parts[0], 0)
    load(warehouse, parts[1], 1)
    refresh(warehouse, names)
    load(warehouse, parts[2], 2)
    for rollup in gold.ROLLUPS.values():
        compact(warehouse, rollup)
        assert warehouse.rollup(rollup.name).batch_ids() == [-1, 2]
    merged = Path(warehouse.rollup("place_hours")._table.current_path(), "_batch_id=-1")
    for file in merged.glob("*.parquet"):
        days = parquet.read_table(file).column("event_date").to_pylist()
        assert days and days == sorted(days)
    for rollup in gold.ROOTS:  # the newest batch is replayed
        warehouse.add_rides(rollup, parts[2], 2)
    days = [outcome.days for outcome in refresh(warehouse, names)]
    assert days == [(date(2024, 1, 30),), (date(2024, 1, 30),), None, None]
    for name in names:
        table = gold.GOLD_TABLES[name]
        expected = table.build(warehouse.read_silver())
        assert bag(warehouse.store(table).read()) == bag(expected)


def test_compaction_keeps_batches_a_table_has_not_seen(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    load(warehouse, parts[0], 0)
    refresh(warehouse, ["gold_pickup_demand"])
    load(warehouse, parts[1], 1)
    load(warehouse, parts[2], 2)
    compact(warehouse, gold.PLACE_HOURS)
    assert warehouse.rollup("place_hours").batch_ids() == [-1, 1, 2]


def test_changed_days_have_no_cap(spark):
    days = spark.range(6000).selectExpr("date_add(date'2004-01-01', cast(id as int)) as event_date")
    assert len(changed_days(days.unionAll(days))) == 6000


def test_a_lagging_table_causes_one_rewrite_not_one_a_batch(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    load(warehouse, parts[0], 0)
    load(warehouse, parts[1], 1)
    refresh(warehouse, ["gold_live_kpis"])
    versions = []
    for batch_id in range(2, 6):
        load(warehouse, parts[2].limit(5), batch_id)
        refresh(warehouse, ["gold_driver_leaderboard"])
        compact(warehouse, gold.DRIVER_DAYS)
        versions.append(warehouse.rollup("driver_days")._table.current())
    assert len(set(versions)) == 1
    assert warehouse.rollup("driver_days").batch_ids() == [-1, 2, 3, 4, 5]


def test_old_versions_go_and_days_are_kept_once(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    names = ["gold_pickup_demand", "gold_rides_by_city"]
    load(warehouse, parts[0], 0)
    refresh(warehouse, names)
    for batch_id in range(1, 4):
        load(warehouse, parts[1].limit(20 * batch_id), batch_id)
        refresh(warehouse, names, keep=2)
    by_day, whole = (warehouse.store(gold.GOLD_TABLES[name]) for name in names)
    assert by_day.versions() == [1] and whole.versions() == [3, 4]
    for name, store in zip(names, (by_day, whole), strict=True):
        assert bag(store.read()) == bag(gold.GOLD_TABLES[name].build(warehouse.read_silver()))


def test_an_overwrite_of_days_that_died_is_run_again(spark, base, parts):
    """Days are computed from rides, never from the table, so a lost one is simply written again."""
    warehouse = Warehouse(spark, base).create()
    name = "gold_pickup_demand"
    store = warehouse.store(gold.GOLD_TABLES[name])
    load(warehouse, parts[0], 0)
    refresh(warehouse, [name])
    noted = store.applied()
    load(warehouse, parts[1], 1)
    refresh(warehouse, [name], "partitions")
    expected = bag(store.read())
    shutil.rmtree(Path(store.current_path(), "event_date=2024-01-05"))  # taken away, not put back yet
    store.note_applied(noted)
    (outcome,) = refresh(warehouse, [name], "partitions")
    assert outcome.days and bag(store.read()) == expected


def test_refreshes_leave_no_scratch_folders(spark, base, parts):
    root = Path(scratch_root(spark).removeprefix("file://"))
    warehouse = Warehouse(spark, base).create()
    load(warehouse, parts[0], 0)
    before = len(list(root.glob("kerbline-*")))
    for number in range(1, 4):
        load(warehouse, parts[1].limit(5), number)
        refresh(warehouse, ["gold_live_kpis", "gold_driver_leaderboard"], "full")
    assert len(list(root.glob("kerbline-*"))) == before


def test_sums_do_not_depend_on_how_a_table_was_refreshed(spark, base, parts):
    """Fares of two decimals, whose sums as doubles depend on the order of addition."""
    names = ["gold_live_kpis", "gold_pickup_demand"]
    for batch_id, part in enumerate(parts):
        for mode in ("full", "partitions", "incremental"):
            warehouse = Warehouse(spark, f"{base}/{mode}").create()
            load(warehouse, part.repartition(3 + batch_id), batch_id)
            refresh(warehouse, names, mode)
    for name in names:
        tables = [
            bag(Warehouse(spark, f"{base}/{mode}").read_gold(name).drop("last_updated"))
            for mode in ("full", "partitions", "incremental")
        ]
        assert tables[0] == tables[1] == tables[2]


def test_a_view_is_defined_queried_and_refreshed(spark, base):
    view = VIEWS["revenue_by_category"]
    warehouse = Warehouse(spark, base).create()

    def add(batch_id, *rows):
        frame = spark.createDataFrame(rows, "category string, amount int, status string")
        view.add_rows(spark, base, frame, batch_id)

    def refreshed(mode=None):
        (outcome,) = refresh(warehouse, [view.name], mode)
        return outcome.action, bag(view.read(spark, base), "category", "total_orders", "total_revenue")

    with pytest.raises(LookupError):
        refreshed()
    add(0, ("Books", 10, "delivered"), ("Toys", 5, "delivered"), ("Toys", 7, "cancelled"))
    assert refreshed("full") == ("full", [("Books", 1, 10), ("Toys", 1, 5)])
    assert refreshed("full")[0] == "skipped"
    add(1, ("Books", 3, "delivered"), ("Food", 1, "delivered"))
    assert bag(view.read(spark, base), "category") == [("Books",), ("Toys",)]  # stored, not live
    expected = [("Books", 2, 13), ("Food", 1, 1), ("Toys", 1, 5)]
    assert refreshed("incremental") == ("incremental", expected)
    assert refreshed() == ("skipped", expected)
    # Died after the state was stored, before the rows were: nothing counts twice.
    add(2, ("Food", 4, "delivered"))
    state = view._state(spark, base)
    fresh = view.state(view.counted(spark.createDataFrame([("Food", 4, "delivered")], "category string, amount int, status string")))
    state.replace(view.add(state.read(), fresh), note={"source": 2})
    assert refreshed("incremental")[1] == [("Books", 2, 13), ("Food", 2, 5), ("Toys", 1, 5)]
    with pytest.raises(ValueError, match="not exact"):
        refresh(warehouse, [view.name], "partitions")


def test_days_that_emptied_are_removed(spark, base):
    store = StoredTable(spark, f"{base}/t", "event_date")
    rows = "select * from values (date'2024-01-01', 1), (date'2024-01-02', 2), (null, 3) as t(event_date, n)"
    table = spark.sql(rows)
    store.replace(table)
    days = [row[0] for row in table.select("event_date").collect()]
    fresh = spark.sql("select date'2024-01-01' as event_date, 9 as n")
    store.overwrite_days(fresh, days)
    assert bag(store.read(), "n") == [(9,)]
    store.overwrite_days(fresh.limit(0), days)
    assert bag(store.read()) == []
    assert store.read().dtypes == [("event_date", "date"), ("n", "int")]


def test_half_written_versions_are_not_read(spark, base):
    store = StoredTable(spark, f"{base}/t")
    store.replace(spark.range(3))
    Path(base, "t", "v=2").mkdir()
    assert store.current() == 1
    store.replace(store.read().filter("id > 0"))
    assert store.versions() == [1, 3] and store.read().count() == 2
    store.replace(spark.range(1))
    store.drop_old(keep=2)
    assert store.versions() == [3, 4]


def test_undated_rides_get_their_own_partition(spark, base, rides_of):
    warehouse = Warehouse(spark, base).create()
    name = "gold_ride_status_breakdown"
    undated = a_ride(event_time="nope")
    load(warehouse, clean(rides_of(a_ride(), undated)), 0)
    refresh(warehouse, [name])
    load(warehouse, clean(rides_of(undated)), 1)
    (outcome,) = refresh(warehouse, [name], "partitions")
    assert outcome.days == (None,)
    assert sorted(row.ride_count for row in warehouse.read_gold(name).collect()) == [1, 2]


def test_sql_over_views_and_database(spark, base, parts):
    warehouse = Warehouse(spark, base).create()
    load(warehouse, parts[0], 0)
    refresh(warehouse, as_of="2024-01-20 12:00:00")
    offered = warehouse.offer_views()
    assert {*gold.GOLD_TABLES, *dashboard.DATASETS} < set(offered)
    rides = warehouse.read_silver().count()
    assert spark.sql("select sum(total_rides) from ds_pickup").first()[0] == rides
    zones = spark.sql("select count(*) from gold_top_zones").first()[0]
    assert spark.sql("select count(*) from ds_zones").first()[0] == zones > 0
    total = spark.sql("select sum(total_rides) from gold_rides_by_city").first()[0]
    assert total == spark.sql("select count(*) from silver_ride_events").first()[0]
    names = warehouse.offer_database("ride_reports")
    assert len(names) == len(gold.GOLD_TABLES) + 1  # bronze is empty here
    assert spark.sql("select count(*) from ride_reports.silver_ride_events").first()[0] == total
    assert spark.sql("select sum(total_rides) from ride_reports.gold_rides_by_city").first()[0] == total
    assert spark.sql("select sum(total_rides) from ride_reports.gold_live_kpis").first()[0] == total
    described = {
        row.col_name: row.data_type
        for row in spark.sql("describe table extended ride_reports.gold_live_kpis").collect()
    }
    assert described["Comment"] == gold.LIVE_KPIS.comment
    assert "quality=gold" in described["Table Properties"]
    assert warehouse.offer_database("ride_reports") == names


def test_on_days_is_pruned(spark, base):
    table = spark.sql("select date'2024-01-01' as event_date, 1 as n")
    table.write.partitionBy("event_date").parquet(f"{base}/t")
    frame = spark.read.parquet(f"{base}/t")
    (day,) = [row[0] for row in frame.select("event_date").collect()]
    plan = frame.filter(on_days([day, None]))._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "PartitionFilters: [(" in plan


def test_another_time_zone_is_refused(spark, base):
    Warehouse(spark, base).create().create()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="time zone"):
            Warehouse(spark, base).create()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
