"""Streams against the batch result, replays, bad input, continuous operation."""

from __future__ import annotations

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kerbline.__main__ import main
from kerbline.operators.cleaning import clean
from kerbline.plans import gold
from kerbline.sources.landing import landing_path, read_landing, write_landing
from testbed.rides import rides_view
from kerbline.sources.snapshots import write_batch
from kerbline.sources.warehouse import Warehouse
from kerbline.streaming import counts, flows
from tests.conftest import SF_DIR, a_ride, bag

AS_OF = "2024-01-30 12:00:00"


@pytest.fixture
def warehouse(spark, base):
    return Warehouse(spark, base).create()


def land(warehouse, name: str, *lines) -> None:
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    Path(warehouse.landing, name).write_text("\n".join(texts))


def to_silver(warehouse, **options):
    flows.await_all([flows.start_bronze(warehouse)])
    silver = flows.start_silver(warehouse, **options)
    flows.await_all([silver])
    return silver


def test_two_drops_equal_the_batch_result_and_nothing_is_taken_twice(spark, warehouse):
    rides = rides_view(spark, SF_DIR)
    first = F.col("event_time") < "2024-01-15"
    write_landing(rides.filter(first), warehouse.landing)
    to_silver(warehouse)
    write_landing(rides.filter(~first), warehouse.landing)
    to_silver(warehouse)
    to_silver(warehouse)  # nothing new
    streamed = warehouse.read_silver().drop("_ingest_time")
    streamed = streamed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    expected = clean(rides).select(streamed.columns)
    assert streamed.exceptAll(expected).isEmpty() and expected.exceptAll(streamed).isEmpty()


def test_the_same_data_in_another_file_counts_again(warehouse):
    land(warehouse, "rides_20240302_091530_00001.jsonl", a_ride())
    to_silver(warehouse)
    land(warehouse, "rides_20240302_091535_00002.jsonl", a_ride())
    to_silver(warehouse)
    assert warehouse.read_silver().count() == 2


def test_bad_lines(spark, warehouse):
    wrong_types = {**a_ride(ride_id="T"), "final_fare": "2.5", "duration_mins": 3.7}
    land(
        warehouse,
        "edge.jsonl",
        a_ride(ride_id="G"),
        "this is no JSON",
        wrong_types,
        {**a_ride(ride_id="X"), "tip": 5},
    )
    to_silver(warehouse)
    bronze = {row.ride_id: row for row in warehouse.read_bronze().collect()}
    assert set(bronze) == {"G", None, "T", "X"}
    assert bronze[None]._rescued_data == "this is no JSON"
    assert bronze["T"].final_fare is None and bronze["T"].duration_mins is None
    assert json.loads(bronze["T"]._rescued_data) == wrong_types
    assert json.loads(bronze["X"]._rescued_data) == {"tip": "5"}
    assert {row[0] for row in warehouse.read_silver().select("ride_id").collect()} == {"G", "X"}
    assert read_landing(spark, warehouse.landing).count() == 4


def test_violations_are_counted_once_by_batch(spark, warehouse):
    land(warehouse, "a.jsonl", a_ride(), a_ride(final_fare=0.0, driver_rating=9.0))
    to_silver(warehouse)
    flows.await_all([flows.start_rule_counts(warehouse)])
    land(warehouse, "b.jsonl", a_ride(event_time="nope"))
    to_silver(warehouse)
    for _ in range(2):  # the second run has nothing left to count
        flows.await_all([flows.start_rule_counts(warehouse)])
    rows = spark.read.parquet(warehouse.quality).orderBy("batch_id").collect()
    assert [(r.rows_in, r.rows_dropped) for r in rows] == [(2, 1), (1, 0)]
    assert [(r.valid_fare, r.valid_rating, r.parsed_event_time) for r in rows] == [(1, 1, 0), (0, 0, 1)]


def counted(warehouse):
    rows = counts.read_counts(warehouse).orderBy("batch_id").collect()
    return [(r.rows_in, r.rows_dropped, r.valid_fare, r.parsed_event_time) for r in rows]


def test_counts_come_with_the_rides(spark, warehouse):
    """Bronze is read by one stream, and by it once."""
    land(warehouse, "a.jsonl", a_ride(), a_ride(final_fare=0.0, driver_rating=9.0))
    flows.run_once(warehouse, tables=["gold_rides_by_city"])
    land(warehouse, "b.jsonl", a_ride(event_time="nope"), a_ride(final_fare=None))
    listener = counts.RuleCounts(warehouse).attach()
    silver = to_silver(warehouse)
    assert listener.settle(silver)
    listener.detach()
    assert counted(warehouse) == [(2, 1, 1, 0), (2, 1, 1, 1)] and counts.missing(warehouse) == []
    plan = silver._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    assert [source.description for source in silver.lastProgress.sources] == [f"FileStreamSource[{warehouse.bronze}]".replace("[/", "[file:/")]
    mark = f"{warehouse.base}/quality"
    before = sorted(str(path) for path in Path(mark).glob("*/*.parquet"))
    flows.run_once(warehouse, tables=["gold_rides_by_city"])  # nothing new: nothing counted again
    assert sorted(str(path) for path in Path(mark).glob("*/*.parquet")) == before


def test_lost_reports_are_made_up_for(spark, warehouse):
    for number, fare in enumerate((100.0, 0.0, 50.0)):
        land(warehouse, f"{number}.jsonl", a_ride(final_fare=fare), a_ride(event_time="nope"))
        if number == 1:
            to_silver(warehouse)  # nobody listens
        else:
            flows.run_once(warehouse, tables=["gold_rides_by_city"])
    assert counts.missing(warehouse) == []
    assert counted(warehouse) == [(2, 0, 0, 1), (2, 1, 1, 1), (2, 0, 0, 1)]


def test_a_store_that_fails_does_not_stop_the_stream(spark, warehouse, monkeypatch):
    land(warehouse, "a.jsonl", a_ride(final_fare=0.0))
    with monkeypatch.context() as patch:
        patch.setattr(counts, "write_batch", lambda *args: 1 / 0)
        listener = counts.RuleCounts(warehouse).attach()
        assert listener.settle(to_silver(warehouse))
        listener.detach()
    assert counts.missing(warehouse) == [0]
    assert counts.mend(warehouse) == [0] and counts.mend(warehouse) == []
    assert counted(warehouse) == [(1, 1, 1, 0)]


def test_days_are_partitions_and_an_undated_ride_is_kept(warehouse):
    land(warehouse, "a.jsonl", a_ride(), a_ride(event_time="nope"))
    to_silver(warehouse)
    days = {path.name for path in Path(warehouse.silver).glob("event_date=*")}
    assert days == {"event_date=2024-03-02", "event_date=__HIVE_DEFAULT_PARTITION__"}


def test_gathering_days_bounds_the_files_of_a_backlog(warehouse):
    for number in range(20):
        land(warehouse, f"{number}.jsonl", *[a_ride(ride_id=f"{number}-{i}") for i in range(15)])
    flows.await_all([flows.start_bronze(warehouse)])
    flows.await_all([flows.start_silver(warehouse, gather_days=True)])
    assert len(list(Path(warehouse.silver).glob("event_date=*/*.parquet"))) == 1
    assert warehouse.read_silver().count() == 300


def test_limits_split_a_backlog_into_batches(warehouse):
    for number in range(6):
        land(warehouse, f"{number}.jsonl", a_ride(ride_id=str(number)))
    query = flows.start_bronze(warehouse, files_per_trigger=2)
    flows.await_all([query])
    assert sum(progress.numInputRows > 0 for progress in query.recentProgress) == 3
    assert warehouse.read_bronze().count() == 6


def test_a_replayed_batch_replaces_itself(spark, rides_of, base):
    for batch_id, rides in ((0, [a_ride()]), (1, [a_ride(), a_ride()]), (1, [a_ride(), a_ride()])):
        write_batch(clean(rides_of(*rides)), f"{base}/out", batch_id)
    assert spark.read.parquet(f"{base}/out").count() == 3


def test_cleaning_by_batch(spark, warehouse):
    land(warehouse, "a.jsonl", a_ride(), a_ride(final_fare=0.0))
    flows.await_all([flows.start_bronze(warehouse)])
    target = f"{warehouse.base}/by_batch"
    flows.await_all([flows.start_silver_by_batch(warehouse, target)])
    flows.await_all([flows.start_silver_by_batch(warehouse, target)])
    assert spark.read.parquet(target).count() == 1
    (row,) = spark.read.parquet(f"{warehouse.quality}_by_batch").collect()
    assert (row.rows_in, row.rows_dropped, row.valid_fare) == (2, 1, 1)


def test_a_failing_query_is_raised_and_the_others_stopped(spark, warehouse):
    land(warehouse, "a.jsonl", a_ride())
    flows.await_all([flows.start_bronze(warehouse)])

    def fail(batch, batch_id):
        raise RuntimeError("broken sink")

    stream = spark.readStream.schema("ride_id string").parquet(warehouse.bronze)
    broken = stream.writeStream.foreachBatch(fail).start()
    running = flows.start_bronze(warehouse, every="1 second")
    with pytest.raises(Exception, match="broken sink"):
        flows.await_all([running, broken])
    assert not running.isActive


def test_end_to_end(spark, warehouse):
    rides = rides_view(spark, SF_DIR)
    write_landing(rides, warehouse.landing)
    outcomes = flows.run_once(warehouse, as_of=AS_OF, gather_days=True)
    assert [outcome.table for outcome in outcomes] == list(gold.GOLD_TABLES)
    silver = clean(rides)
    for name, table in gold.GOLD_TABLES.items():
        stored = warehouse.store(table).read()
        expected = table.build(silver, AS_OF)
        columns = [c for c in expected.columns if c != "last_updated"]
        zoned = stored.select(
            *[F.col(c).cast(expected.schema[c].dataType).alias(c) for c in columns]
        )
        assert bag(zoned) == bag(expected, *columns), name
    again = flows.run_once(warehouse, as_of=AS_OF)
    assert {outcome.action for outcome in again} == {"skipped"}
    counts = spark.read.parquet(warehouse.quality).collect()
    assert [row.rows_in for row in counts] == [1000]


def test_empty_landing(warehouse):
    assert flows.run_once(warehouse, as_of=AS_OF) == []


def test_continuous_operation(warehouse):
    queries = flows.start_all(warehouse, every="1 second")
    try:
        store = warehouse.store(gold.STATUS_BREAKDOWN)
        for number in (1, 2):
            land(warehouse, f"{number}.jsonl", a_ride(ride_id=str(number)))
            deadline = time.time() + 90
            while time.time() < deadline:
                assert all(query.isActive for query in queries), [q.exception() for q in queries]
                if store.current() and store.read().agg(F.sum("ride_count")).first()[0] == number:
                    break
                time.sleep(1)
            else:
                pytest.fail(f"ride {number} did not reach the table")
    finally:
        for query in queries:
            query.stop()


def test_many_small_batches_are_merged_on_the_way(warehouse):
    for number in range(7):
        land(warehouse, f"{number}.jsonl", a_ride(ride_id=str(number)))
        to_silver(warehouse)
    options = {"refresh_tables": True, "files_per_trigger": 1, "most_parts": 3, "as_of": AS_OF}
    flows.await_all([flows.start_rollup(warehouse, gold.PLACE_HOURS, **options)])
    assert len(warehouse.rollup("place_hours").batch_ids()) <= 4
    assert len(warehouse.rollup("city_totals").batch_ids()) <= 4
    assert [row.total_rides for row in warehouse.read_gold("gold_rides_by_city").collect()] == [7]
    assert [row.total_rides for row in warehouse.read_gold("gold_pickup_demand").collect()] == [7]


def test_as_a_job(warehouse, capsys):
    land(warehouse, "a.jsonl", a_ride())
    words = ["--base", warehouse.base, "--tables", "gold_rides_by_city"]
    for action, said in (("once", "incremental"), ("refresh", "skipped")):
        main([action, *words])
        assert capsys.readouterr().out.split() == ["gold_rides_by_city", said]


@pytest.mark.parametrize(
    "words",
    [
        ["continuous", "--tables", "gold_live_kpis"],
        ["continuous", "--mode", "full"],
        ["once", "--mode", "partitions"],
        ["refresh", "--tables", "no_such_table"],
    ],
)
def test_options_that_would_be_ignored_or_refused_later_are_errors(warehouse, words):
    with pytest.raises(SystemExit):
        main([*words, "--base", warehouse.base])


def test_landing_path_setting(spark):
    with pytest.raises(ValueError):
        landing_path(spark)
    assert landing_path(spark, default="/d") == "/d"
    spark.conf.set("landing_volume_path", "/s")
    try:
        assert landing_path(spark, default="/d") == "/s"
        assert landing_path(spark, "/p") == "/p"
    finally:
        spark.conf.unset("landing_volume_path")
