"""Hot keys: the plans that keep one key from filling one task, shown on small data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kerbline.operators.cleaning import clean
from kerbline.plans import gold
from testbed.rides import rides_view
from tests.conftest import SF_DIR, bag, plan_of

ALWAYS_SHUFFLE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def settings(spark):
    """Sets options for one test."""
    before = {}

    def apply(options):
        for key, value in options.items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield apply
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def hot_user(spark, tmp_path_factory):
    """The test tables with 40 times the events, half of them owned by one user."""
    folder = str(tmp_path_factory.mktemp("hot"))
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    copies = spark.range(40).withColumnRenamed("id", "copy")
    many = events.join(copies).withColumns(
        {
            "event_id": F.col("event_id") + F.col("copy") * 1000,
            "user_id": F.when(F.col("copy") % 2 == 0, 7).otherwise(F.col("user_id")).cast("bigint"),
        }
    )
    many.drop("copy").repartition(8).write.parquet(f"{folder}/events.parquet")
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_a_hot_user_is_split(spark, hot_user, settings):
    expected = bag(gold.RIDES_BY_CITY.build(clean(rides_view(spark, hot_user))))
    settings(ALWAYS_SHUFFLE)
    table = gold.RIDES_BY_CITY.build(clean(rides_view(spark, hot_user)))
    assert bag(table) == expected
    assert "SortMergeJoin(skew=true)" in plan_of(table)


def test_customers_are_not_broadcast_beyond_the_limit(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "1KB"})
    plan = plan_of(rides_view(spark, SF_DIR))
    assert "SortMergeJoin [u" in plan


def test_keys_are_combined_before_the_shuffle(spark):
    silver = clean(rides_view(spark, SF_DIR))
    for table in gold.GOLD_TABLES.values():
        if table.distinct or table.name == "gold_driver_leaderboard":
            continue
        plan = plan_of(table.build(silver, "2024-01-30 12:00:00"))
        assert plan.count("partial_sum") >= 1, table.name
        assert plan.count("Exchange hashpartitioning") == 1, table.name


def test_distinct_drivers_are_counted_in_two_levels(spark):
    plan = plan_of(gold.LIVE_KPIS.build(clean(rides_view(spark, SF_DIR))))
    first, second = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "driver_id" not in first and "driver_id" in second
