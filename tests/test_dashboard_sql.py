"""The dashboard's SQL texts and table functions against its DataFrame forms."""

from __future__ import annotations

import pytest

from kerbline.operators.cleaning import clean
from kerbline.plans import dashboard, dashboard_sql, gold
from testbed.rides import rides_view
from tests.conftest import SF_DIR, bag

AS_OF = "2024-01-30 12:00:00"
PREFIX = "sql_test_"


@pytest.fixture(scope="module")
def frames(spark):
    silver = clean(rides_view(spark, SF_DIR)).persist()
    made = {name: table.build(silver, AS_OF).persist() for name, table in gold.GOLD_TABLES.items()}
    for name, frame in made.items():
        frame.createOrReplaceTempView(f"{PREFIX}{name}")
    return made


def test_there_is_a_text_for_every_dataset():
    assert dashboard_sql.DATASETS.keys() == dashboard.DATASETS.keys()


@pytest.mark.parametrize("name", dashboard_sql.DATASETS)
def test_texts_give_the_same_rows_in_the_same_order(spark, frames, name):
    found = dashboard_sql.dataset(spark, name, prefix=PREFIX)
    expected = dashboard.datasets(frames)[name]
    assert found.dtypes == expected.dtypes and expected.count() > 0
    if dashboard_sql.DATASETS[name].order:
        assert found.collect() == expected.collect()
    else:
        assert bag(found) == bag(expected)


def test_the_clock_and_the_length_are_parameters(spark, frames):
    kpis = dashboard.kpis(frames["gold_live_kpis"], frames["gold_ride_status_breakdown"], AS_OF)
    assert bag(dashboard_sql.dataset(spark, "ds_kpis", AS_OF, PREFIX)) == bag(kpis) and kpis.count() == 1
    assert dashboard_sql.dataset(spark, "ds_kpis", "1999-01-01", PREFIX).count() == 0
    zones = dashboard.zones(frames["gold_top_zones"], 3)
    assert dashboard_sql.dataset(spark, "ds_zones", prefix=PREFIX, k=3).collect() == zones.collect()


def test_quotes_in_parameters_are_text(spark, frames):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        dashboard_sql.dataset(spark, "ds_kpis", "x' OR '1' = '1", PREFIX).collect()


def test_table_functions(spark, frames):
    assert dashboard_sql.offer_functions(spark, PREFIX) == list(dashboard.DATASETS)
    for name, frame in dashboard.datasets(frames).items():
        assert bag(spark.sql(f"SELECT * FROM {name}()")) == bag(frame)
    assert spark.sql(f"SELECT * FROM ds_kpis('{AS_OF}')").count() == 1
    assert bag(spark.sql("SELECT * FROM ds_zones(k => 2)")) == bag(dashboard.zones(frames["gold_top_zones"], 2))


def test_a_database_as_prefix(spark, frames):
    spark.sql("CREATE DATABASE IF NOT EXISTS sql_test_db")
    frames["gold_rides_by_city"].write.saveAsTable("sql_test_db.gold_rides_by_city", mode="overwrite")
    found = dashboard_sql.dataset(spark, "ds_cities", prefix="sql_test_db.")
    assert found.collect() == dashboard.cities(frames["gold_rides_by_city"]).collect()
    spark.sql("DROP DATABASE sql_test_db CASCADE")
