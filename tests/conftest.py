from __future__ import annotations

import tempfile
from datetime import datetime

import pytest

from kerbline import build_session
from kerbline.schema import RIDE_FIELDS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="kerbline-tests-")
    session = build_session(
        "tests",
        "local[8]",
        shuffle_partitions=8,
        **{
            "spark.checkpoint.dir": scratch,
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


def a_ride(**changes) -> dict:
    """A ride that meets every rule; keyword arguments change fields."""
    ride = {
        "ride_id": "RD-1",
        "event_time": "2024-03-02T09:15:30+00:00",
        "status": "completed",
        "city": "Delhi",
        "pickup_area": "Saket",
        "drop_area": "Dwarka",
        "vehicle_type": "Mini",
        "driver_id": "DRV-1",
        "driver_name": "A",
        "driver_rating": 4.5,
        "rider_id": "USR-1",
        "distance_km": 10.0,
        "duration_mins": 30,
        "base_fare": 180.0,
        "surge_multiplier": 1.0,
        "final_fare": 180.0,
        "payment_method": "UPI",
        "cancellation_reason": None,
        "zone_id": "DEL-Z1",
        "is_peak_hour": True,
    }
    assert list(ride) == list(RIDE_FIELDS)
    unknown = set(changes) - set(ride)
    assert not unknown, unknown
    return {**ride, **changes}


@pytest.fixture
def rides_of(spark):
    """Rides as a bronze table (text times, a fixed ingest time)."""
    from pyspark.sql import functions as F

    from kerbline.schema import RIDE_SCHEMA

    def make(*rides: dict):
        rows = [tuple(ride.values()) for ride in rides]
        frame = spark.createDataFrame(rows, RIDE_SCHEMA)
        return frame.withColumn("_ingest_time", F.lit(datetime(2024, 3, 2, 10)))

    return make


def bag(frame, *columns):
    """Rows as a sorted list, for comparison without regard to order."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
