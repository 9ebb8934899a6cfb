"""Column names, types and accepted values of a ride event."""

from __future__ import annotations

from pyspark.sql import types as T

# The 20 fields of a landed event, in file order.  Never inferred.
RIDE_SCHEMA = (
    T.StructType()
    .add("ride_id", "string")
    .add("event_time", "string")
    .add("status", "string")
    .add("city", "string")
    .add("pickup_area", "string")
    .add("drop_area", "string")
    .add("vehicle_type", "string")
    .add("driver_id", "string")
    .add("driver_name", "string")
    .add("driver_rating", "double")
    .add("rider_id", "string")
    .add("distance_km", "double")
    .add("duration_mins", "integer")
    .add("base_fare", "double")
    .add("surge_multiplier", "double")
    .add("final_fare", "double")
    .add("payment_method", "string")
    .add("cancellation_reason", "string")
    .add("zone_id", "string")
    .add("is_peak_hour", "boolean")
)
RIDE_FIELDS = RIDE_SCHEMA.fieldNames()

INGEST_TIME = "_ingest_time"
RESCUED = "_rescued_data"

# Ride statuses and vehicle types.
COMPLETED = "completed"
CANCELLED_STATUSES = ("cancelled_by_user", "cancelled_by_driver", "no_driver_found")
STATUSES = (COMPLETED, *CANCELLED_STATUSES, "in_progress")
VEHICLES = ("Bike", "Auto", "Mini", "Sedan", "SUV")
