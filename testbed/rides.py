"""A rides table over the star-schema test tables: one ride per ``events`` row.

The fare, distance and duration come from the event's value, the status from its type and the number
in its properties, the vehicle from the customer's segment, city and area from region and nation.
Values outside the accepted ranges occur by themselves or for single numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a ride as Spark SQL; k is the number in the event's properties, u the user.
_RIDE = {
    "ride_id": "if(k = 42, NULL, concat('E-', event_id))",
    "event_time": "ts",
    "status": """CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN 'completed'
        WHEN 'click' THEN if(k < 90, 'completed', 'in_progress')
        WHEN 'signup' THEN if(k < 50, 'cancelled_by_user', 'cancelled_by_driver')
        ELSE if(k < 80, 'no_driver_found', event_type) END""",
    "city": "r_name",
    "pickup_area": "n_name",
    "drop_area": "concat(n_name, '-', k % 10)",
    "vehicle_type": """CASE WHEN k = 9 THEN c_mktsegment WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Sedan'
        WHEN c_mktsegment = 'BUILDING' THEN 'SUV' WHEN c_mktsegment = 'FURNITURE' THEN 'Mini'
        WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Auto' ELSE 'Bike' END""",
    "driver_id": "concat('D-', r_name, '-', u % 5, '-', k)",
    "driver_name": "concat('Driver ', k)",
    "driver_rating": "if(k = 17, NULL, 1 + (k % 45) / 10D)",
    "rider_id": "concat('C-', u)",
    "distance_km": "value / 10D",
    "duration_mins": "CAST(floor(value / 2D) AS INT)",
    "base_fare": "value",
    "surge_multiplier": "1 + (k % 4) / 4D",
    "final_fare": "CASE WHEN k = 7 THEN 0D WHEN k = 8 THEN NULL ELSE value END",
    "payment_method": "CASE k % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Cash' WHEN 2 THEN 'Card' ELSE 'Wallet' END",
    "cancellation_reason": """CASE WHEN event_type IN ('signup', 'error') AND k < 80
        THEN if(k % 11 = 0, '', concat('reason ', k % 3)) END""",
    "zone_id": "concat(r_name, '-', k % 5)",
    "is_peak_hour": "extract(hour FROM ts) IN (8, 9, 18, 19, 20)",
    "_ingest_time": "ts + INTERVAL 2 SECONDS",
}


def rides_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events joined to customers on the user, then to the region of the customer's nation.

    Events and customers both grow with the data, so that join carries no hint: below
    Spark's size limit the customers are broadcast, beyond it both sides are shuffled and
    adaptive execution splits the partition of a user who owns many events.  ``nation`` and
    ``region`` have 25 and 5 rows by the definition of the schema, hence the hint on them.
    """

    def table(name: str, schema: str | None = None) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(f"{sf_dir}/{name}.parquet")

    number = "CAST(regexp_extract(coalesce(props, '0'), '([0-9]+)', 1) AS INT) AS k"
    events = table("events").selectExpr("event_id", "ts", "user_id AS u", "event_type", "value", number)
    customers = table("customer", "c_custkey bigint, c_nationkey int, c_mktsegment string")
    homes = table("nation", "n_nationkey int, n_name string, n_regionkey int").join(
        table("region", "r_regionkey int, r_name string"), F.expr("n_regionkey = r_regionkey")
    )
    placed = events.join(customers, F.expr("u = c_custkey")).join(
        F.broadcast(homes), F.expr("c_nationkey = n_nationkey")
    )
    return placed.selectExpr(*[f"{text} AS {name}" for name, text in _RIDE.items()])
