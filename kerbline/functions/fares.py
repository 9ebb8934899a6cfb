"""Tariff and fare expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Vehicle type, flag-fall, price per km, lowest and highest fare.
TARIFF = (
    ("Bike", 15, 8, 30, 150),
    ("Auto", 25, 12, 50, 200),
    ("Mini", 40, 14, 100, 400),
    ("Sedan", 60, 18, 150, 600),
    ("SUV", 80, 22, 250, 800),
)


def tariff_table(spark: SparkSession) -> DataFrame:
    """The tariff as an inline table: five rows by definition, so it always broadcasts."""
    rows = ", ".join(f"('{name}', {a}D, {b}D, {c}D, {d}D)" for name, a, b, c, d in TARIFF)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(vehicle_type, flag_fall, per_km, min_fare, max_fare)"
    )


def unrounded_base() -> Column:
    return F.col("flag_fall") + F.col("per_km") * F.col("distance_km")


def expected_fare() -> Column:
    """Base times surge, held within the vehicle's limits, then rounded to paise.

    The unrounded base goes in; rounding it first would shift fares by a paisa.
    """
    surged = unrounded_base() * F.col("surge_multiplier")
    held = F.least(F.greatest(surged, F.col("min_fare")), F.col("max_fare"))
    # greatest/least skip nulls, so a missing distance or surge must be passed on by hand.
    return F.round(F.when(surged.isNotNull(), held), 2)
