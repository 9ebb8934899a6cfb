"""Re-pricing of a rides table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.functions.fares import expected_fare, tariff_table, unrounded_base


def audit_fares(rides: DataFrame, tariff: DataFrame | None = None) -> DataFrame:
    """Each ride with the fare it should have had and a finding.

    The built-in tariff has five rows and is broadcast; a tariff passed in is joined as
    Spark sees fit.  Differences up to one paisa are rounding.
    """
    known = F.broadcast(tariff_table(rides.sparkSession)) if tariff is None else tariff
    priced = rides.join(known, "vehicle_type", "left").withColumns(
        {
            "expected_base": F.round(unrounded_base(), 2),
            "expected_fare": expected_fare(),
        }
    )
    gap = F.round(F.col("final_fare") - F.col("expected_fare"), 2)
    finding = (
        F.when(F.col("flag_fall").isNull(), "no_tariff")
        .when(F.col("expected_fare").isNull(), "not_priceable")
        .when(F.col("final_fare").isNull(), "no_fare")
        .when(F.abs(gap) > 0.01, "differs")
        .otherwise("agrees")
    )
    return priced.select(
        "ride_id",
        "vehicle_type",
        "distance_km",
        "surge_multiplier",
        "base_fare",
        "final_fare",
        "expected_base",
        "expected_fare",
        gap.alias("fare_gap"),
        finding.alias("finding"),
    )
