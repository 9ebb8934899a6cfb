"""From landed events to cleaned rides: typed, enriched, checked."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kerbline.functions.timeparts import is_weekend, parsed_time
from kerbline.operators.quality import RIDE_RULES, RIDE_WATCHES, keep_valid, watched
from kerbline.schema import CANCELLED_STATUSES, RESCUED

# The measures whose type is enforced here.
MEASURE_TYPES = {
    "final_fare": "double",
    "base_fare": "double",
    "distance_km": "double",
    "duration_mins": "int",
}


def enrich(events: DataFrame) -> DataFrame:
    """Adds the calendar columns and the cancellation flag; drops the rescue column."""
    timed = events.withColumn("event_time", parsed_time(events))
    time = F.col("event_time")
    return timed.withColumns(
        {
            "event_date": F.to_date(time),
            "event_hour": F.hour(time),
            "event_minute": F.minute(time),
            "day_of_week": F.dayofweek(time),
            "is_weekend": is_weekend(time),
            **{name: F.col(name).cast(kind) for name, kind in MEASURE_TYPES.items()},
            "is_cancelled": F.col("status").isin(*CANCELLED_STATUSES),
        }
    ).drop(RESCUED)


def checked(
    enriched: DataFrame,
    rules: Mapping[str, str] = RIDE_RULES,
    observe: Observation | str | None = None,
) -> DataFrame:
    """The rides that meet every rule; with ``observe``, violations are counted on the way."""
    if observe is not None:
        enriched = watched(enriched, rules, RIDE_WATCHES, observe)
    return keep_valid(enriched, rules)


def clean(
    events: DataFrame,
    rules: Mapping[str, str] = RIDE_RULES,
    observe: Observation | str | None = None,
) -> DataFrame:
    """The cleaned rides; the same function serves a batch and a stream."""
    return checked(enrich(events), rules, observe)
