"""Named data-quality rules: drop offending rows, count offences per rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbline.schema import STATUSES, VEHICLES


def _one_of(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


# The accepted ranges of a ride.
RIDE_RULES: dict[str, str] = {
    "valid_ride_id": "ride_id IS NOT NULL",
    "valid_fare": "final_fare > 0",
    "valid_distance": "distance_km BETWEEN 0.5 AND 50",
    "valid_rating": "driver_rating BETWEEN 1.0 AND 5.0",
    "valid_status": f"status IN {_one_of(STATUSES)}",
    "valid_vehicle": f"vehicle_type IN {_one_of(VEHICLES)}",
}

# Counted beside the rules, but never a reason to drop a row.
RIDE_WATCHES: dict[str, str] = {"parsed_event_time": "event_time IS NOT NULL"}


def holds(rule: str) -> Column:
    """A rule that evaluates to null counts as broken."""
    return F.coalesce(F.expr(rule), F.lit(False))


def keep_valid(df: DataFrame, rules: Mapping[str, str] = RIDE_RULES) -> DataFrame:
    """Rows that meet every rule.  A filter drops nulls by itself, and bare comparisons
    (unlike ``coalesce``) can be pushed down to the file reader."""
    for rule in rules.values():
        df = df.filter(rule)
    return df


def _counters(rules: Mapping[str, str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(~holds(rule)).alias(name) for name, rule in rules.items()],
        F.count_if(~_all_hold(rules)).alias("rows_dropped"),
    ]


def _all_hold(rules: Mapping[str, str]) -> Column:
    return F.coalesce(F.expr(" AND ".join(f"({rule})" for rule in rules.values())), F.lit(False))


def rule_counts(df: DataFrame, rules: Mapping[str, str] = RIDE_RULES) -> DataFrame:
    """One row per rule: rows seen, rows that break it.  One pass over the data; a row that
    breaks two rules counts under both."""
    counted = df.agg(*_counters(rules))
    return counted.unpivot(
        ["rows_in"], list(rules), variableColumnName="rule", valueColumnName="violations"
    ).select("rule", "rows_in", "violations")


#: The columns that the rules and watches read.
RULE_INPUTS = (
    "ride_id",
    "final_fare",
    "distance_km",
    "driver_rating",
    "status",
    "vehicle_type",
    "event_time",
)


def violations(
    df: DataFrame,
    rules: Mapping[str, str] = RIDE_RULES,
    watches: Mapping[str, str] = RIDE_WATCHES,
) -> DataFrame:
    """One row: rows seen, rows that break each rule, rows dropped, rows that fail each watch."""
    extra = [F.count_if(~holds(rule)).alias(name) for name, rule in watches.items()]
    return df.agg(*_counters(rules), *extra)


def watched(
    df: DataFrame,
    rules: Mapping[str, str] = RIDE_RULES,
    watches: Mapping[str, str] | None = None,
    into: Observation | str = "quality",
) -> DataFrame:
    """``df`` unchanged, with the counts taken as a side effect of whatever job reads it.

    Batch: pass an ``Observation`` and read it after the action.  Stream: pass a name and
    find the counts in each progress report.
    """
    extra = [F.count_if(~holds(rule)).alias(name) for name, rule in (watches or {}).items()]
    return df.observe(into, *_counters(rules), *extra)
