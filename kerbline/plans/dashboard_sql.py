"""The dashboard's datasets as SQL, for tools that hold their queries as text.

Parameters are named: ``prefix`` stands before the names of the aggregate tables (a database and a point, or
nothing), ``as_of`` is the clock (null: all days), ``k`` the length of a top list.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from kerbline.plans.gold import AsOf


@dataclass(frozen=True)
class SqlDataset:
    """``body`` names aggregate tables in braces; ``order`` sorts for reading; ``parameters`` are those of
    its own, with type and default."""

    body: str
    order: str = ""
    parameters: tuple[tuple[str, str], ...] = ()

    def _with_tables(self, shown) -> str:
        names = {name for _, name, *_ in Formatter().parse(self.body) if name}
        return self.body.format_map({name: shown(name) for name in names})

    def text(self) -> str:
        """The query with named parameters."""
        body = self._with_tables(lambda name: f"IDENTIFIER(:prefix || '{name}')")
        ordered = f"{body}\nORDER BY {self.order}" if self.order else body
        return f"{ordered}\nLIMIT :k" if self._is_top() else ordered

    def _is_top(self) -> bool:
        return any(name == "k" for name, _ in self.parameters)

    def function(self, name: str, prefix: str) -> str:
        """The query as a table function; the order of its rows is the reader's."""
        body = self._with_tables(lambda table: f"{prefix}{table}").replace(":as_of", "as_of")
        if self._is_top():
            body = f"""SELECT * EXCEPT (place)
FROM (SELECT *, row_number() OVER (ORDER BY {self.order}) AS place FROM ({body})) WHERE place <= k"""
        declared = ", ".join(f"{parameter} {kind}" for parameter, kind in self.parameters)
        return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS TABLE RETURN {body}"


DATASETS: dict[str, SqlDataset] = {
    "ds_kpis": SqlDataset(
        """SELECT k.event_date, k.total_revenue_inr, k.cancellation_rate_pct, k.active_drivers, k.avg_fare_inr,
  CAST(round(k.total_rides * (100 - k.cancellation_rate_pct) / 100, 0) AS BIGINT) AS completed_rides_est,
  CAST(coalesce(done.ride_count, 0) AS BIGINT) AS completed_rides
FROM {gold_live_kpis} AS k
LEFT JOIN {gold_ride_status_breakdown} AS done
  ON k.event_date <=> done.event_date AND done.status = 'completed'
WHERE :as_of IS NULL OR k.event_date = to_date(CAST(:as_of AS TIMESTAMP))""",
        parameters=(("as_of", "STRING DEFAULT NULL"),),
    ),
    "ds_revenue": SqlDataset(
        "SELECT minute_bucket, revenue_inr, completed_rides FROM {gold_revenue_per_minute}", "minute_bucket"
    ),
    "ds_status": SqlDataset(
        "SELECT status, CAST(ride_count AS BIGINT) AS ride_count FROM {gold_ride_status_breakdown}",
        "ride_count DESC, status",
    ),
    "ds_cities": SqlDataset(
        "SELECT city, round(revenue_inr, 0) AS revenue_inr FROM {gold_rides_by_city}", "revenue_inr DESC, city"
    ),
    "ds_zones": SqlDataset(
        """SELECT zone_id, city, round(total_revenue_inr, 0) AS total_revenue_inr,
  CAST(completed_rides AS BIGINT) AS completed_rides, round(avg_fare_inr, 0) AS avg_fare_inr
FROM {gold_top_zones}""",
        "total_revenue_inr DESC, zone_id, city",
        (("k", "INT DEFAULT 10"),),
    ),
    "ds_cancel_reasons": SqlDataset(
        """SELECT city, coalesce(nullif(cancellation_reason, ''), status) AS reason,
  CAST(sum(cancellation_count) AS BIGINT) AS cancellation_count
FROM {gold_cancellation_analysis}
GROUP BY city, coalesce(nullif(cancellation_reason, ''), status)""",
        "cancellation_count DESC, city, reason",
    ),
    "ds_pickup": SqlDataset(
        """SELECT city, pickup_area, zone_id, CAST(sum(total_rides) AS BIGINT) AS total_rides,
  CAST(sum(cancelled_rides) AS BIGINT) AS cancelled_rides,
  round(try_divide(sum(cancelled_rides) * 100D, sum(total_rides)), 1) AS cancel_rate_pct
FROM {gold_pickup_demand}
GROUP BY city, pickup_area, zone_id""",
        "total_rides DESC, city, pickup_area, zone_id",
    ),
}


def dataset(
    spark: SparkSession, name: str, as_of: AsOf = None, prefix: str = "", k: int = 10
) -> DataFrame:
    """A dataset by the name the dashboard knows it by."""
    chosen = DATASETS[name]
    own = {"as_of": None if as_of is None else str(as_of), "k": k}
    bound = {parameter: own[parameter] for parameter, _ in chosen.parameters}
    return spark.sql(chosen.text(), {"prefix": prefix, **bound})


def offer_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """The datasets as temporary table functions of the session: ``SELECT * FROM ds_kpis('2024-01-30')``."""
    for name, chosen in DATASETS.items():
        spark.sql(chosen.function(name, prefix))
    return list(DATASETS)
