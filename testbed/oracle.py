"""The same results as SQL text for an independent engine (DuckDB), over the test tables.

Every text starts from ``RIDES`` and ``SILVER``; nothing here is used by the jobs.
"""

from __future__ import annotations

RIDES = """
e AS (SELECT *, user_id AS u, CAST(regexp_extract(coalesce(props, '0'), '([0-9]+)', 1) AS INTEGER) AS k
 FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey),
rides AS (SELECT CASE WHEN k <> 42 THEN 'E-' || event_id END AS ride_id, ts AS event_time,
 CASE WHEN event_type IN ('purchase', 'view') OR (event_type = 'click' AND k < 90) THEN 'completed'
  WHEN event_type = 'click' THEN 'in_progress'
  WHEN event_type = 'signup' AND k < 50 THEN 'cancelled_by_user' WHEN event_type = 'signup' THEN 'cancelled_by_driver'
  WHEN k < 80 THEN 'no_driver_found' ELSE event_type END AS status,
 r_name AS city, n_name AS pickup_area, n_name || '-' || (k % 10) AS drop_area,
 CASE WHEN k = 9 THEN c_mktsegment ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Sedan' WHEN 'BUILDING' THEN 'SUV'
  WHEN 'FURNITURE' THEN 'Mini' WHEN 'HOUSEHOLD' THEN 'Auto' ELSE 'Bike' END END AS vehicle_type,
 'D-' || r_name || '-' || (u % 5) || '-' || k AS driver_id, 'Driver ' || k AS driver_name,
 CASE WHEN k <> 17 THEN 1 + (k % 45) / 10e0 END AS driver_rating, 'C-' || u AS rider_id,
 value / 10e0 AS distance_km, CAST(floor(value / 2e0) AS INTEGER) AS duration_mins, value AS base_fare,
 1 + (k % 4) / 4e0 AS surge_multiplier, CASE WHEN k = 7 THEN 0e0 WHEN k <> 8 THEN value END AS final_fare,
 CASE k % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Cash' WHEN 2 THEN 'Card' ELSE 'Wallet' END AS payment_method,
 CASE WHEN event_type IN ('signup', 'error') AND k < 80
  THEN CASE WHEN k % 11 = 0 THEN '' ELSE 'reason ' || (k % 3) END END AS cancellation_reason,
 r_name || '-' || (k % 5) AS zone_id, extract(hour FROM ts) IN (8, 9, 18, 19, 20) AS is_peak_hour,
 ts + INTERVAL 2 SECONDS AS _ingest_time FROM e)"""

SILVER = """
silver AS (SELECT *, CAST(event_time AS DATE) AS event_date,
 CAST(extract(hour FROM event_time) AS INTEGER) AS event_hour,
 CAST(extract(minute FROM event_time) AS INTEGER) AS event_minute,
 CAST(extract(dow FROM event_time) + 1 AS INTEGER) AS day_of_week,
 extract(dow FROM event_time) IN (0, 6) AS is_weekend,
 status IN ('cancelled_by_user','cancelled_by_driver','no_driver_found') AS is_cancelled
 FROM rides
 WHERE ride_id IS NOT NULL AND final_fare > 0 AND distance_km BETWEEN 0.5 AND 50
 AND driver_rating BETWEEN 1.0 AND 5.0
 AND status IN ('completed','cancelled_by_user','cancelled_by_driver','no_driver_found','in_progress')
 AND vehicle_type IN ('Bike','Auto','Mini','Sedan','SUV'))"""


def rounded(value: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text of a double."""
    text = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,15))"
    return f"CAST(round({text}, {digits}) AS DOUBLE)"


def _over_rides(body: str) -> str:
    return f"WITH {RIDES}\n{body}"


def _over_silver(*steps: str) -> str:
    *views, body = steps
    return f"WITH {', '.join([RIDES, SILVER, *views])}\n{body}"


DONE = "status = 'completed'"
N = "CAST(count(ride_id) AS BIGINT)"
N_DONE = f"CAST(count(*) FILTER ({DONE}) AS BIGINT)"
N_CANCELLED = "CAST(count(*) FILTER (is_cancelled) AS BIGINT)"


def _total(value: str) -> str:
    """A sum that does not depend on the order of addition."""
    return f"CAST(sum(CAST(round({value} * 10000) AS BIGINT)) AS DOUBLE) / 10000"


def _mean(value: str) -> str:
    return f"CAST(sum(CAST(round({value} * 10000) AS BIGINT)) AS DOUBLE) / (count({value}) * 10000)"


_DONE_FARE = f"CASE WHEN {DONE} THEN final_fare END"
_DONE_RATING = f"CASE WHEN {DONE} THEN driver_rating END"
FARES = f"coalesce({_total(_DONE_FARE)}, 0)"
CANCEL_PCT = rounded("count(*) FILTER (is_cancelled) * 100e0 / count(ride_id)", 1)
MEAN_DONE = rounded(_mean(_DONE_FARE), 2)

LIVE_KPIS = f"""SELECT event_date, {N} AS total_rides, {FARES} AS total_revenue_inr,
 {CANCEL_PCT} AS cancellation_rate_pct, CAST(count(DISTINCT driver_id) AS BIGINT) AS active_drivers,
 {MEAN_DONE} AS avg_fare_inr, max(_ingest_time) AS last_updated FROM silver GROUP BY event_date"""


def _revenue_per_minute(as_of: str) -> str:
    return f"""SELECT date_trunc('minute', event_time) AS minute_bucket,
 {rounded(_total('final_fare'), 2)} AS revenue_inr, {N} AS completed_rides FROM silver
 WHERE {DONE} AND event_time >= TIMESTAMP '{as_of}' - INTERVAL 60 MINUTES GROUP BY 1"""


RIDES_BY_CITY = f"""SELECT city, {N} AS total_rides, {N_DONE} AS completed_rides,
 {rounded(FARES, 2)} AS revenue_inr, {MEAN_DONE} AS avg_fare_inr FROM silver GROUP BY city"""


def _top_zones(as_of: str) -> str:
    return f"""SELECT zone_id, city, {rounded(_total('final_fare'), 2)} AS total_revenue_inr, {N} AS completed_rides,
 {rounded(_mean('final_fare'), 2)} AS avg_fare_inr, {rounded(_mean('distance_km'), 1)} AS avg_distance_km
 FROM silver WHERE event_date = CAST(TIMESTAMP '{as_of}' AS DATE) AND {DONE} GROUP BY zone_id, city
 ORDER BY total_revenue_inr DESC, zone_id, city LIMIT 10"""


STATUS_BREAKDOWN = (
    f"SELECT event_date, status, {N} AS ride_count FROM silver GROUP BY event_date, status"
)
PICKUP_DEMAND = f"""SELECT event_date, city, pickup_area, zone_id, {N} AS total_rides,
 {N_DONE} AS completed_rides, {N_CANCELLED} AS cancelled_rides, {CANCEL_PCT} AS cancellation_rate_pct,
 {rounded(_mean('surge_multiplier'), 2)} AS avg_surge, {rounded(FARES, 2)} AS revenue_inr
 FROM silver GROUP BY event_date, city, pickup_area, zone_id"""
CANCELLATION = f"""SELECT event_date, city, status, cancellation_reason, {N} AS cancellation_count,
 {rounded(_mean('surge_multiplier'), 2)} AS avg_surge_at_cancel, {rounded(_mean('distance_km'), 1)} AS avg_distance_km
 FROM silver WHERE is_cancelled GROUP BY event_date, city, status, cancellation_reason"""
HOURLY = f"""SELECT event_date, event_hour, city, {N} AS total_rides, {N_DONE} AS completed_rides,
 {N_CANCELLED} AS cancelled_rides, {rounded(_mean('surge_multiplier'), 2)} AS avg_surge, is_weekend
 FROM silver GROUP BY event_date, event_hour, city, is_weekend"""
LEADERBOARD = f"""SELECT *, CAST(rank() OVER (PARTITION BY event_date ORDER BY revenue_inr DESC) AS BIGINT) AS rank
 FROM (SELECT event_date, driver_id, {N} AS completed_rides, {rounded(_total('final_fare'), 2)} AS revenue_inr,
 {rounded(_mean('driver_rating'), 2)} AS avg_rating FROM silver WHERE {DONE} GROUP BY event_date, driver_id)"""
STATUS_SHARES = f"""SELECT event_date, status, ride_count,
 {rounded('ride_count * 100e0 / sum(ride_count) OVER (PARTITION BY event_date)', 1)} AS pct_of_total
 FROM ({STATUS_BREAKDOWN})"""



def _parts(name: str, value: str) -> str:
    return f"{_total(value)} AS {name}_sum, CAST(count({value}) AS BIGINT) AS {name}_n"


_COUNTS = f"{N} AS rides, {N_DONE} AS completed, {N_CANCELLED} AS cancelled, {_parts('fare', _DONE_FARE)}"
PLACE_HOURS = f"""SELECT event_date, event_hour, city, pickup_area, zone_id, status, is_cancelled,
 cancellation_reason, {_COUNTS}, {_parts('surge', 'surge_multiplier')}, {_parts('distance', 'distance_km')}
 FROM silver GROUP BY ALL"""
DRIVER_DAYS = f"""SELECT event_date, driver_id, {_COUNTS}, {_parts('rating', _DONE_RATING)},
 max(_ingest_time) AS ingested FROM silver GROUP BY ALL"""

DASH_KPIS = f"""SELECT k.event_date, total_revenue_inr, cancellation_rate_pct, active_drivers, avg_fare_inr,
 CAST({rounded('total_rides * (100 - cancellation_rate_pct) / 100', 0)} AS BIGINT) AS completed_rides_est,
 completed_rides
 FROM ({LIVE_KPIS}) k JOIN (SELECT event_date, {N_DONE} AS completed_rides FROM silver GROUP BY event_date) d
 ON k.event_date = d.event_date"""
DASH_CANCEL = f"""SELECT city, coalesce(nullif(cancellation_reason, ''), status) AS reason,
 {N} AS cancellation_count FROM silver WHERE is_cancelled GROUP BY 1, 2"""
DASH_PICKUP = f"""SELECT city, pickup_area, zone_id, {N} AS total_rides, {N_CANCELLED} AS cancelled_rides,
 {CANCEL_PCT} AS cancel_rate_pct FROM silver GROUP BY city, pickup_area, zone_id"""

RULES = {
    "valid_ride_id": "ride_id IS NOT NULL",
    "valid_fare": "final_fare > 0",
    "valid_distance": "distance_km BETWEEN 0.5 AND 50",
    "valid_rating": "driver_rating BETWEEN 1.0 AND 5.0",
    "valid_status": "status IN ('completed','cancelled_by_user','cancelled_by_driver','no_driver_found','in_progress')",
    "valid_vehicle": "vehicle_type IN ('Bike','Auto','Mini','Sedan','SUV')",
}
RULE_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, CAST(count(*) AS BIGINT) AS rows_in, "
    f"CAST(count(*) FILTER (({rule}) IS NOT TRUE) AS BIGINT) AS violations FROM rides"
    for name, rule in RULES.items()
)

_VEHICLE = "CASE vehicle_type WHEN 'Bike' THEN {} WHEN 'Auto' THEN {} WHEN 'Mini' THEN {} WHEN 'Sedan' THEN {} WHEN 'SUV' THEN {} END"
_BASE = f"({_VEHICLE.format(15, 25, 40, 60, 80)} + {_VEHICLE.format(8, 12, 14, 18, 22)} * distance_km)"
_LOW = _VEHICLE.format("30e0", "50e0", "100e0", "150e0", "250e0")
_HIGH = _VEHICLE.format("150e0", "200e0", "400e0", "600e0", "800e0")
FARE_AUDIT = f"""SELECT ride_id, vehicle_type, distance_km, surge_multiplier, base_fare, final_fare,
 {rounded('b', 2)} AS expected_base, x AS expected_fare, gap AS fare_gap,
 CASE WHEN b IS NULL THEN 'no_tariff' WHEN x IS NULL THEN 'not_priceable' WHEN final_fare IS NULL THEN 'no_fare'
 WHEN abs(gap) > 0.01 THEN 'differs' ELSE 'agrees' END AS finding
 FROM (SELECT *, {rounded('final_fare - x', 2)} AS gap FROM (SELECT *, {rounded('raw', 2)} AS x
 FROM (SELECT *, {_BASE} AS b, CASE WHEN {_BASE} IS NOT NULL AND surge_multiplier IS NOT NULL
 THEN least(greatest({_BASE} * surge_multiplier, {_LOW}), {_HIGH}) END AS raw FROM rides)))"""


def _peak(time: str) -> str:
    hour = f"extract(hour FROM {time})"
    return f"(({hour} >= 8 AND {hour} < 10) OR ({hour} >= 18 AND {hour} < 21))"


PEAK_FLAGS = f"""SELECT ride_id, event_time, {_peak('event_time')} AS is_peak_local,
 {_peak('(event_time + INTERVAL 330 MINUTES)')} AS is_peak_india FROM rides"""

_MONEY = "CAST(o_totalprice AS DECIMAL(18,2))"
_MEAN_ORDER = rounded(f"CAST(sum({_MONEY}) AS DOUBLE) / count(*)", 2)
_ORDER_SUMS = f"""CAST(count(*) AS BIGINT) AS total_orders, CAST(sum({_MONEY}) AS DOUBLE) AS total_revenue,
 {_MEAN_ORDER} AS avg_order_value"""


def _orders_by(keys: str, where: str) -> str:
    return f"SELECT {keys}, {_ORDER_SUMS} FROM orders WHERE o_orderstatus = 'F' AND {where} GROUP BY ALL"


_BY_YEAR = "CAST(extract(year FROM o_orderdate) AS INTEGER) AS order_year, o_orderpriority AS category"


def oracle_texts(
    as_of: str, known_until: str, purged_before: str, checked: dict[str, tuple], clocks: tuple[str, ...]
) -> dict[str, str]:
    """Query name -> SQL.  The dates are the fixed clock and the two cut-offs of the
    upsert queries; ``checked`` names the sums that tell whether a table is right, ``clocks``
    those of the sliding window."""
    newest = _orders_by(_BY_YEAR, "TRUE")
    kept = _orders_by(_BY_YEAR, f"o_orderdate >= TIMESTAMP '{purged_before}'")
    earlier = _orders_by(_BY_YEAR, f"o_orderdate < TIMESTAMP '{known_until}'")
    stale = f"""WITH old AS ({earlier}), new AS ({kept})
 SELECT * FROM new UNION ALL
 SELECT * FROM old WHERE (order_year, category) NOT IN (SELECT (order_year, category) FROM new)"""
    minute = _revenue_per_minute(as_of)
    zones = _top_zones(as_of)
    stream_columns = "* EXCLUDE (_ingest_time)"
    texts = {
        "rides_bronze": _over_rides("SELECT * FROM rides"),
        "silver_rides": _over_silver("SELECT * FROM silver"),
        "dq_rule_metrics": _over_rides(RULE_COUNTS),
        "landing_batch": _over_rides(
            "SELECT * EXCLUDE (event_time, _ingest_time), CAST(event_time AS VARCHAR) AS event_time FROM rides"
        ),
        "place_hours": _over_silver(PLACE_HOURS),
        "driver_days": _over_silver(DRIVER_DAYS),
        "city_totals": _over_silver(f"SELECT city, {_COUNTS} FROM silver GROUP BY city").replace(
            f"{N_CANCELLED} AS cancelled, ", ""
        ),
        "live_kpis": _over_silver(LIVE_KPIS),
        "revenue_per_minute": _over_silver(minute),
        "rides_by_city": _over_silver(RIDES_BY_CITY),
        "top_zones": _over_silver(zones),
        "status_breakdown": _over_silver(STATUS_BREAKDOWN),
        "active_drivers_between": _over_silver(
            """SELECT city, count(DISTINCT event_date) AS days, count(*) AS rides,
 count(DISTINCT driver_id) AS exact_drivers, TRUE AS close
 FROM silver WHERE event_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-17' GROUP BY city"""
        ),
        "active_drivers_last_week": _over_silver(
            """SELECT d.event_date, count(DISTINCT s.event_date) AS days, count(DISTINCT driver_id) AS exact_drivers,
 TRUE AS close FROM (SELECT DISTINCT event_date FROM silver) d
 JOIN silver s ON s.event_date BETWEEN d.event_date - 6 AND d.event_date GROUP BY d.event_date"""
        ),
        "status_pct_of_day": _over_silver(STATUS_SHARES),
        "pickup_demand": _over_silver(PICKUP_DEMAND),
        "cancellation_analysis": _over_silver(CANCELLATION),
        "hourly_demand": _over_silver(HOURLY),
        "driver_leaderboard": _over_silver(LEADERBOARD),
        "revenue_by_category": _orders_by("o_orderpriority AS category", "TRUE"),
        "merge_upsert": newest,
        "merge_upsert_pruned": newest,
        "sql_inserts": f"""SELECT o_orderpriority AS category, {_ORDER_SUMS} FROM (
  SELECT o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION ALL VALUES ('Electronics', 1200), ('Electronics', 780), ('1-URGENT', 0.25)) GROUP BY ALL""",
        "table_day_overwrite": _over_silver(PICKUP_DEMAND),
        "merge_stale_keys": stale,
        "merge_delete_missing": kept,
        "category_incremental": _orders_by("o_orderpriority AS category", "TRUE"),
        "refresh_full": _over_silver(RIDES_BY_CITY),
        "refresh_partition_overwrite": _over_silver(PICKUP_DEMAND),
        "refresh_incremental": _over_silver(LIVE_KPIS),
        "revenue_sliding": _over_silver(
            " UNION ALL ".join(
                f"SELECT *, '{at}' AS clock, 'incremental' AS mode FROM ({_revenue_per_minute(at)})" for at in clocks
            )
        ),
        "refresh_skip": _over_silver(
            f"SELECT *, 1 AS versions, 'skipped' AS second_refresh FROM ({STATUS_BREAKDOWN})"
        ),
        "refresh_all_tables": _over_silver(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS rows, "
                f"CAST(sum({checked[name][0]}) AS BIGINT) AS counted, CAST("
                + (f"sum(CAST(round({checked[name][1]} * 100) AS BIGINT))" if checked[name][1] else "0")
                + f" AS BIGINT) AS paise FROM ({text})"
                for name, text in {
                    "gold_live_kpis": LIVE_KPIS,
                    "gold_revenue_per_minute": minute,
                    "gold_rides_by_city": RIDES_BY_CITY,
                    "gold_top_zones": zones,
                    "gold_ride_status_breakdown": STATUS_BREAKDOWN,
                    "gold_pickup_demand": PICKUP_DEMAND,
                    "gold_cancellation_analysis": CANCELLATION,
                    "gold_hourly_demand": HOURLY,
                    "gold_driver_leaderboard": LEADERBOARD,
                }.items()
            )
        ),
        "ordered_reads": _over_silver(
            f"""SELECT *, row_number() OVER (ORDER BY ride_count DESC, event_date, status) - 1 AS place
 FROM ({STATUS_BREAKDOWN})"""
        ),
        "ordered_minutes": _over_silver(
            f"SELECT *, row_number() OVER (ORDER BY minute_bucket) - 1 AS place FROM ({minute})"
        ),
        "view_refresh_full": _orders_by("o_orderpriority AS category", "TRUE"),
        "view_refresh_incremental": _orders_by("o_orderpriority AS category", "TRUE"),
        "view_refresh_skip": "SELECT *, 2 AS versions, 'skipped' AS third_refresh FROM ("
        + _orders_by("o_orderpriority AS category", "TRUE")
        + ")",
        "observed_rule_metrics": _over_rides(RULE_COUNTS),
        "continuous_rule_metrics": _over_rides(RULE_COUNTS),
        "fare_audit": _over_rides(FARE_AUDIT),
        "peak_hour_flag": _over_rides(PEAK_FLAGS),
        "dash_kpis": _over_silver(DASH_KPIS),
        "dash_kpis_today": _over_silver(
            f"SELECT * FROM ({DASH_KPIS}) WHERE event_date = CAST(TIMESTAMP '{as_of}' AS DATE)"
        ),
        "dash_revenue": _over_silver(minute),
        "dash_status": _over_silver(f"SELECT status, ride_count FROM ({STATUS_BREAKDOWN})"),
        "dash_status_summed": _over_silver(
            f"SELECT status, {N} AS ride_count FROM silver GROUP BY status"
        ),
        "dash_cities": _over_silver(
            f"SELECT city, {rounded('revenue_inr', 0)} AS revenue_inr FROM ({RIDES_BY_CITY})"
        ),
        "dash_zones": _over_silver(
            f"""SELECT zone_id, city, {rounded('total_revenue_inr', 0)} AS total_revenue_inr,
 completed_rides, {rounded('avg_fare_inr', 0)} AS avg_fare_inr FROM ({zones})"""
        ),
        "dash_cancel_reasons": _over_silver(DASH_CANCEL),
        "dash_pickup": _over_silver(DASH_PICKUP),
        "stream_silver": _over_silver(f"SELECT {stream_columns} FROM silver"),
        "landing_from_setting": _over_rides(
            """SELECT CASE WHEN payment_method = 'Cash' THEN 2 ELSE 1 END AS run, count(*) AS rides,
 CAST(1 AS BIGINT) AS stamps FROM rides GROUP BY 1"""
        ),
        "stream_failing_batch": _over_silver("SELECT status, count(*) AS rides, TRUE AS raised FROM silver GROUP BY status"),
        "stream_table_silver": _over_silver(f"SELECT {stream_columns} FROM silver"),
        "stream_days_compacted": _over_silver(f"SELECT {stream_columns} FROM silver"),
        "stream_silver_by_batch": _over_silver(f"SELECT {stream_columns} FROM silver"),
        "stream_rule_metrics": _over_rides(RULE_COUNTS),
        "stream_to_gold": _over_silver(CANCELLATION),
        "stream_to_leaderboard": _over_silver(LEADERBOARD),
    }
    # The dashboard's SQL texts give what its DataFrame forms give.
    same = "kpis kpis_today revenue status cities zones cancel_reasons pickup".split()
    return texts | {f"sql_ds_{name}": texts[f"dash_{name}"] for name in same}
