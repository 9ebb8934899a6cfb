"""Every query this package answers, by name, over the star-schema test tables.

A query takes the session and the folder of the tables.  Queries about stored tables and
streams really store and stream, below the shared scratch folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.functions.timeparts import NTZ, is_peak
from kerbline.operators.audit import audit_fares
from kerbline.operators.cleaning import clean
from kerbline.operators.quality import RIDE_RULES, rule_counts
from kerbline.operators.rollup import in_units
from kerbline.operators.upsert import upsert
from kerbline.plans import dashboard, dashboard_sql, gold, orders, sketches
from kerbline.plans.refresh import refresh
from kerbline.plans.views import VIEWS
from kerbline.schema import INGEST_TIME, RESCUED
from kerbline.sources import files
from kerbline.sources.landing import LANDING_SETTING, read_landing, write_landing
from testbed.rides import rides_view
from kerbline.sources.scratch import scratch_path, stored
from kerbline.sources.snapshots import append
from kerbline.sources.tables import CatalogTable, create_database
from kerbline.sources.warehouse import Warehouse
from kerbline.streaming import flows
from kerbline.streaming.counts import RuleCounts, mend
from kerbline.streaming.tables import StreamTables

Query = Callable[[SparkSession, str], DataFrame]

# The clock of all queries; the test events span 2024-01-01 to 2024-01-30.
AS_OF = "2024-01-30 12:00:00"
# Cash rides from this day on arrive in a second, late load.
LATE_FROM = "2024-01-20"
# The stored order totals know orders up to here; orders before the second date were purged.
ORDERS_KNOWN_UNTIL = "1999-07-01"
ORDERS_PURGED_BEFORE = "1997-01-01"

# For each table a count and an amount whose sums tell whether its numbers are right.
CHECKED = {
    "gold_live_kpis": ("total_rides", "total_revenue_inr"),
    "gold_revenue_per_minute": ("completed_rides", "revenue_inr"),
    "gold_rides_by_city": ("total_rides", "revenue_inr"),
    "gold_top_zones": ("completed_rides", "total_revenue_inr"),
    "gold_ride_status_breakdown": ("ride_count", None),
    "gold_pickup_demand": ("total_rides", "revenue_inr"),
    "gold_cancellation_analysis": ("cancellation_count", None),
    "gold_hourly_demand": ("total_rides", None),
    "gold_driver_leaderboard": ("completed_rides", "revenue_inr"),
}

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(rides_view(spark, sf_dir))


def _gold(table: gold.GoldTable) -> Query:
    return lambda spark, sf_dir: table.build(_silver(spark, sf_dir), AS_OF)


# --- cleaned rides -------------------------------------------------------------------


@query
def rides_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_view(spark, sf_dir)


@query
def landing_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rides written as JSON lines and read back in one batch."""
    path = scratch_path(spark, "landing")
    write_landing(rides_view(spark, sf_dir), path)
    return read_landing(spark, path).drop(INGEST_TIME, RESCUED)


@query
def silver_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@query
def dq_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts(rides_view(spark, sf_dir))


def _in_units(parts: DataFrame) -> DataFrame:
    """Sums as plain figures."""
    sums = [name for name in parts.columns if name.endswith("_sum")]
    return parts.withColumns({name: in_units(name) for name in sums})


def _rollup(rollup: gold.Rollup) -> Query:
    return lambda spark, sf_dir: _in_units(rollup.of(_silver(spark, sf_dir)))


QUERIES["place_hours"] = _rollup(gold.PLACE_HOURS)
QUERIES["driver_days"] = _rollup(gold.DRIVER_DAYS)


@query
def city_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roll-up derived from another one."""
    parts = gold.PLACE_HOURS.of(_silver(spark, sf_dir))
    return _in_units(gold.CITY_TOTALS.merged(parts))


# --- aggregate tables ----------------------------------------------------------------

QUERIES["live_kpis"] = _gold(gold.LIVE_KPIS)
QUERIES["revenue_per_minute"] = _gold(gold.REVENUE_PER_MINUTE)
QUERIES["rides_by_city"] = _gold(gold.RIDES_BY_CITY)
QUERIES["top_zones"] = _gold(gold.TOP_ZONES)
QUERIES["status_breakdown"] = _gold(gold.STATUS_BREAKDOWN)
QUERIES["pickup_demand"] = _gold(gold.PICKUP_DEMAND)
QUERIES["cancellation_analysis"] = _gold(gold.CANCELLATION_ANALYSIS)
QUERIES["hourly_demand"] = _gold(gold.HOURLY_DEMAND)
QUERIES["driver_leaderboard"] = _gold(gold.DRIVER_LEADERBOARD)


def _day_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches by day and city, made of two loads, stored and added up."""
    silver = _silver(spark, sf_dir)
    keys = ("event_date", "city")
    late = F.coalesce(F.col("payment_method") == "Cash", F.lit(False))
    first, second = (stored(sketches.sketch_days(silver.filter(part), keys=keys), "sketches") for part in (~late, late))
    return sketches.merged(first.unionByName(second), keys)


def _close(estimate: Column, exact: Column) -> Column:
    """Within four standard errors."""
    bound = F.lit(4 * sketches.standard_error()) * exact
    return F.abs(estimate - exact) <= bound


@query
def active_drivers_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drivers active in a range of days, by city: the estimate from stored sketches is held against the
    exact count, which is what is shown."""
    first, last = "2024-01-03", "2024-01-17"
    estimated = sketches.active_between(_day_sketches(spark, sf_dir), first, last, by=["city"])
    rides = _silver(spark, sf_dir).filter(F.col("event_date").between(first, last))
    exact = rides.groupBy(F.col("city").alias("_city")).agg(F.count_distinct("driver_id").alias("exact_drivers"))
    both = estimated.join(exact, F.col("city").eqNullSafe(F.col("_city")), "full")
    return both.select(
        "city", "days", "rides", "exact_drivers", _close(F.col("active_drivers"), F.col("exact_drivers")).alias("close")
    )


@query
def active_drivers_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every day the drivers of the last seven days, from one sketch a day."""
    estimated = sketches.active_last_days(sketches.merged(_day_sketches(spark, sf_dir)))
    daily = _silver(spark, sf_dir).select("event_date", "driver_id").distinct()
    ends = daily.select(F.explode(F.sequence("event_date", F.date_add("event_date", 6))).alias("_end"), "driver_id")
    exact = ends.groupBy("_end").agg(F.count_distinct("driver_id").alias("exact_drivers"))
    both = estimated.join(exact, F.col("event_date") == F.col("_end"))
    return both.select("event_date", "days", "exact_drivers", _close(F.col("active_drivers"), F.col("exact_drivers")).alias("close"))


@query
def status_pct_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.status_shares(QUERIES["status_breakdown"](spark, sf_dir))


# --- orders --------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def _finished(table: DataFrame) -> DataFrame:
    money = F.col("o_totalprice").cast("decimal(18,2)")
    return orders.delivered_orders(table, "o_orderpriority", money, "o_orderstatus = 'F'")


def _by_year(table: DataFrame) -> DataFrame:
    keys = ("order_year", "category")
    counted = table.filter("o_orderstatus = 'F'").select(
        F.year("o_orderdate").alias("order_year"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    return orders.revenue_by_category(counted, keys)


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_year(_orders(spark, sf_dir).filter(F.col("o_orderdate") < ORDERS_KNOWN_UNTIL))


def _not_purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_year(_orders(spark, sf_dir).filter(F.col("o_orderdate") >= ORDERS_PURGED_BEFORE))


@query
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.revenue_by_category(_finished(_orders(spark, sf_dir)))


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals known at mid-1999, brought up to date: later groups updated or inserted."""
    renewed = _by_year(_orders(spark, sf_dir))
    return upsert(_known(spark, sf_dir), renewed, ["order_year", "category"])


@query
def merge_stale_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source lost its oldest orders; their totals stay in the target."""
    keys = ["order_year", "category"]
    return upsert(_known(spark, sf_dir), _not_purged(spark, sf_dir), keys)


@query
def merge_delete_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["order_year", "category"]
    return upsert(_known(spark, sf_dir), _not_purged(spark, sf_dir), keys, delete_missing=True)


@query
def category_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additive state of the older orders plus that of the newer ones."""
    table = _orders(spark, sf_dir)
    newer = F.col("o_orderdate") >= ORDERS_KNOWN_UNTIL
    state = orders.category_state(_finished(table.filter(~newer)))
    delta = orders.category_state(_finished(table.filter(newer)))
    return orders.shown(orders.add_state(state, delta))


# --- tables of the catalog -----------------------------------------------------------


def _database(spark: SparkSession) -> str:
    """A new database, so that runs of a query never share a table."""
    name = f"kerbline_{uuid.uuid4().hex}"
    create_database(spark, name, "Tables of one query")
    return name


@query
def merge_upsert_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored totals by year; those of the orders since mid-1999 are merged in, into the years that have any."""
    known = _known(spark, sf_dir)
    table = CatalogTable(spark, f"{_database(spark)}.order_totals")
    table.create(known.schema, ["order_year"], "Finished orders per year and priority", "gold")
    table.insert(known)
    recent = F.year("o_orderdate") >= F.year(F.lit(ORDERS_KNOWN_UNTIL).cast("date"))
    table.merge(_by_year(_orders(spark, sf_dir).filter(recent)), ["order_year", "category"])
    return table.read()


@query
def sql_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders put into a catalog table by SQL, a query's rows and then literal ones, and their totals
    seeded into another, which is replaced once the literal rows are in."""
    database = _database(spark)
    orders_table = CatalogTable(spark, f"{database}.orders")
    kinds = "order_id string, category string, amount decimal(18,2), status string"
    orders_table.create(T.StructType.fromDDL(kinds), comment="Orders as they came")
    _orders(spark, sf_dir).createOrReplaceTempView(f"{database}_source")
    spark.sql(
        f"""INSERT INTO {orders_table.name}
        SELECT concat('O-', o_orderkey), o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)),
          if(o_orderstatus = 'F', 'delivered', 'open')
        FROM {database}_source"""
    )
    totals = CatalogTable(spark, f"{database}.revenue_by_category")
    for turn in range(2):
        counted = orders.revenue_by_category(orders.delivered_orders(orders_table.read()))
        totals.create(counted.schema, comment="Delivered orders per category", tier="gold", replace=turn == 1)
        if turn == 0:
            totals.insert(counted)
            spark.sql(
                f"""INSERT INTO {orders_table.name} (order_id, category, amount, status) VALUES
                ('ORD-001', 'Electronics', 1200.00, 'delivered'), ('ORD-002', 'Food', 45.50, 'cancelled'),
                ('ORD-003', 'Electronics', 780.00, 'delivered'), ('ORD-004', '1-URGENT', 0.25, 'delivered')"""
            )
        else:
            counted.createOrReplaceTempView(f"{database}_counted")
            spark.sql(f"INSERT INTO {totals.name} BY NAME SELECT * FROM {database}_counted")
    for view in ("source", "counted"):
        spark.catalog.dropTempView(f"{database}_{view}")
    return totals.read()


@query
def table_day_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pickup demand kept as a catalog table by day: a late load changes some days, and only these are
    computed and written again."""
    database = _database(spark)
    rides = stored(_silver(spark, sf_dir), "cleaned")
    late = (F.col("payment_method") == "Cash") & (F.col("event_date") >= F.lit(LATE_FROM))
    silver = CatalogTable(spark, f"{database}.silver").create(rides.schema, ["event_date"], tier="silver")
    silver.insert(rides.filter(~late).hint("rebalance", "event_date"))
    demand = CatalogTable(spark, f"{database}.demand")
    first = gold.PICKUP_DEMAND.build(silver.read())
    demand.create(first.schema, ["event_date"], gold.PICKUP_DEMAND.comment, "gold")
    demand.overwrite_partitions(first)
    arrived = rides.filter(late)
    silver.insert(arrived.hint("rebalance", "event_date"))
    changed, _ = silver.in_partitions(arrived)
    demand.overwrite_partitions(gold.PICKUP_DEMAND.build(changed))
    return demand.read()


# --- stored tables and their refresh -------------------------------------------------


def _zoned(df: DataFrame) -> DataFrame:
    """Times without a zone as times of the session zone, the type of a stored table."""
    plain = [name for name, kind in df.dtypes if kind == NTZ]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in plain})


def _unzoned(df: DataFrame) -> DataFrame:
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast(NTZ) for name in zoned})


def _load(warehouse: Warehouse, rides: DataFrame, names: list[str], batch_id: int) -> None:
    """Adds cleaned rides to the stored silver table and to the roll-ups of the named tables."""
    append(rides.hint("rebalance", "event_date"), warehouse.silver, "event_date")
    for root in {gold.GOLD_TABLES[name].source.root for name in names}:
        warehouse.add_rides(root, rides, batch_id)


def _loaded_twice(
    spark: SparkSession, sf_dir: str, names: list[str], mode: str | None = None
) -> Warehouse:
    """Stored tables refreshed after a first load and again after a late one."""
    warehouse = Warehouse(spark, scratch_path(spark, "refresh")).create()
    rides = stored(_zoned(_silver(spark, sf_dir)), "cleaned")
    late = (F.col("payment_method") == "Cash") & (F.col("event_date") >= F.lit(LATE_FROM))
    _load(warehouse, rides.filter(~late), names, 0)
    refresh(warehouse, names, "full", AS_OF)
    _load(warehouse, rides.filter(late), names, 1)
    refresh(warehouse, names, mode, AS_OF)
    return warehouse


@query
def refresh_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _loaded_twice(spark, sf_dir, ["gold_rides_by_city"], "full")
    return warehouse.read_gold("gold_rides_by_city")


@query
def refresh_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _loaded_twice(spark, sf_dir, ["gold_pickup_demand"], "partitions")
    return warehouse.read_gold("gold_pickup_demand")


@query
def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _loaded_twice(spark, sf_dir, ["gold_live_kpis"], "incremental")
    return _unzoned(warehouse.read_gold("gold_live_kpis"))


#: Clocks of the sliding window: at a minute's start, inside one, and just after midnight.
CLOCKS = ("2024-01-30 12:00:00", "2024-01-29 18:20:30.25", "2024-01-20 00:10:59")


@query
def revenue_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hour's revenue at several clocks, as sums of stored minutes and the window's first one."""
    table = gold.REVENUE_PER_MINUTE
    warehouse = Warehouse(spark, scratch_path(spark, "refresh")).create()
    rides = stored(_zoned(_silver(spark, sf_dir)), "cleaned")
    late = F.coalesce(F.col("payment_method") == "Cash", F.lit(False))
    _load(warehouse, rides.filter(~late), [table.name], 0)
    _load(warehouse, rides.filter(late), [table.name], 1)
    seen = []
    for at in CLOCKS:
        (outcome,) = refresh(warehouse, [table.name], as_of=at)
        rows = stored(warehouse.store(table).read(), "minutes")
        seen.append(rows.withColumns({"clock": F.lit(at), "mode": F.lit(outcome.action)}))
    return _unzoned(reduce(DataFrame.unionByName, seen))


@query
def refresh_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second refresh with nothing new leaves the one stored version as it is."""
    name = "gold_ride_status_breakdown"
    warehouse = Warehouse(spark, scratch_path(spark, "refresh")).create()
    _load(warehouse, stored(_zoned(_silver(spark, sf_dir)), "cleaned"), [name], 0)
    refresh(warehouse, [name])
    (second,) = refresh(warehouse, [name])
    versions = len(warehouse.store(gold.GOLD_TABLES[name]).versions())
    return warehouse.read_gold(name).withColumns(
        {"versions": F.lit(versions), "second_refresh": F.lit(second.action)}
    )


@query
def refresh_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables brought up to date by one call, after a first and a late load."""
    names = list(gold.GOLD_TABLES)
    warehouse = _loaded_twice(spark, sf_dir, names)
    sums = []
    for name, (counted, money) in CHECKED.items():
        table = warehouse.store(gold.GOLD_TABLES[name]).read()
        paise = F.sum(F.round(F.col(money) * 100).cast("bigint")) if money else F.lit(0)
        sums.append(
            table.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("rows"),
                F.sum(counted).cast("bigint").alias("counted"),
                paise.cast("bigint").alias("paise"),
            )
        )
    return reduce(DataFrame.unionByName, sums)


def _placed(frame: DataFrame) -> DataFrame:
    """Each row with its place in the order it is read in; for tables of few rows."""
    return frame.coalesce(1).withColumn("place", F.monotonically_increasing_id())


@query
def ordered_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored status counts in the order they are meant to be read in: falling."""
    warehouse = Warehouse(spark, scratch_path(spark, "refresh")).create()
    name = "gold_ride_status_breakdown"
    _load(warehouse, stored(_zoned(_silver(spark, sf_dir)), "cleaned"), [name], 0)
    refresh(warehouse, [name])
    return _placed(warehouse.read_gold(name))


@query
def ordered_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per minute in rising order."""
    table = gold.REVENUE_PER_MINUTE
    return _placed(table.in_order(table.build(_silver(spark, sf_dir), AS_OF)))


def _view_twice(spark: SparkSession, sf_dir: str, mode: str) -> tuple[Warehouse, list[str]]:
    """The category view after a first batch of orders and after a second one."""
    warehouse = Warehouse(spark, scratch_path(spark, "view")).create()
    view = VIEWS["revenue_by_category"]
    table = _orders(spark, sf_dir).select(
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "delivered").otherwise("open").alias("status"),
        (F.col("o_orderdate") >= ORDERS_KNOWN_UNTIL).alias("newer"),
    )
    actions = []
    for batch_id, newer in enumerate((False, True)):
        rows = table.filter(F.col("newer") == newer).drop("newer")
        view.add_rows(spark, warehouse.base, rows, batch_id)
        (outcome,) = refresh(warehouse, [view.name], mode)
        actions.append(outcome.action)
    return warehouse, actions


def _view_rows(warehouse: Warehouse) -> DataFrame:
    return VIEWS["revenue_by_category"].read(warehouse.spark, warehouse.base)


@query
def view_refresh_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view_rows(_view_twice(spark, sf_dir, "full")[0])


@query
def view_refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view_rows(_view_twice(spark, sf_dir, "incremental")[0])


@query
def view_refresh_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third refresh without new orders leaves the two stored versions as they are."""
    warehouse, _ = _view_twice(spark, sf_dir, "incremental")
    (third,) = refresh(warehouse, ["revenue_by_category"])
    versions = VIEWS["revenue_by_category"].store(spark, warehouse.base).versions()
    return _view_rows(warehouse).withColumns(
        {"versions": F.lit(len(versions)), "third_refresh": F.lit(third.action)}
    )


# --- fares and peak hours ------------------------------------------------------------


@query
def fare_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_fares(rides_view(spark, sf_dir))


@query
def peak_hour_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak by the time as shown, and by Indian time if the time shown is UTC."""
    time = F.col("event_time")
    return rides_view(spark, sf_dir).select(
        "ride_id",
        "event_time",
        is_peak(time).alias("is_peak_local"),
        is_peak(time, "Asia/Kolkata", source_zone="UTC").alias("is_peak_india"),
    )


# --- dashboard -----------------------------------------------------------------------


def _dash(view: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: view(*[QUERIES[name](spark, sf_dir) for name in tables])


QUERIES["dash_kpis"] = _dash(dashboard.kpis, "live_kpis", "status_breakdown")
QUERIES["dash_kpis_today"] = _dash(
    lambda kpis, statuses: dashboard.kpis(kpis, statuses, AS_OF), "live_kpis", "status_breakdown"
)
QUERIES["dash_revenue"] = _dash(dashboard.revenue, "revenue_per_minute")
QUERIES["dash_status"] = _dash(dashboard.statuses, "status_breakdown")
QUERIES["dash_status_summed"] = _dash(dashboard.statuses_summed, "status_breakdown")
QUERIES["dash_cities"] = _dash(dashboard.cities, "rides_by_city")
QUERIES["dash_zones"] = _dash(dashboard.zones, "top_zones")
QUERIES["dash_cancel_reasons"] = _dash(dashboard.cancel_reasons, "cancellation_analysis")
QUERIES["dash_pickup"] = _dash(dashboard.pickups, "pickup_demand")


def _sql_dash(name: str, as_of: str | None = None) -> Query:
    """A dataset's SQL text, over aggregate tables that are offered as views under names of its own."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefix = f"kerbline_{uuid.uuid4().hex}_"
        needed = dashboard.DATASETS[name][1]
        silver = _silver(spark, sf_dir)
        for table in needed:
            gold.GOLD_TABLES[table].build(silver, AS_OF).createOrReplaceTempView(f"{prefix}{table}")
        found = dashboard_sql.dataset(spark, name, as_of, prefix)
        for table in needed:
            spark.catalog.dropTempView(f"{prefix}{table}")
        return found

    return run


for _name in dashboard_sql.DATASETS:
    QUERIES[f"sql_{_name}"] = _sql_dash(_name)
QUERIES["sql_ds_kpis_today"] = _sql_dash("ds_kpis", AS_OF)


# --- streams -------------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The rides as JSON lines in a new landing folder."""
    warehouse = Warehouse(spark, scratch_path(spark, "stream")).create()
    write_landing(rides_view(spark, sf_dir), warehouse.landing)
    return warehouse


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _landed(spark, sf_dir)
    flows.await_all([flows.start_bronze(warehouse)])
    flows.await_all([flows.start_silver(warehouse, gather_days=True)])
    return _unzoned(warehouse.read_silver().drop("_ingest_time"))


@query
def landing_from_setting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides landed in the folder that the session's setting names, taken into bronze in two runs: each run
    stamps its rides with one time of ingest, not before it began."""
    warehouse = Warehouse(spark, scratch_path(spark, "stream")).create()
    rides = rides_view(spark, sf_dir)
    late = F.coalesce(F.col("payment_method") == "Cash", F.lit(False))
    kept = spark.conf.get(LANDING_SETTING, None)
    spark.conf.set(LANDING_SETTING, f"{warehouse.base}/elsewhere")
    began = []
    try:
        for part in (~late, late):
            began.append(spark.range(1).select(F.current_timestamp()).first()[0])
            write_landing(rides.filter(part), f"{warehouse.base}/elsewhere")
            flows.await_all([flows.start_bronze(warehouse)])
    finally:
        spark.conf.unset(LANDING_SETTING) if kept is None else spark.conf.set(LANDING_SETTING, kept)
    run = F.when(F.col(INGEST_TIME) >= F.lit(began[1]), 2).when(F.col(INGEST_TIME) >= F.lit(began[0]), 1)
    by_run = warehouse.read_bronze().groupBy(run.alias("run"))
    return by_run.agg(F.count("*").alias("rides"), F.count_distinct(INGEST_TIME).alias("stamps"))


@query
def stream_failing_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning by batch into a path that a file is in the way of: the failure is raised, and the batch
    is taken again once the file is gone."""
    warehouse = _landed(spark, sf_dir)
    target = f"{warehouse.base}/silver_by_batch"
    flows.await_all([flows.start_bronze(warehouse)])
    files.write_text(spark, target, "in the way")
    try:
        flows.await_all([flows.start_silver_by_batch(warehouse, target)])
        raised = False
    except StreamingQueryException:
        raised = True
    files.remove(spark, target)
    flows.await_all([flows.start_silver_by_batch(warehouse, target)])
    rides = spark.read.parquet(target).groupBy("status").agg(F.count("*").alias("rides"))
    return rides.withColumn("raised", F.lit(raised))


@query
def stream_table_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver as catalog tables that streams write and read by name, in two runs."""
    warehouse = Warehouse(spark, scratch_path(spark, "stream")).create()
    tables = StreamTables(spark, f"kerbline_{uuid.uuid4().hex}", f"{warehouse.base}/checkpoints").create()
    rides = rides_view(spark, sf_dir)
    late = F.coalesce(F.col("payment_method") == "Cash", F.lit(False))
    for part in (~late, late):
        write_landing(rides.filter(part), warehouse.landing)
        flows.await_all([tables.start_bronze(warehouse.landing)])
        flows.await_all([tables.start_silver(gather_days=True)])
    return _unzoned(spark.table(tables.silver.name).drop("_ingest_time"))


@query
def stream_days_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver by day from four small runs, whose files are then merged: all rides are there once."""
    warehouse = Warehouse(spark, scratch_path(spark, "stream")).create()
    tables = StreamTables(spark, f"kerbline_{uuid.uuid4().hex}", f"{warehouse.base}/checkpoints").create()
    rides = rides_view(spark, sf_dir)
    for part in range(4):
        write_landing(rides.filter(F.pmod(F.xxhash64("ride_id"), F.lit(4)) == part), warehouse.landing)
        flows.await_all([tables.start_bronze(warehouse.landing)])
        flows.await_all([tables.start_days()])
    tables.compact_days(most_files=3)
    return _unzoned(tables.days.read().drop("_ingest_time", "batch_id"))


@query
def stream_silver_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _landed(spark, sf_dir)
    target = f"{warehouse.base}/silver_by_batch"
    flows.await_all([flows.start_bronze(warehouse)])
    flows.await_all([flows.start_silver_by_batch(warehouse, target)])
    return _unzoned(spark.read.parquet(target).drop("_ingest_time", "_batch_id"))


@query
def stream_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule violations as observed while the stream ran."""
    warehouse = _landed(spark, sf_dir)
    flows.run_once(warehouse, tables=["gold_ride_status_breakdown"], as_of=AS_OF)
    return _summed_counts(warehouse)


def _summed_counts(warehouse: Warehouse) -> DataFrame:
    seen = warehouse.spark.read.parquet(warehouse.quality)
    summed = seen.agg(*[F.sum(name).alias(name) for name in ("rows_in", *RIDE_RULES)])
    return summed.unpivot(["rows_in"], list(RIDE_RULES), "rule", "violations")


@query
def continuous_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule violations counted by streams that run at an interval, in several micro-batches, and
    are stopped and started again in between."""
    warehouse = Warehouse(spark, scratch_path(spark, "stream")).create()
    rides = rides_view(spark, sf_dir)
    number = F.col("duration_mins") % 4
    for turn in ((0, 1), (2, 3)):
        running = [
            flows.start_bronze(warehouse, every="200 milliseconds"),
            flows.start_rule_counts(warehouse, every="200 milliseconds", files_per_trigger=2),
        ]
        for part in turn:
            chosen = F.coalesce(number, F.lit(0)) == part
            write_landing(rides.filter(chosen), warehouse.landing)
            for running_query in running:
                running_query.processAllAvailable()
        for running_query in running:
            running_query.stop()
    return _summed_counts(warehouse)


@query
def observed_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule violations counted by the silver stream itself, in several micro-batches, and stored as they are
    reported; streams and listener are stopped and started again in between."""
    warehouse = Warehouse(spark, scratch_path(spark, "stream")).create()
    rides = rides_view(spark, sf_dir)
    number = F.coalesce(F.col("duration_mins") % 4, F.lit(0))
    for turn in ((0, 1), (2, 3)):
        counts = RuleCounts(warehouse).attach()
        running = [
            flows.start_bronze(warehouse, every="200 milliseconds"),
            flows.start_silver(warehouse, every="200 milliseconds", files_per_trigger=2, gather_days=True),
        ]
        for part in turn:
            write_landing(rides.filter(number == part), warehouse.landing)
            for running_query in running:
                running_query.processAllAvailable()
        for running_query in running:
            running_query.stop()
            counts.settle(running_query)
        counts.detach()
    mend(warehouse)
    return _summed_counts(warehouse)


@query
def stream_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _landed(spark, sf_dir)
    flows.run_once(warehouse, tables=["gold_cancellation_analysis"], as_of=AS_OF, gather_days=True)
    return warehouse.read_gold("gold_cancellation_analysis")


@query
def stream_to_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _landed(spark, sf_dir)
    flows.run_once(warehouse, tables=["gold_driver_leaderboard"], as_of=AS_OF, gather_days=True)
    return warehouse.read_gold("gold_driver_leaderboard")
