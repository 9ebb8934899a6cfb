"""Keeping the aggregate tables fresh.

The caller names a mode:

full         build from all cleaned rides
partitions   build the days that received rides, from the cleaned rides of those days
incremental  build from the stored roll-ups, to which each micro-batch was added

A table whose source has not moved since its last refresh is skipped in every mode.
Modes that would not give exactly the full result for a table are refused.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from kerbline.operators.upsert import upsert
from kerbline.plans.gold import GOLD_TABLES, AsOf, GoldTable, Rollup
from kerbline.plans.views import VIEWS, View
from kerbline.sources import files
from kerbline.sources.scratch import scratch_path
from kerbline.sources.snapshots import Days, StoredTable, on_days
from kerbline.sources.warehouse import Warehouse

MODES = ("full", "partitions", "incremental")


@dataclass(frozen=True)
class Outcome:
    table: str
    action: str  # a mode, or "skipped"
    days: tuple[date | None, ...] | None = None  # rewritten days; None means the whole table


def changed_days(parts: DataFrame) -> list[date | None]:
    """The days that occur in ``parts``: as many as the calendar has, whatever the rows."""
    return [row[0] for row in parts.select("event_date").distinct().collect()]


class _Parts:
    """Roll-ups computed from cleaned rides during one refresh, each written once and then
    shared by the tables that need it.  Different ones are made side by side."""

    def __init__(self, spark: SparkSession, silver: Callable[[], DataFrame]):
        self._spark = spark
        self._silver = silver
        self._made: dict[tuple, Future] = {}
        self._paths: list[str] = []
        self._asking = Lock()

    def rows(self, days: Days | None) -> DataFrame:
        silver = self._silver()
        return silver if days is None else silver.filter(on_days(days))

    def of(self, rollup: Rollup, days: Days | None) -> DataFrame:
        if rollup.parent is not None:
            return rollup.merged(self.of(rollup.parent, days))
        key = (rollup.name, None if days is None else frozenset(days))
        with self._asking:
            first = key not in self._made
            made = self._made.setdefault(key, Future())
        if first:
            try:
                frame = rollup.of(self.rows(days))
                path = scratch_path(self._spark, rollup.name)
                self._paths.append(path)
                frame.write.parquet(path)
                made.set_result(self._spark.read.schema(frame.schema).parquet(path))
            except BaseException as failure:
                made.set_exception(failure)
        return made.result()

    def forget(self) -> None:
        """Removes what was written; the tables made from it are stored by now."""
        for path in self._paths:
            files.remove(self._spark, path)


def default_mode(table: GoldTable | View) -> str:
    return table.modes[-1]


def check_modes(names: Iterable[str] | None, mode: str | None) -> None:
    """Refuses a mode that would not be exact for one of the tables."""
    for name in GOLD_TABLES if names is None else names:
        table = VIEWS.get(name) or GOLD_TABLES[name]
        if mode is not None and mode not in table.modes:
            raise ValueError(f"{name}: mode {mode!r} is not exact; use one of {table.modes}")


def refresh(
    warehouse: Warehouse,
    names: Iterable[str] | None = None,
    mode: str | None = None,
    as_of: AsOf = None,
    at_once: int = 4,
    keep: int | None = None,
) -> list[Outcome]:
    """Brings the named tables (default: all over rides) up to date in one call.

    What is new is told by the roll-up logs, so run the roll-up streams first.  Without ``mode``
    each table uses the cheapest mode declared for it.  Most tables are small, so the jobs of
    ``at_once`` tables are submitted side by side.  Versions are kept for ever unless the
    caller says how many to ``keep``.
    """
    chosen = list(GOLD_TABLES if names is None else names)
    views = [VIEWS[name] for name in chosen if name in VIEWS]
    tables = [GOLD_TABLES[name] for name in chosen if name not in VIEWS]
    check_modes(chosen, mode)
    users = Counter(table.rollup.root.name for table in tables if table.rollup)
    parts = _Parts(warehouse.spark, warehouse.read_silver)

    def bring_up(table: GoldTable | View) -> Outcome:
        chosen_mode = mode or default_mode(table)
        if isinstance(table, View):
            outcome = Outcome(table.name, table.refresh(warehouse.spark, warehouse.base, chosen_mode))
            store = table.store(warehouse.spark, warehouse.base)
        else:
            shared = table.rollup is not None and users[table.rollup.root.name] > 1
            outcome = _refresh_one(warehouse, table, chosen_mode, as_of, parts, shared)
            store = warehouse.store(table)
        if keep is not None:
            store.drop_old(keep)
        return outcome

    try:
        with ThreadPoolExecutor(at_once) as pool:
            return list(pool.map(bring_up, [*tables, *views]))
    finally:
        parts.forget()


def _refresh_one(
    warehouse: Warehouse, table: GoldTable, mode: str, as_of: AsOf, parts: _Parts, shared: bool
) -> Outcome:
    store = warehouse.store(table)
    log = warehouse.rollup(table.source.name)
    source = log.latest()
    # A clocked table is stale when the clock moved; without a fixed clock it always did.
    # Without a roll-up log nothing is known about the source, so nothing is skipped.
    note = {"source": source, "as_of": str(as_of) if table.clocked else None}
    before = store.applied() if store.current() is not None else None
    fixed = not table.clocked or as_of is not None
    if before == note and fixed and source is not None:
        return Outcome(table.name, "skipped")

    days: Days | None = None
    if mode != "full" and table.dated and before is not None and before["source"] is not None:
        days = changed_days(log.since(before["source"]))
    if mode == "incremental":
        state = log.read()
        rides = warehouse.read_silver() if table.edge is not None else None
        result = table.from_rollup(state if days is None else state.filter(on_days(days)), as_of, rides)
    elif shared:
        rides = parts.rows(days) if table.edge is not None else None
        result = table.from_rollup(parts.of(table.rollup, days), as_of, rides)
    else:
        result = table.build(parts.rows(days), as_of)

    if days is None:
        store.replace(result)
    else:
        store.overwrite_days(result, days)
    store.note_applied(note)
    return Outcome(table.name, mode, None if days is None else tuple(days))


def upsert_stored(
    store: StoredTable, source: DataFrame, keys: list[str], delete_missing: bool = False
) -> int:
    """Upserts ``source`` into a stored table and makes the result its next version."""
    return store.replace(upsert(store.read(), source, keys, delete_missing))


def compact(warehouse: Warehouse, rollup: Rollup, keep: int = 2, at_least: int = 1) -> bool:
    """Merges the batches of a roll-up that every table stored from it already reflects, if
    there are ``at_least`` so many not merged yet.  While a table lags behind, nothing is written
    again and again."""
    notes = [
        warehouse.store(table).applied()
        for table in GOLD_TABLES.values()
        if table.source == rollup
    ]
    sources = [note["source"] for note in notes if note and note["source"] is not None]
    if sources:
        log = warehouse.rollup(rollup.name)
        if log.merge_through(min(sources), at_least):
            log.drop_old(keep)
            return True
    return False
