"""Runs the flow as a job: ``python -m kerbline once --base hdfs:///rides``."""

from __future__ import annotations

import argparse

from kerbline import build_session
from kerbline.plans.refresh import MODES, check_modes, refresh
from kerbline.sources.warehouse import Warehouse
from kerbline.streaming import flows


def parser() -> argparse.ArgumentParser:
    arguments = argparse.ArgumentParser(prog="kerbline", description=__doc__)
    arguments.add_argument("action", choices=("once", "continuous", "refresh"))
    arguments.add_argument("--base", required=True, help="folder shared by all executors")
    arguments.add_argument("--landing", help="landing folder, if outside the base")
    arguments.add_argument("--zone", default="UTC", help="time zone of days and hours")
    arguments.add_argument("--as-of", help="fixed clock, e.g. '2024-01-30 12:00:00'")
    arguments.add_argument("--every", default="10 seconds", help="interval of a continuous run")
    arguments.add_argument("--mode", choices=MODES, help="refresh mode")
    arguments.add_argument("--tables", nargs="*", help="aggregate tables; all by default")
    arguments.add_argument("--gather-days", action="store_true", help="for a backlog of many days")
    arguments.add_argument("--archive", help="folder that landed files are moved to once taken")
    arguments.add_argument("--keep", type=int, help="versions kept of each table; all by default")
    arguments.add_argument("--database", help="catalog database that gets the tables afterwards")
    return arguments


def _checked(chosen: argparse.Namespace, arguments: argparse.ArgumentParser) -> None:
    """Refuses options that the action would ignore, and modes that are not exact."""
    if chosen.action == "continuous":
        ignored = {"--mode": chosen.mode, "--tables": chosen.tables, "--as-of": chosen.as_of}
        ignored |= {"--gather-days": chosen.gather_days, "--database": chosen.database}
        for name, value in ignored.items():
            if value:
                arguments.error(f"{name} has no meaning in a continuous run")
    try:
        chosen.tables = chosen.tables or None
        check_modes(chosen.tables, chosen.mode)
    except (KeyError, ValueError) as problem:
        arguments.error(str(problem))


def main(words: list[str] | None = None) -> None:
    arguments = parser()
    chosen = arguments.parse_args(words)
    _checked(chosen, arguments)
    warehouse = Warehouse(build_session(time_zone=chosen.zone), chosen.base).create()
    if chosen.action == "continuous":
        bronze = {"landing": chosen.landing, "archive": chosen.archive}
        flows.await_all(flows.start_all(warehouse, chosen.every, chosen.keep, **bronze))
        return
    if chosen.action == "once":
        outcomes = flows.run_once(
            warehouse,
            chosen.landing,
            chosen.tables,
            chosen.mode,
            chosen.as_of,
            chosen.gather_days,
            keep=chosen.keep,
            archive=chosen.archive,
        )
    else:
        outcomes = refresh(warehouse, chosen.tables, chosen.mode, chosen.as_of, keep=chosen.keep)
    if chosen.database:
        warehouse.offer_database(chosen.database)
    for outcome in outcomes:
        print(outcome.table, outcome.action)


if __name__ == "__main__":
    main()
