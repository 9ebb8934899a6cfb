"""Kerbline: trip-booking analytics as plain Spark jobs.

Layout
------
``functions``  column expressions (time parts, fares)
``sources``    landing files, snapshot tables, scratch space, the fixture view
``operators``  DataFrame-to-DataFrame steps (rules, cleaning, roll-ups, ranking, upsert)
``plans``      the aggregate tables, the dashboard queries and the refresh job
``streaming``  ingest and cleaning queries, and one bounded end-to-end run
"""

from kerbline.session import build_session

__all__ = ["build_session"]
