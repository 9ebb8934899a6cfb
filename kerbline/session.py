"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app: str = "kerbline",
    master: str | None = None,
    time_zone: str = "UTC",
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on and an explicit time zone.

    ``time_zone`` decides the calendar day and hour of every event that carries an
    offset, so it is never left to the machine's default.  ``shuffle_partitions`` is the
    *initial* number; adaptive execution merges small ones, so err on the high side for
    large inputs (input bytes after projection / 128 MB is a fair start).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
