"""The landing folder: JSON lines with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.schema import INGEST_TIME, RESCUED, RIDE_SCHEMA

LANDING_SETTING = "landing_volume_path"


def landing_path(spark: SparkSession, path: str | None = None, default: str | None = None) -> str:
    """An explicit path, else the session setting, else the caller's default."""
    found = path or spark.conf.get(LANDING_SETTING, default)
    if not found:
        raise ValueError(f"no landing path: pass one or set {LANDING_SETTING}")
    return found


def _with_rescue(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines of JSON as rows.  What a line has beyond the schema's fields is kept in the rescue
    column, as JSON; a line that does not parse, or has a wrong type, is kept there as it is."""
    options = {"columnNameOfCorruptRecord": RESCUED}
    fields = F.from_json("value", _with_rescue(schema), options)
    rows = lines.filter(F.length(F.trim("value")) > 0).select("value", fields.alias("fields"))
    known = F.array(*map(F.lit, schema.fieldNames()))
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    unknown = F.map_filter(
        F.from_json("value", "map<string, string>"), lambda name, _: ~F.array_contains(known, name)
    )
    # Only a line with other fields is parsed a second time.
    extra = F.when(F.size(F.array_except(keys, known)) > 0, F.to_json(unknown))
    rescued = F.coalesce(F.col(f"fields.{RESCUED}"), extra)
    return rows.select(
        *[F.col(f"fields.{name}").alias(name) for name in schema.fieldNames()],
        rescued.alias(RESCUED),
        F.current_timestamp().alias(INGEST_TIME),
    )


def read_landing(spark: SparkSession, path: str, schema: T.StructType = RIDE_SCHEMA) -> DataFrame:
    """All landed files, once."""
    return _parsed(spark.read.text(path), schema)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RIDE_SCHEMA,
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Landed files as they arrive.  The checkpoint of the query that reads this remembers
    which files were taken; the two limits bound one micro-batch of a large backlog.  With
    ``archive`` taken files are moved there, so that listing the folder stays cheap."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _parsed(reader.text(path), schema)


def write_landing(rides: DataFrame, path: str, mode: str = "append") -> None:
    """Rides as landing files, one JSON object per line; times are written without offset
    when they carry none."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RIDE_SCHEMA.fields]
    rides.select(*typed).write.mode(mode).json(path)
