"""Upsert of one table into another by key, as one join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _once_per_key(source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The source's rows as ``_row``; fails if a key occurs twice, as the result would then depend on
    chance.  A null key equals nothing, so rows with one are kept apart."""
    is_null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    apart = F.when(is_null, F.monotonically_increasing_id())
    rows = source.select(*keys, apart.alias("_apart"), F.struct(*columns).alias("_row"))
    counted = rows.groupBy(*keys, "_apart").agg(
        F.any_value("_row").alias("_row"), F.count(F.lit(1)).alias("_copies")
    )
    several = F.raise_error(F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*keys))))
    return counted.filter(F.when(F.col("_copies") > 1, several.cast("boolean")).otherwise(F.lit(True)))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], delete_missing: bool = False
) -> DataFrame:
    """Matched keys take the source's values, unknown keys are added.

    Keys the source no longer has stay as they are, unless ``delete_missing`` is set.
    Key comparison is SQL equality: a null key never matches, so it is added anew.  A key that
    occurs twice in the source fails the job.  Either table is read once.
    """
    columns = target.columns
    renewed = _once_per_key(source, keys, columns).select(
        *[F.col(key).alias(f"_{key}") for key in keys], "_row"
    )
    if delete_missing:
        return renewed.select("_row.*")
    matched = reduce(lambda a, b: a & b, [F.col(key) == F.col(f"_{key}") for key in keys])
    both = target.join(renewed, matched, "full")
    taken = F.col("_row").isNotNull()
    return both.select(
        *[F.when(taken, F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
