"""Shares, top-k and ranks within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_group(
    df: DataFrame, value: str, group: Sequence[str], name: str, digits: int = 1
) -> DataFrame:
    """``value`` as a percentage of its group's total.

    Meant for aggregated rows with few rows per group (here: one per status, five at
    most), since a window gathers a group in one task.
    """
    total = F.sum(value).over(Window.partitionBy(*group))
    return df.withColumn(name, F.round(F.try_divide(F.col(value) * 100.0, total), digits))


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows in ``order``; each task keeps only its own first ``k``."""
    return df.orderBy(*order).limit(k)


def rank_within(
    df: DataFrame, group: str, by: str, name: str = "rank", step: float = 1000.0
) -> DataFrame:
    """Rank (1 + number of rows in the group with a higher ``by``), exact, for groups of any size.

    A window over the group would sort a whole group in one task.  Here ``by``, a figure
    with two decimals, is cut into bands of width ``step``: a band holds at most
    ``100 * step`` different values whatever the number of rows.  Rows are counted per
    value and per band, the bands above give an offset, and the rank of a *value* is joined
    back to its rows.  Rows with the same value are spread over the join like any others
    (adaptive execution splits a hot one).  Nulls rank last.

    ``df`` is read twice: pass an aggregate or a stored table.
    """
    rows = df
    banded = rows.select(group, by, F.floor(F.col(by) / step).alias("_band"))
    values = banded.groupBy(group, "_band", by).agg(F.count(F.lit(1)).alias("_rows"))
    bands = values.groupBy(group, "_band").agg(F.sum("_rows").alias("_rows"))

    def counted_before(window, order: str) -> Column:
        ordered = window.orderBy(F.col(order).desc_nulls_last())
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(before), F.lit(0))

    offsets = bands.select(
        F.col(group).alias("_g"),
        F.col("_band").alias("_b"),
        counted_before(Window.partitionBy(group), "_band").alias("_above"),
    )
    ranked = values.join(
        offsets, F.col(group).eqNullSafe(F.col("_g")) & F.col("_band").eqNullSafe(F.col("_b"))
    ).select(
        F.col(group).alias("_g"),
        F.col(by).alias("_v"),
        (F.col("_above") + counted_before(Window.partitionBy(group, "_band"), by) + 1)
        .cast("bigint")
        .alias(name),
    )
    matches = F.col(group).eqNullSafe(F.col("_g")) & F.col(by).eqNullSafe(F.col("_v"))
    return rows.join(ranked, matches).drop("_g", "_v")
