"""Revenue by category over an orders table, and its additive state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbline.operators.rollup import Fact, lift, merge_parts, regroup

ORDER_FACTS = (
    Fact("orders", lambda: F.lit(1).cast("bigint")),
    Fact("revenue", lambda: F.col("amount")),
    Fact("priced", lambda: F.col("amount").isNotNull().cast("bigint")),
)


def delivered_orders(
    orders: DataFrame,
    category: Column | str = "category",
    amount: Column | str = "amount",
    counts: Column | str = "status = 'delivered'",
) -> DataFrame:
    """The orders that count, as (category, amount).

    Pass a decimal ``amount`` for money held as double: a sum of doubles depends on the
    order of addition, a sum of decimals does not.
    """
    category = F.col(category) if isinstance(category, str) else category
    amount = F.col(amount) if isinstance(amount, str) else amount
    return orders.filter(counts).select(category.alias("category"), amount.alias("amount"))


def category_state(counted: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    return regroup(lift(counted, ORDER_FACTS, keys), keys, ORDER_FACTS)


def add_state(
    stored: DataFrame, delta: DataFrame, keys: Sequence[str] = ("category",)
) -> DataFrame:
    return merge_parts(stored, delta, keys, ORDER_FACTS)


def shown(state: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    revenue = F.col("revenue")
    if dict(state.dtypes)["revenue"].startswith("decimal"):
        total = revenue.cast("double")
    else:
        total = revenue
    # The division is done on the exact sum; only its result is rounded.
    average = F.round(F.try_divide(revenue, F.col("priced")).cast("double"), 2)
    return state.select(
        *keys,
        F.col("orders").alias("total_orders"),
        total.alias("total_revenue"),
        average.alias("avg_order_value"),
    )


def revenue_by_category(counted: DataFrame, keys: Sequence[str] = ("category",)) -> DataFrame:
    return shown(category_state(counted, keys), keys)


def by_revenue(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("total_revenue"), F.asc("category"))
