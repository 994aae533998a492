"""Aggregate columns shared by views and queries.

Two shapes: straight aggregates over fact rows, and `*_of` aggregates over subtotals. Queries that
only add up measures take subtotals per surrogate key first, so that the dimension is joined to a few
subtotals and not to every fact row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.features import PROFIT
from freightlens.functions.numbers import mean, percent, ratio, rounded, total


def sales_and_profit() -> list[Column]:
    return [total("sales").alias("total_sales"), total(PROFIT).alias("total_profit")]


def margin_pct(name: str = "profit_margin_pct") -> Column:
    return rounded(percent(F.sum(PROFIT), F.sum("sales"))).alias(name)


def average(column: str, name: str, digits: int = 2) -> Column:
    return rounded(mean(column), digits).alias(name)


def rate_pct(column: str, name: str) -> Column:
    return rounded(mean(column) * 100).alias(name)


def orders() -> Column:
    return F.count_distinct("order_id").alias("total_orders")


def item_rows(name: str = "order_item_rows") -> Column:
    return F.count("*").alias(name)


def order_value(name: str = "average_order_value") -> Column:
    return rounded(ratio(F.sum("sales"), F.count_distinct("order_id"))).alias(name)


def subtotals(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Row count, and sum and non-null count of each column, per key."""
    parts = [part for c in columns for part in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *parts)


def rows_of(name: str = "order_item_rows") -> Column:
    return F.sum("n").alias(name)


def sum_of(column: str) -> Column:
    return F.sum(f"{column}_sum")


def total_of(column: str, name: str) -> Column:
    return rounded(sum_of(column)).alias(name)


def mean_of(column: str) -> Column:
    return ratio(F.sum(f"{column}_sum"), F.sum(f"{column}_n"))


def average_of(column: str, name: str, digits: int = 2) -> Column:
    return rounded(mean_of(column), digits).alias(name)


def rate_of(column: str, name: str) -> Column:
    return rounded(mean_of(column) * 100).alias(name)


def margin_of(name: str = "profit_margin_pct") -> Column:
    return rounded(percent(sum_of(PROFIT), sum_of("sales"))).alias(name)


def sales_and_profit_of() -> list[Column]:
    return [total_of("sales", "total_sales"), total_of(PROFIT, "total_profit")]
