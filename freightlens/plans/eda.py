"""Exploratory tables over analytics-ready items."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.features import PROFIT
from freightlens.functions.numbers import mean, percent, ratio, rounded
from freightlens.operators.cleaning import metric_rows
from freightlens.operators.distinct import with_distinct_counts

# Dimensions and columns the tables are made for.
MARKET_DIMENSIONS = ["market", "order_region", "order_country"]
PRODUCT_DIMENSIONS = ["category_name", "product_name", "department_name"]
PLACE_DIMENSIONS = ["order_country", "order_state", "order_city"]
LOSS_DIMENSIONS = ["category_name", "product_name", "market", "order_region", "shipping_mode", "customer_segment"]
CUSTOMER_DIMENSIONS = ["customer_segment", "customer_frequency_segment"]
SCATTER = [
    "sales", PROFIT, "profit_margin_pct", "discount_rate_pct", "order_item_discount_rate", "order_item_discount",
    "category_name", "market",
]
CORRELATED = [
    "sales", PROFIT, "profit_margin_pct", "order_item_discount", "discount_rate_pct", "order_item_product_price",
    "order_item_quantity", "days_for_shipping_real", "days_for_shipment_scheduled", "shipping_delay_days",
    "is_late_delivery",
]
NO_SPREAD = 1e-12  # of a column's mean: a standard deviation below it is none
OUTLIER_COLUMNS = [
    "sales", PROFIT, "order_item_discount", "profit_margin_pct", "days_for_shipping_real", "shipping_delay_days",
]


def _zero_sum(column: str) -> Column:
    """A sum that is 0 and not NULL when there is nothing to add."""
    return F.coalesce(F.sum(column), F.lit(0))


def _totals() -> list[Column]:
    return [_zero_sum("sales").alias("total_sales"), _zero_sum(PROFIT).alias("total_profit")]


def _margin() -> Column:
    return rounded(percent(F.col("total_profit"), F.col("total_sales")), 4).alias("profit_margin_pct")


def _share(part: Column, whole: Column, name: str) -> Column:
    return rounded(percent(part, whole), 4).alias(name)


def top(df: DataFrame, dimension: str, n: int = 10) -> DataFrame:
    """The n members with most sales, with profit, orders and margin. Rows without a member form one."""
    groups = df.groupBy(dimension).agg(*_totals(), F.count_distinct("order_id").alias("orders"))
    return groups.select("*", _margin()).orderBy(F.desc("total_sales"), F.asc_nulls_first(dimension)).limit(n)


def _stacked(dimensions: Sequence[str], table: Callable[[str], DataFrame]) -> DataFrame:
    """One frame of the tables per dimension, with (dimension, member) in front."""
    parts = []
    for d in dimensions:
        one = table(d)
        parts.append(one.select(F.lit(d).alias("dimension"), F.col(d).alias("member"), *[c for c in one.columns if c != d]))
    return reduce(DataFrame.unionByName, parts)


def top_tables(df: DataFrame, dimensions: Sequence[str], n: int = 15) -> DataFrame:
    return _stacked(dimensions, lambda d: top(df, d, n))


def kpis(df: DataFrame) -> DataFrame:
    sums = df.agg(*_totals(), F.count("*").alias("rows"), mean("is_late_delivery").alias("late"))
    sums = sums.withColumns(
        {
            "orders": df.agg(F.count_distinct("order_id")).scalar(),
            "customers": df.agg(F.count_distinct("customer_id")).scalar(),
        }
    )
    sales, profit = F.col("total_sales"), F.col("total_profit")
    return metric_rows(
        sums,
        {
            "Total Sales": sales,
            "Total Profit": profit,
            "Profit Margin": rounded(percent(profit, sales), 4),
            "Distinct Orders": F.col("orders"),
            "Distinct Customers": F.col("customers"),
            "Order Item Rows": F.col("rows"),
            "Average Order Value": rounded(ratio(sales, F.col("orders")), 4),
            "Late Delivery Rate": rounded(F.col("late") * 100, 4),
        },
        name="KPI",
        value="Value",
    )


def monthly(df: DataFrame) -> DataFrame:
    dated = df.where("order_date is not null")
    return (
        dated.groupBy(F.date_format("order_date", "yyyy-MM").alias("order_month"))
        .agg(*_totals(), F.count_distinct("order_id").alias("orders"))
        .orderBy("order_month")
    )


def market_tables(df: DataFrame) -> DataFrame:
    return top_tables(df, MARKET_DIMENSIONS)


def product_tables(df: DataFrame) -> DataFrame:
    return top_tables(df, PRODUCT_DIMENSIONS)


def geo_tables(df: DataFrame) -> DataFrame:
    return top_tables(df, PLACE_DIMENSIONS)


def losses(df: DataFrame, dimension: str) -> DataFrame:
    """Every member's sales, profit, rows and loss items, least profit first."""
    groups = df.groupBy(dimension).agg(
        *_totals(),
        F.count("*").alias("item_rows"),
        F.coalesce(F.sum((F.col(PROFIT) < 0).cast("int")), F.lit(0)).alias("loss_items"),
    )
    return groups.select("*", _margin(), _share(F.col("loss_items"), F.col("item_rows"), "loss_item_rate_pct")).orderBy(
        "total_profit", F.asc_nulls_first(dimension)
    )


def loss_tables(df: DataFrame, n: int = 15) -> DataFrame:
    return _stacked(LOSS_DIMENSIONS, lambda d: losses(df, d).limit(n))


def customer_groups(df: DataFrame, dimension: str) -> DataFrame:
    groups = with_distinct_counts(df.groupBy(dimension).agg(*_totals()), df, [dimension], {"customers": "customer_id", "orders": "order_id"})
    per_customer = rounded(ratio(F.col("total_sales"), F.col("customers")), 4).alias("sales_per_customer")
    return groups.select("*", per_customer, _margin()).orderBy(F.desc("total_sales"), F.asc_nulls_first(dimension))


def customer_tables(df: DataFrame) -> DataFrame:
    return _stacked(CUSTOMER_DIMENSIONS, lambda d: customer_groups(df, d))


def shipping_modes(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("shipping_mode")
        .agg(
            F.count("*").alias("item_rows"),
            *_totals(),
            rounded(mean("days_for_shipping_real"), 4).alias("avg_actual_shipping_days"),
            rounded(mean("shipping_delay_days"), 4).alias("avg_delay_days"),
            rounded(mean("is_late_delivery") * 100, 4).alias("late_delivery_rate_pct"),
        )
        .orderBy(F.desc("late_delivery_rate_pct"), "shipping_mode")
    )


def delivery_statuses(df: DataFrame) -> DataFrame:
    groups = df.groupBy("delivery_status").agg(F.count("*").alias("item_rows"), _zero_sum("sales").alias("total_sales"))
    return groups.orderBy(F.desc("item_rows"), "delivery_status")


def late_pivot(df: DataFrame) -> DataFrame:
    """Late rate per market (rows) and shipping mode (columns)."""
    known = df.where("market is not null and shipping_mode is not null")
    rates = known.groupBy("market", "shipping_mode").agg(rounded(mean("is_late_delivery") * 100).alias("rate"))
    modes = sorted(r[0] for r in rates.select("shipping_mode").distinct().collect())  # column names of the result
    return rates.groupBy("market").pivot("shipping_mode", modes).agg(F.first("rate")).orderBy("market")


def sample(df: DataFrame, n: int = 20_000, seed: int = 42) -> DataFrame:
    """n rows without gaps in the scatter columns; the same seed picks the same rows on any cluster."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("order_item_id")))
    return df.select("order_item_id", *SCATTER).dropna(subset=SCATTER).orderBy(drawn, "order_item_id").limit(n)


def _pair_sums(df: DataFrame, columns: Sequence[str], shift: Sequence[float]) -> DataFrame:
    """(a, b, n, x, xx, xy): per ordered pair of columns the rows that hold both and over them the sums of x, x * x and x * y, the
    values taken less their column's shift. Every task keeps one set of sums and sends a row per pair."""
    k, middle = len(columns), np.array(shift, np.float64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, x, xx, xy = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            values = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], np.float64).T - middle
            there = ~np.isnan(values)
            values, there = np.where(there, values, 0.0), there.astype(np.float64)
            n, x, xx, xy = n + there.T @ there, x + values.T @ there, xx + (values * values).T @ there, xy + values.T @ values
        a, b = np.divmod(np.arange(k * k, dtype=np.int64), k)
        cells = [pa.array(v) for v in (a, b, *(m.ravel() for m in (n, x, xx, xy)))]
        yield pa.RecordBatch.from_arrays(cells, names=["a", "b", "n", "x", "xx", "xy"])

    return df.select(*[F.col(c).cast("double") for c in columns]).mapInArrow(work, "a long, b long, n double, x double, xx double, xy double")


def correlations(df: DataFrame, columns: Sequence[str] = tuple(CORRELATED)) -> DataFrame:
    """Pearson matrix as (column_a, column_b, correlation) over the rows that hold both columns; NULL where one of them does not vary.

    A first aggregate finds the columns' means, from which the sums are taken so that large values with a small spread lose no digits.
    """
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    sums = _pair_sums(df, columns, [means[c] or 0.0 for c in columns])
    total = sums.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "x", "xx", "xy")])
    other = total.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("x").alias("y"), F.col("xx").alias("yy"))
    paired = total.join(other, ["a", "b"])
    n = F.nullif("n", F.lit(0.0))
    spread_x, spread_y = (F.col(f"{c}{c}") - F.col(c) * F.col(c) / n for c in "xy")
    least = F.array(*[F.lit((abs(means[c] or 0.0) * NO_SPREAD) ** 2) for c in columns])  # what rounding leaves of a constant
    varies = (spread_x > n * F.get(least, F.col("a").cast("int"))) & (spread_y > n * F.get(least, F.col("b").cast("int")))
    r = (F.col("xy") - F.col("x") * F.col("y") / n) / F.nullif(F.sqrt(spread_x * spread_y), F.lit(0.0))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))
    names = F.array(*[F.lit(c) for c in columns])
    return paired.select(
        F.get(names, F.col("a").cast("int")).alias("column_a"), F.get(names, F.col("b").cast("int")).alias("column_b"),
        rounded(F.when(varies, r), 6).alias("correlation"),
    )


def geo_points(df: DataFrame, n: int = 5_000) -> DataFrame:
    placed = df.where("latitude is not null and longitude is not null").groupBy("longitude", "latitude")
    points = placed.agg(_zero_sum("sales").alias("total_sales"), F.count("*").alias("item_rows"))
    return points.orderBy(F.desc("total_sales"), "longitude", "latitude").limit(n)


def risk_summary(df: DataFrame) -> DataFrame:
    groups = df.groupBy("operational_risk_segment").agg(F.count("*").alias("item_rows"), *_totals())
    return groups.orderBy(F.desc("item_rows"), "operational_risk_segment")


def priority_categories(df: DataFrame) -> DataFrame:
    groups = df.groupBy("category_name").agg(
        F.count("*").alias("item_rows"), _zero_sum("requires_management_attention").alias("attention_items"), *_totals()
    )
    rate = _share(F.col("attention_items"), F.col("item_rows"), "attention_rate_pct")
    return groups.select("*", rate).orderBy(F.desc("attention_rate_pct"), F.desc("total_sales"), "category_name")


# Finding layout and implication per area, in report order.
INSIGHTS = {
    "Executive": (
        "Total sales are %s with total profit of %s.",
        "Use this as the baseline for executive performance tracking.",
    ),
    "Delivery": (
        "The overall late-delivery rate is %s%%.",
        "Prioritize markets and shipping modes with rates above this baseline.",
    ),
    "Market": (
        "%s is the largest market by sales at %s.",
        "Protect service quality and product availability in this core market.",
    ),
    "Category": (
        "%s is the highest-sales category at %s.",
        "Use the category as a benchmark while checking margin and delivery performance.",
    ),
    "Profitability": (
        "%s has the lowest category profit at %s.",
        "Review pricing, discounting, product mix, and fulfillment cost drivers.",
    ),
}


def _amount(value: Column) -> Column:
    return F.format_number(rounded(value, 2), 2)


def insights(df: DataFrame) -> DataFrame:
    """Up to five sentences filled from the tables above; an area without data is left out."""

    def named(one: DataFrame, member: str, measure: str) -> list[Column]:
        return [one.select(F.coalesce(member, F.lit("nan"))).scalar(), _amount(one.select(measure).scalar())]

    first = df.agg(*_totals(), mean("is_late_delivery").alias("late"))
    values = {
        "Executive": [_amount(F.col("total_sales")), _amount(F.col("total_profit"))],
        "Delivery": [_amount(F.col("late") * 100)],
        "Market": named(top(df, "market", 1), "market", "total_sales"),
        "Category": named(top(df, "category_name", 1), "category_name", "total_sales"),
        "Profitability": named(losses(df, "category_name").limit(1), "category_name", "total_profit"),
    }
    rows = [
        F.struct(
            F.lit(area).alias("analysis_area"),
            F.when(values[area][-1].isNotNull(), F.format_string(layout, *values[area])).alias("finding"),
            F.lit(implication).alias("business_implication"),
        )
        for area, (layout, implication) in INSIGHTS.items()
    ]
    return first.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("finding is not null")
