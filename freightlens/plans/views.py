"""The business-intelligence views over the star schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.features import PROFIT
from freightlens.functions.numbers import ratio, rounded
from freightlens.operators.distinct import with_distinct_counts
from freightlens.plans.measures import (
    average, average_of, item_rows, margin_of, margin_pct, order_value, orders, rate_of, rate_pct, rows_of,
    sales_and_profit, sales_and_profit_of, subtotals, sum_of,
)
from freightlens.plans.warehouse import Warehouse


def _distinct(df: DataFrame, column: str) -> Column:
    """Global distinct count as a scalar subquery: one pruned column each, instead of expanding every row."""
    return df.agg(F.count_distinct(column)).scalar()


def executive_overview(w: Warehouse) -> DataFrame:
    f = w.fact
    sums = f.agg(
        item_rows("total_order_items"),
        *sales_and_profit(),
        margin_pct("overall_profit_margin_pct"),
        F.sum("sales").alias("_sales"),
        average("order_item_quantity", "average_item_quantity"),
        average("days_for_shipping_real", "average_actual_shipping_days"),
        average("days_for_shipment_scheduled", "average_scheduled_shipping_days"),
        average("shipping_delay_days", "average_shipping_delay_days"),
        rate_pct("is_late_delivery", "late_delivery_rate_pct"),
        rate_pct("is_on_time_delivery", "on_time_delivery_rate_pct"),
        rate_pct("is_loss_item", "loss_item_rate_pct"),
        rate_pct("requires_management_attention", "management_attention_rate_pct"),
    )
    counted = sums.withColumns(
        {
            "total_orders": _distinct(f, "order_id"),
            "total_customers": _distinct(f, "customer_key"),
            "total_products": _distinct(f, "product_key"),
            "total_categories": _distinct(f, "category_key"),
        }
    )
    return counted.select(
        "total_order_items", "total_orders", "total_customers", "total_products", "total_categories",
        "total_sales", "total_profit", "overall_profit_margin_pct",
        rounded(ratio(F.col("_sales"), F.col("total_orders"))).alias("average_order_value"),
        "average_item_quantity", "average_actual_shipping_days", "average_scheduled_shipping_days",
        "average_shipping_delay_days", "late_delivery_rate_pct", "on_time_delivery_rate_pct",
        "loss_item_rate_pct", "management_attention_rate_pct",
    )


MONTH = ["calendar_year", "calendar_month", "month_name", "calendar_year_month"]


def monthly_sales_trend(w: Warehouse) -> DataFrame:
    known = w.fact.where("order_date_key <> 0")
    dated = lambda rows: w.attach(rows, "date", MONTH, on="order_date_key")
    months = dated(subtotals(known, ["order_date_key"], ["sales", PROFIT, "is_late_delivery"])).groupBy(*MONTH).agg(
        rows_of(), *sales_and_profit_of(), margin_of(), rate_of("is_late_delivery", "late_delivery_rate_pct"), sum_of("sales").alias("_sales")
    )
    counts = {"total_orders": "order_id", "total_customers": "customer_key"}
    return _with_order_value(with_distinct_counts(months, known, MONTH, counts, by=["order_date_key"], attach=dated))


def _with_order_value(groups: DataFrame) -> DataFrame:
    value = rounded(ratio(F.col("_sales"), F.col("total_orders"))).alias("average_order_value")
    return groups.select("*", value).drop("_sales")


def category_performance(w: Warehouse) -> DataFrame:
    known = w.fact.where("category_key <> 0")
    per_key = known.groupBy("category_key").agg(
        item_rows(), *sales_and_profit(), margin_pct(),
        average("order_item_discount", "average_discount_amount"),
        average("discount_rate_pct", "average_discount_rate_pct"),
        rate_pct("is_late_delivery", "late_delivery_rate_pct"),
        rate_pct("is_loss_item", "loss_item_rate_pct"),
    )
    counts = {"total_orders": "order_id", "total_customers": "customer_key", "total_products": "product_key"}
    per_key = with_distinct_counts(per_key, known, ["category_key"], counts)
    return w.attach(per_key, "category", ["category_id", "category_name", "department_id", "department_name"])


def product_performance(w: Warehouse) -> DataFrame:
    per_key = (
        w.fact.where("product_key <> 0")
        .groupBy("product_key")
        .agg(
            item_rows(), orders(), F.sum("order_item_quantity").alias("total_quantity"),
            *sales_and_profit(), margin_pct(),
            average("sales", "average_item_sales"),
            average("order_item_discount", "average_discount_amount"),
            rate_pct("is_late_delivery", "late_delivery_rate_pct"),
            rate_pct("is_loss_item", "loss_item_rate_pct"),
        )
    )
    return w.attach(
        per_key, "product",
        ["product_card_id", "product_name", "product_price", "product_status", "product_category_id",
         "category_name", "department_name"],
    )


def customer_performance(w: Warehouse) -> DataFrame:
    per_key = (
        w.fact.where("customer_key <> 0")
        .groupBy("customer_key")
        .agg(
            item_rows(), orders(), F.count_distinct("product_key").alias("distinct_products"),
            *sales_and_profit(), margin_pct(), order_value(),
            rate_pct("is_late_delivery", "late_delivery_rate_pct"),
        )
    )
    return w.attach(
        per_key, "customer",
        ["customer_id", "customer_segment", "customer_city", "customer_state", "customer_country",
         "customer_frequency_segment", "customer_lifetime_sales", "customer_lifetime_profit", "customer_tenure_days"],
    )


def customer_segment_summary(w: Warehouse) -> DataFrame:
    # an order counts once per segment, so the rows are brought down to (customer, order) before the join
    per_order = subtotals(w.fact.where("customer_key <> 0"), ["customer_key", "order_id"], ["sales", PROFIT, "is_late_delivery"])
    return (
        w.attach(per_order, "customer", ["customer_segment"])
        .groupBy("customer_segment")
        .agg(
            F.count_distinct("customer_key").alias("total_customers"),
            orders(),
            *sales_and_profit_of(),
            rounded(ratio(sum_of("sales"), F.count_distinct("customer_key"))).alias("sales_per_customer"),
            rounded(ratio(sum_of("sales"), F.count_distinct("order_id"))).alias("average_order_value"),
            margin_of(),
            rate_of("is_late_delivery", "late_delivery_rate_pct"),
        )
    )


def shipping_mode_performance(w: Warehouse) -> DataFrame:
    per_key = (
        w.fact.where("shipping_mode_key <> 0")
        .groupBy("shipping_mode_key")
        .agg(
            item_rows(), orders(), *sales_and_profit(),
            average("days_for_shipping_real", "average_actual_shipping_days"),
            average("days_for_shipment_scheduled", "average_scheduled_shipping_days"),
            average("shipping_delay_days", "average_delay_days"),
            average("shipping_efficiency_ratio", "average_shipping_efficiency_ratio", 4),
            rate_pct("is_late_delivery", "late_delivery_rate_pct"),
            rate_pct("is_on_time_delivery", "on_time_delivery_rate_pct"),
        )
    )
    return w.attach(per_key, "shipping_mode", ["shipping_mode", "service_level_group", "default_scheduled_days"])


def delivery_status_summary(w: Warehouse) -> DataFrame:
    return w.fact.groupBy("delivery_status", "delivery_performance").agg(
        item_rows(), orders(), *sales_and_profit(),
        average("days_for_shipping_real", "average_actual_shipping_days"),
        average("shipping_delay_days", "average_delay_days"),
        rate_pct("is_late_delivery", "late_delivery_rate_pct"),
        rate_pct("requires_management_attention", "management_attention_rate_pct"),
    )


def geography_performance(w: Warehouse) -> DataFrame:
    per_key = (
        w.fact.where("geography_key <> 0")
        .groupBy("geography_key")
        .agg(
            item_rows(), orders(), F.count_distinct("customer_key").alias("total_customers"),
            *sales_and_profit(), margin_pct(),
            rate_pct("is_late_delivery", "late_delivery_rate_pct"),
            average("shipping_delay_days", "average_delay_days"),
        )
    )
    return w.attach(
        per_key, "geography",
        ["market", "order_region", "order_country", "order_state", "order_city", "latitude", "longitude"],
    )


def market_performance(w: Warehouse) -> DataFrame:
    known = w.fact.where("geography_key <> 0")
    placed = lambda rows: w.attach(rows, "geography", ["market"])
    per_key = subtotals(known, ["geography_key"], ["sales", PROFIT, "is_late_delivery", "shipping_delay_days"])
    markets = placed(per_key).groupBy("market").agg(
        rows_of(), *sales_and_profit_of(), margin_of(), rate_of("is_late_delivery", "late_delivery_rate_pct"),
        average_of("shipping_delay_days", "average_delay_days"), sum_of("sales").alias("_sales"),
    )
    counts = {"total_orders": "order_id", "total_customers": "customer_key"}
    return _with_order_value(with_distinct_counts(markets, known, ["market"], counts, by=["geography_key"], attach=placed))


def profitability_analysis(w: Warehouse) -> DataFrame:
    return w.fact.groupBy("profitability_status", "margin_band", "discount_band").agg(
        item_rows(), orders(), *sales_and_profit(),
        average("profit_margin_pct", "average_profit_margin_pct"),
        average("discount_rate_pct", "average_discount_rate_pct"),
        rate_pct("is_late_delivery", "late_delivery_rate_pct"),
        rate_pct("is_loss_item", "loss_item_rate_pct"),
    )


def operational_risk_summary(w: Warehouse) -> DataFrame:
    return w.fact.groupBy("operational_risk_segment", "requires_management_attention").agg(
        item_rows(), orders(), *sales_and_profit(),
        average("shipping_delay_days", "average_delay_days"),
        average("profit_margin_pct", "average_profit_margin_pct"),
        average("discount_rate_pct", "average_discount_rate_pct"),
    )


def order_summary(w: Warehouse) -> DataFrame:
    """One row per order. Date keys grow with their date, so the dates are looked up after grouping."""
    rows = w.attach(w.fact, "customer", ["customer_id", "customer_segment"])
    rows = w.attach(rows, "shipping_mode", ["shipping_mode"])
    rows = w.attach(rows, "geography", ["market", "order_region", "order_country"])
    highest = [
        "customer_id", "customer_segment", "market", "order_region", "order_country", "shipping_mode",
        "payment_type", "order_status", "delivery_status", "shipping_delay_days", "is_late_delivery",
        "requires_management_attention",
    ]
    per_order = rows.groupBy("order_id").agg(
        F.coalesce(F.min(F.nullif("order_date_key", F.lit(0))), F.lit(0)).alias("_ordered"),
        F.max("shipping_date_key").alias("_shipped"),
        *[F.max(c).alias(c) for c in highest],
        F.max("days_for_shipping_real").alias("actual_shipping_days"),
        F.max("days_for_shipment_scheduled").alias("scheduled_shipping_days"),
        item_rows(),
        F.count_distinct("product_key").alias("distinct_products"),
        F.sum("order_item_quantity").alias("total_quantity"),
        *sales_and_profit(),
        margin_pct(),
    )
    dated = w.attach(per_order, "date", ["full_date"], on="_ordered").withColumnRenamed("full_date", "order_date")
    dated = w.attach(dated, "date", ["full_date"], on="_shipped").withColumnRenamed("full_date", "shipping_date")
    return dated.drop("_ordered", "_shipped")


DETAIL_ORDER_DATE = {
    "full_date": "order_date", "calendar_year": "order_year", "calendar_quarter": "order_quarter",
    "quarter_name": "quarter_name", "calendar_month": "order_month", "month_name": "order_month_name",
    "calendar_year_month": "calendar_year_month", "week_of_year": "week_of_year", "day_name": "order_day_name",
    "is_weekend": "is_weekend_order",
}
DETAIL_MEASURES = [
    "payment_type", "delivery_status", "order_status", "order_item_quantity", "sales", "order_item_total",
    "order_item_product_price", "order_item_discount", "order_item_discount_rate", "discount_pct_calculated",
    "discount_rate_pct", "gross_sales_before_discount", "order_profit", "order_profit_per_order",
    "order_item_profit_ratio", "profit_margin_pct", "profitability_status", "is_profitable_item", "is_loss_item",
    "days_for_shipping_real", "days_for_shipment_scheduled", "shipping_delay_days",
    "absolute_schedule_variance_days", "shipping_efficiency_ratio", "late_delivery_risk", "is_late_delivery",
    "is_on_time_delivery", "delivery_performance", "delivery_delay_severity", "shipping_speed_segment",
    "sales_value_tier", "margin_band", "discount_band", "requires_management_attention",
    "operational_risk_segment", "load_batch_id", "loaded_at",
]
DETAIL_ATTRIBUTES = {
    "customer": ["customer_id", "customer_segment", "customer_city", "customer_state", "customer_country",
                 "customer_frequency_segment"],
    "product": ["product_card_id", "product_name", "product_price", "product_status"],
    "category": ["category_id", "category_name", "department_id", "department_name"],
    "shipping_mode": ["shipping_mode", "service_level_group"],
    "geography": ["market", "order_region", "order_country", "order_state", "order_city", "latitude", "longitude"],
}


def order_item_detail(w: Warehouse) -> DataFrame:
    """The star flattened to one wide row per order item.

    Where a dimension is too large to be broadcast, members are attached to the keys alone, and the measures come to them in one move.
    """
    keys = ["customer_key", "product_key", "category_key", "order_date_key", "shipping_date_key", "shipping_mode_key", "geography_key"]
    measures = ["fact_order_item_key", "order_item_id", "order_id", *DETAIL_MEASURES]
    apart = not all(w.fits(name, columns) for name, columns in DETAIL_ATTRIBUTES.items())
    rows = w.fact.select(F.col("staging_row_id").alias("_row"), *keys) if apart else w.fact.select(*measures, *keys)
    rows = w.attach(rows, "date", list(DETAIL_ORDER_DATE), on="order_date_key").withColumnsRenamed(DETAIL_ORDER_DATE)
    rows = w.attach(rows, "date", ["full_date"], on="shipping_date_key").withColumnRenamed("full_date", "shipping_date")
    for name, columns in DETAIL_ATTRIBUTES.items():
        rows = w.attach(rows, name, columns)
    if apart:
        rows = w.fact.select("staging_row_id", *measures).join(rows.hint("merge"), F.col("staging_row_id") == F.col("_row"))
    attributes = [c for columns in DETAIL_ATTRIBUTES.values() for c in columns]
    return rows.select(
        "fact_order_item_key", "order_item_id", "order_id", *DETAIL_ORDER_DATE.values(), "shipping_date",
        *attributes, *DETAIL_MEASURES,
    )


VIEWS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "vw_executive_overview": executive_overview,
    "vw_monthly_sales_trend": monthly_sales_trend,
    "vw_category_performance": category_performance,
    "vw_product_performance": product_performance,
    "vw_customer_performance": customer_performance,
    "vw_customer_segment_summary": customer_segment_summary,
    "vw_shipping_mode_performance": shipping_mode_performance,
    "vw_delivery_status_summary": delivery_status_summary,
    "vw_geography_performance": geography_performance,
    "vw_market_performance": market_performance,
    "vw_profitability_analysis": profitability_analysis,
    "vw_operational_risk_summary": operational_risk_summary,
    "vw_order_summary": order_summary,
    "vw_tableau_order_item_detail": order_item_detail,
}


def register_views(w: Warehouse) -> None:
    """Expose the star tables and the views to `spark.sql`."""
    w.fact.createOrReplaceTempView("fact_order_item")
    w.staging.createOrReplaceTempView("stg_supply_chain")
    for name, dim in w.dims.items():
        dim.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(w).createOrReplaceTempView(name)


# Views whose sizes are reported after a build.
COUNTED = [
    "vw_executive_overview", "vw_monthly_sales_trend", "vw_category_performance", "vw_product_performance",
    "vw_customer_performance", "vw_shipping_mode_performance", "vw_geography_performance", "vw_order_summary",
    "vw_tableau_order_item_detail",
]


def view_row_counts(w: Warehouse) -> DataFrame:
    counts = [
        VIEWS[name](w).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("view_name"), "row_count")
        for name in COUNTED
    ]
    return reduce(DataFrame.unionByName, counts)


def first_months(w: Warehouse, n: int = 24) -> DataFrame:
    return monthly_sales_trend(w).orderBy("calendar_year", "calendar_month").limit(n)


def leading_categories(w: Warehouse, n: int = 10) -> DataFrame:
    return category_performance(w).orderBy(F.desc("total_sales"), "category_key").limit(n)


def modes_by_late_rate(w: Warehouse) -> DataFrame:
    return shipping_mode_performance(w).orderBy(F.desc("late_delivery_rate_pct"), "shipping_mode_key")


def view_samples(w: Warehouse) -> DataFrame:
    """The three sample reports in one frame: report, member, sales, late rate."""
    parts = [
        ("months", first_months(w), "calendar_year_month"),
        ("categories", leading_categories(w), "category_name"),
        ("shipping_modes", modes_by_late_rate(w), "shipping_mode"),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(report).alias("report"), F.col(member).alias("member"), "total_sales", "late_delivery_rate_pct")
            for report, df, member in parts
        ],
    )


def category_mean_margin(w: Warehouse) -> DataFrame:
    """Sales, profit and mean item margin per category name."""
    per_key = subtotals(w.fact, ["category_key"], ["sales", PROFIT, "profit_margin_pct"])
    return (
        w.attach(per_key, "category", ["category_name"])
        .groupBy("category_name")
        .agg(
            sum_of("sales").alias("total_sales"),
            sum_of(PROFIT).alias("total_profit"),
            average_of("profit_margin_pct", "average_profit_margin_pct", 4),
        )
        .orderBy(F.desc("total_sales"), "category_name")
    )
