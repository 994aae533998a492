"""Row-level derived features and the per-order and per-customer totals behind the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.dates import date_key, day_name, month_name, whole_days, year_month
from freightlens.functions.numbers import flag, mean, percent, ratio, rounded

PROFIT = "order_profit_per_order"

# Band edges are inclusive upper limits.
SPEED_BANDS = [(2, "Express"), (4, "Standard"), (6, "Slow"), (None, "Very Slow")]
SEVERITY_BANDS = [(-1, "Early"), (0, "On Schedule"), (1, "1 Day Late"), (3, "2–3 Days Late"), (None, "4+ Days Late")]
MARGIN_BANDS = [(0, "Negative"), (10, "0–10%"), (20, "10–20%"), (30, "20–30%"), (None, "30%+")]
DISCOUNT_BANDS = [(0, "No Discount"), (5, "0–5%"), (10, "5–10%"), (20, "10–20%"), (None, "20%+")]
FREQUENCY_BANDS = [(1, "One-Time"), (2, "Occasional"), (5, "Repeat"), (10, "Loyal"), (None, "VIP")]
SALES_TIERS = ["Low", "Medium", "High", "Premium"]


def band(value: Column, bands: list[tuple[float | None, str]]) -> Column:
    """Label of the first band whose upper limit is not below the value; NULL for NULL."""
    *limited, (_, last) = bands
    choice = F.when(value.isNotNull(), F.lit(last))
    for limit, label in reversed(limited):
        choice = F.when(value <= limit, F.lit(label)).otherwise(choice)
    return choice


def sign_label(value: Column, positive: str, zero: str, negative: str) -> Column:
    return F.when(value > 0, positive).when(value == 0, zero).when(value < 0, negative).otherwise("Unknown")


def add_calendar(df: DataFrame) -> DataFrame:
    ordered, shipped = F.col("order_date"), F.col("shipping_date")
    return df.withColumns(
        {
            "order_year": F.year(ordered),
            "order_quarter_number": F.quarter(ordered),
            "order_quarter": F.concat(F.lit("Q"), F.quarter(ordered).cast("string")),
            "order_month": F.month(ordered),
            "order_month_name": month_name(ordered),
            "order_year_month": year_month(ordered),
            "order_week": F.weekofyear(ordered),
            "order_day": F.dayofmonth(ordered),
            "order_day_name": day_name(ordered),
            "is_weekend_order": F.coalesce(flag(F.weekday(ordered) >= 5), F.lit(0)),
            "order_date_key": date_key(ordered),
            "shipping_year_month": year_month(shipped),
            "shipping_date_key": date_key(shipped),
        }
    )


def add_delay(df: DataFrame) -> DataFrame:
    delay = F.col("days_for_shipping_real") - F.col("days_for_shipment_scheduled")
    return df.withColumns({"shipping_delay_days": delay, "absolute_schedule_variance_days": F.abs(delay)})


def add_delivery_performance(df: DataFrame) -> DataFrame:
    return df.withColumn("delivery_performance", sign_label(F.col("shipping_delay_days"), "Late", "On Schedule", "Early"))


def add_delivery_flags(df: DataFrame) -> DataFrame:
    delay = F.col("shipping_delay_days")
    return df.withColumns({"is_on_time_delivery": flag(delay <= 0), "is_late_delivery": flag(delay > 0)})


def add_efficiency_ratio(df: DataFrame) -> DataFrame:
    real, scheduled = F.col("days_for_shipping_real"), F.col("days_for_shipment_scheduled")
    return df.withColumn("shipping_efficiency_ratio", rounded(F.when(scheduled > 0, ratio(real, scheduled)), 6))


def add_delay_severity(df: DataFrame) -> DataFrame:
    label = band(F.col("shipping_delay_days"), SEVERITY_BANDS)
    return df.withColumn("delivery_delay_severity", F.coalesce(label, F.lit("Unknown")))


def add_speed_segment(df: DataFrame) -> DataFrame:
    label = band(F.col("days_for_shipping_real"), SPEED_BANDS)
    return df.withColumn("shipping_speed_segment", F.coalesce(label, F.lit("Unknown")))


def add_gross_and_discount(df: DataFrame) -> DataFrame:
    gross = F.col("sales") + F.col("order_item_discount")
    share = F.when(gross > 0, percent(F.col("order_item_discount"), gross))
    return df.withColumns({"gross_sales_before_discount": gross, "discount_pct_calculated": rounded(share, 4)})


def add_discount_rate_pct(df: DataFrame) -> DataFrame:
    rate = F.col("order_item_discount_rate")
    return df.withColumn("discount_rate_pct", F.when(F.abs(rate) <= 1, rate * 100).otherwise(rate).cast("decimal(18,6)"))


def margin() -> Column:
    return percent(F.col(PROFIT), F.col("sales"))


def add_margin(df: DataFrame) -> DataFrame:
    return df.withColumn("profit_margin_pct", rounded(margin(), 4))


def add_profitability(df: DataFrame) -> DataFrame:
    profit = F.col(PROFIT)
    return df.withColumns(
        {
            "profitability_status": sign_label(profit, "Profitable", "Break Even", "Loss"),
            "is_profitable_item": F.coalesce(flag(profit > 0), F.lit(0)),
            "is_loss_item": F.coalesce(flag(profit < 0), F.lit(0)),
        }
    )


def add_margin_band(df: DataFrame) -> DataFrame:
    return df.withColumn("margin_band", band(margin(), MARGIN_BANDS))


def add_discount_band(df: DataFrame) -> DataFrame:
    return df.withColumn("discount_band", band(F.col("discount_rate_pct"), DISCOUNT_BANDS))


def add_sales_tier(df: DataFrame, cuts: list[tuple] | None) -> DataFrame:
    """Quartile label from the (sales, order_item_id) pairs that close the first three quartiles."""
    sales, tie = F.col("sales"), F.col("order_item_id")
    label = F.when(sales.isNotNull(), F.lit(SALES_TIERS[-1])) if cuts else F.lit(None).cast("string")
    for (edge, edge_tie), tier in reversed(list(zip(cuts or [], SALES_TIERS))):
        inside = (sales < F.lit(edge)) | ((sales == F.lit(edge)) & (tie <= F.lit(edge_tie)))
        label = F.when(inside, F.lit(tier)).otherwise(label)
    return df.withColumn("sales_value_tier", label)


def order_totals(df: DataFrame) -> DataFrame:
    totals = df.groupBy("order_id").agg(
        F.coalesce(F.sum("sales"), F.lit(0)).cast("decimal(20,4)").alias("order_total_sales"),
        F.coalesce(F.sum(PROFIT), F.lit(0)).cast("decimal(20,4)").alias("order_total_profit"),
        F.coalesce(F.sum("order_item_quantity"), F.lit(0)).cast("int").alias("order_total_quantity"),
        F.count("order_item_id").cast("int").alias("order_item_count"),
    )
    share = rounded(percent(F.col("order_total_profit"), F.col("order_total_sales")), 4)
    return totals.withColumn("order_profit_margin_pct", share.cast("decimal(18,6)"))


def customer_totals(df: DataFrame) -> DataFrame:
    totals = df.groupBy("customer_id").agg(
        F.count_distinct("order_id").cast("int").alias("customer_order_count"),
        F.coalesce(F.sum("sales"), F.lit(0)).cast("decimal(20,4)").alias("customer_lifetime_sales"),
        rounded(mean("sales"), 4).cast("decimal(18,4)").alias("customer_average_item_sales"),
        F.coalesce(F.sum(PROFIT), F.lit(0)).cast("decimal(20,4)").alias("customer_lifetime_profit"),
        F.min("order_date").alias("customer_first_order_date"),
        F.max("order_date").alias("customer_last_order_date"),
    )
    return totals.withColumn(
        "customer_tenure_days", whole_days(F.col("customer_first_order_date"), F.col("customer_last_order_date"))
    )


def add_frequency_segment(df: DataFrame) -> DataFrame:
    orders = F.col("customer_order_count")
    return df.withColumn("customer_frequency_segment", band(F.when(orders > 0, orders), FREQUENCY_BANDS))


def _is(column: str, value: int) -> Column:
    return F.coalesce(F.col(column) == value, F.lit(False))


def add_attention_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("requires_management_attention", flag(_is("is_late_delivery", 1) | _is("is_loss_item", 1)))


def add_risk_segment(df: DataFrame) -> DataFrame:
    late, loss = _is("is_late_delivery", 1), _is("is_loss_item", 1)
    segment = (
        F.when(late & loss, "Late and Loss")
        .when(late & _is("is_loss_item", 0), "Late Only")
        .when(_is("is_late_delivery", 0) & loss, "Loss Only")
        .otherwise("Healthy")
    )
    return df.withColumn("operational_risk_segment", segment)


ROW_FEATURES = [
    add_calendar, add_delay, add_delivery_performance, add_delivery_flags, add_efficiency_ratio, add_delay_severity,
    add_speed_segment, add_gross_and_discount, add_discount_rate_pct, add_margin, add_profitability, add_margin_band,
    add_discount_band, add_attention_flag, add_risk_segment,
]


def add_row_features(df: DataFrame) -> DataFrame:
    for step in ROW_FEATURES:
        df = df.transform(step)
    return df
