"""Dictionary, validation and summary of the engineered features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.numbers import percent, rounded
from freightlens.operators.cleaning import metric_rows

DESCRIPTIONS = {
    "order_year_month": "Calendar month of the order.",
    "is_weekend_order": "1 if ordered on a Saturday or Sunday.",
    "shipping_delay_days": "Shipping days beyond the schedule.",
    "absolute_schedule_variance_days": "Distance from the schedule in days.",
    "is_on_time_delivery": "1 if shipped on or ahead of schedule.",
    "is_late_delivery": "1 if shipping took longer than scheduled.",
    "shipping_efficiency_ratio": "Shipping days per scheduled day.",
    "delivery_delay_severity": "Delay class.",
    "shipping_speed_segment": "Class of shipping days.",
    "gross_sales_before_discount": "Sales with the discount added back.",
    "discount_pct_calculated": "Discount in percent of gross sales.",
    "discount_rate_pct": "Discount rate in percent.",
    "profit_margin_pct": "Profit in percent of sales.",
    "profitability_status": "Profit, loss or break even.",
    "sales_value_tier": "Quartile of item sales.",
    "margin_band": "Class of profit margin.",
    "discount_band": "Class of discount rate.",
    "order_total_sales": "Sales of the whole order.",
    "order_total_profit": "Profit of the whole order.",
    "order_total_quantity": "Units in the whole order.",
    "order_item_count": "Items in the order.",
    "order_profit_margin_pct": "Order profit in percent of order sales.",
    "customer_order_count": "Orders of the customer.",
    "customer_lifetime_sales": "Sales to the customer so far.",
    "customer_lifetime_profit": "Profit from the customer so far.",
    "customer_tenure_days": "Days between first and last order.",
    "customer_frequency_segment": "Class of order count.",
    "requires_management_attention": "1 if late or at a loss.",
    "operational_risk_segment": "Lateness and loss combined.",
}


def dictionary(ready: DataFrame) -> DataFrame:
    """(feature_name, data_type, description, missing_count, missing_pct), from one aggregate."""
    kinds = dict(ready.dtypes)
    present = [c for c in DESCRIPTIONS if c in kinds]
    counts = ready.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in present])
    rows = [
        F.struct(
            F.lit(c).alias("feature_name"), F.lit(kinds[c]).alias("data_type"), F.lit(DESCRIPTIONS[c]).alias("description"),
            (F.col("n") - F.col(c)).alias("missing_count"),
        )
        for c in present
    ]
    listed = counts.select("n", F.explode(F.array(*rows)).alias("r")).select("n", "r.*")
    share = rounded(percent(F.col("missing_count"), F.col("n")), 4).alias("missing_pct")
    return listed.select("feature_name", "data_type", "description", "missing_count", share)


def validation(before: DataFrame, after: DataFrame) -> DataFrame:
    """(check, status, observed, expected) of six checks that featuring left the rows intact."""
    key = F.col("order_item_id")
    delay = F.col("days_for_shipping_real") - F.col("days_for_shipment_scheduled")
    count = lambda fails: F.coalesce(F.sum(fails.cast("int")), F.lit(0))
    counts = after.agg(
        F.count("*").alias("rows"),
        (F.count("*") - F.count(key)).alias("missing"),
        # copies beyond the first; NULL is a key like any other
        (F.count("*") - F.count_distinct(key) - F.coalesce(F.max(key.isNull().cast("int")), F.lit(0))).alias("repeated"),
        count(F.col("shipping_delay_days") != delay).alias("delay"),
        count(~F.coalesce(F.col("is_late_delivery").isin(0, 1), F.lit(False))).alias("flag"),
        count(F.abs(F.col("profit_margin_pct").cast("double")) == float("inf")).alias("infinite"),
    ).withColumn("input", before.agg(F.count("*")).scalar())
    checks: list[tuple[str, str, Column]] = [
        ("Row count preserved", "rows", F.col("input")),
        ("Order item ID has no missing values", "missing", F.lit(0)),
        ("Order item ID is unique", "repeated", F.lit(0)),
        ("Shipping delay formula is consistent", "delay", F.lit(0)),
        ("Late-delivery flag is binary", "flag", F.lit(0)),
        ("Profit margin contains no infinity", "infinite", F.lit(0)),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.when(F.col(c) == expected, "PASS").otherwise("FAIL").alias("status"),
            F.col(c).cast("bigint").alias("observed"),
            expected.cast("bigint").alias("expected"),
        )
        for name, c, expected in checks
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def summary(before: DataFrame, after: DataFrame) -> DataFrame:
    checks = validation(before, after).agg(
        F.count("*").alias("checks"), F.coalesce(F.sum((F.col("status") == "PASS").cast("int")), F.lit(0)).alias("passed")
    )
    counted = checks.withColumns(
        {"input": before.agg(F.count("*")).scalar(), "output": after.agg(F.count("*")).scalar()}
    )
    return metric_rows(
        counted,
        {
            "input_rows": F.col("input"),
            "output_rows": F.col("output"),
            "input_columns": F.lit(len(before.columns)),
            "output_columns": F.lit(len(after.columns)),
            "engineered_features_documented": F.lit(len([c for c in DESCRIPTIONS if c in after.columns])),
            "validation_checks": F.col("checks"),
            "validation_checks_passed": F.col("passed"),
        },
    )
