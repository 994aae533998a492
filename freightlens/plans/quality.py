"""Quality checks on the latest staging batch. Each returns one row (or the rows at fault).

Counts are sums of 0/1 and not conditional counts: on no data they are NULL, and a NULL never passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.features import PROFIT, sign_label
from freightlens.functions.numbers import failures, percent
from freightlens.plans.measures import average, margin_pct, rate_pct, sales_and_profit

# Accepted labels.
DELIVERY_PERFORMANCE = ["Late", "On Schedule", "Early", "Unknown"]
PROFITABILITY = ["Profitable", "Break Even", "Loss", "Unknown"]
RISK_SEGMENTS = ["Late and Loss", "Late Only", "Loss Only", "Healthy"]


def _all_zero(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) == 0 for n in names])


def verdict(passed: Column, good: str = "PASS", bad: str = "FAIL") -> Column:
    return F.when(passed, good).otherwise(bad)


def counted_rules(df: DataFrame, rules: dict[str, Column], status: str) -> DataFrame:
    """One row with the number of offending rows per rule and a PASS / FAIL column."""
    counts = df.agg(*[failures(rule).alias(name) for name, rule in rules.items()])
    return counts.withColumn(status, verdict(_all_zero(list(rules))))


def batch_overview(stg: DataFrame) -> DataFrame:
    return stg.agg(
        F.max("load_batch_id").alias("latest_batch_id"),
        F.count("*").alias("latest_batch_rows"),
        F.min("loaded_at").alias("load_started_at"),
        F.max("loaded_at").alias("load_completed_at"),
    )


def _volume() -> list[Column]:
    unique = F.count_distinct("order_item_id")
    return [
        F.count("*").alias("total_rows"),
        unique.alias("unique_order_item_ids"),
        (F.count("*") - unique).alias("duplicate_rows"),
    ]


def volume_and_uniqueness(stg: DataFrame, expected: int) -> DataFrame:
    passed = (F.col("total_rows") == expected) & (F.col("unique_order_item_ids") == expected)
    return stg.agg(*_volume()).withColumn("volume_and_uniqueness_status", verdict(passed))


REQUIRED = {
    "missing_order_item_id": "order_item_id", "missing_order_id": "order_id", "missing_customer_id": "customer_id",
    "missing_product_card_id": "product_card_id", "missing_category_id": "category_id",
    "missing_order_date": "order_date", "missing_shipping_date": "shipping_date", "missing_sales": "sales",
    "missing_quantity": "order_item_quantity",
}


def completeness(stg: DataFrame) -> DataFrame:
    return counted_rules(stg, {name: F.col(c).isNull() for name, c in REQUIRED.items()}, "completeness_status")


def duplicate_keys(stg: DataFrame, n: int = 100) -> DataFrame:
    repeated = stg.groupBy("order_item_id").agg(F.count("*").alias("duplicate_count")).where("duplicate_count > 1")
    return repeated.orderBy(F.desc("duplicate_count"), "order_item_id").limit(n)


def dates(stg: DataFrame) -> DataFrame:
    counts = stg.agg(
        F.count("*").alias("_rows"),
        F.count("order_date").alias("valid_order_dates"),
        F.count("shipping_date").alias("valid_shipping_dates"),
        failures(F.col("order_date").isNull()).alias("null_order_dates"),
        failures(F.col("shipping_date").isNull()).alias("null_shipping_dates"),
        failures(F.col("shipping_date") < F.col("order_date")).alias("shipping_before_order"),
        F.min("order_date").alias("minimum_order_date"),
        F.max("order_date").alias("maximum_order_date"),
        F.min("shipping_date").alias("minimum_shipping_date"),
        F.max("shipping_date").alias("maximum_shipping_date"),
    )
    passed = (
        (F.col("valid_order_dates") == F.col("_rows"))
        & (F.col("valid_shipping_dates") == F.col("_rows"))
        & (F.col("shipping_before_order") == 0)
    )
    return counts.withColumn("date_quality_status", verdict(passed)).drop("_rows")


def numeric_rules(stg: DataFrame) -> DataFrame:
    rules = {
        "negative_sales": F.col("sales") < 0,
        "invalid_quantity": F.col("order_item_quantity") <= 0,
        "negative_item_price": F.col("order_item_product_price") < 0,
        "negative_product_price": F.col("product_price") < 0,
        "negative_discount": F.col("order_item_discount") < 0,
        "negative_actual_shipping_days": F.col("days_for_shipping_real") < 0,
        "negative_scheduled_shipping_days": F.col("days_for_shipment_scheduled") < 0,
    }
    return counted_rules(stg, rules, "numeric_rule_status")


def outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def discount_rates(stg: DataFrame) -> DataFrame:
    rules = {
        "invalid_raw_discount_rate": outside("order_item_discount_rate", 0, 1),
        "invalid_discount_rate_pct": outside("discount_rate_pct", 0, 100),
    }
    return counted_rules(stg, rules, "discount_rate_status")


def coordinates(stg: DataFrame) -> DataFrame:
    rules = {"invalid_latitude": outside("latitude", -90, 90), "invalid_longitude": outside("longitude", -180, 180)}
    return counted_rules(stg, rules, "geography_status")


def _one_if(condition: Column) -> Column:
    """1 where the condition holds, 0 otherwise and on NULL."""
    return F.when(condition, 1).otherwise(0)


def _schedule() -> tuple[Column, Column]:
    return F.col("days_for_shipping_real"), F.col("days_for_shipment_scheduled")


def wrong_late_flag() -> Column:
    real, scheduled = _schedule()
    return F.col("is_late_delivery") != _one_if(real > scheduled)


def shipping_features(stg: DataFrame) -> DataFrame:
    real, scheduled = _schedule()
    rules = {
        "invalid_shipping_delay": F.abs(F.col("shipping_delay_days") - (real - scheduled)) > 0.0001,
        "invalid_late_delivery_flag": wrong_late_flag(),
        "invalid_on_time_flag": F.col("is_on_time_delivery") != _one_if(real <= scheduled),
    }
    return counted_rules(stg, rules, "shipping_feature_status")


def financial_features(stg: DataFrame, margin_tolerance: float = 0.05) -> DataFrame:
    profit, sales = F.col(PROFIT), F.col("sales")
    off_margin = F.abs(F.col("profit_margin_pct").cast("double") - percent(profit, sales)) > margin_tolerance
    rules = {
        "invalid_gross_sales": F.abs(F.col("gross_sales_before_discount") - (sales + F.col("order_item_discount"))) > 0.01,
        "invalid_profit_margin": (sales != 0) & off_margin,
        "invalid_profitability_status": F.col("profitability_status") != sign_label(profit, "Profitable", "Break Even", "Loss"),
    }
    return counted_rules(stg, rules, "financial_feature_status")


BINARY = {
    "invalid_is_late_delivery": "is_late_delivery", "invalid_is_on_time_delivery": "is_on_time_delivery",
    "invalid_is_profitable_item": "is_profitable_item", "invalid_is_loss_item": "is_loss_item",
    "invalid_is_weekend_order": "is_weekend_order", "invalid_management_attention": "requires_management_attention",
}


def binary_fields(stg: DataFrame) -> DataFrame:
    return counted_rules(stg, {name: ~F.col(c).isin(0, 1) for name, c in BINARY.items()}, "binary_field_status")


def domains(stg: DataFrame) -> DataFrame:
    rules = {
        "invalid_delivery_performance": ~F.col("delivery_performance").isin(DELIVERY_PERFORMANCE),
        "invalid_profitability_status": ~F.col("profitability_status").isin(PROFITABILITY),
        "invalid_operational_risk_segment": ~F.col("operational_risk_segment").isin(RISK_SEGMENTS),
    }
    return counted_rules(stg, rules, "categorical_domain_status")


PROBLEM_COLUMNS = [
    "order_item_id", "order_id", "customer_id", "product_card_id", "order_date", "shipping_date", "sales",
    "order_item_quantity", "shipping_delay_days", "is_late_delivery", "profitability_status",
]


def problem_rows(stg: DataFrame, n: int = 100) -> DataFrame:
    """First rows, by order item, that break any of ten rules."""
    missing = ["order_item_id", "order_id", "customer_id", "product_card_id", "order_date", "shipping_date"]
    rules = [F.col(c).isNull() for c in missing] + [
        F.col("shipping_date") < F.col("order_date"),
        F.col("sales") < 0,
        F.col("order_item_quantity") <= 0,
        ~F.col("is_late_delivery").isin(0, 1),
    ]
    broken = stg.where(reduce(lambda a, b: a | b, rules))
    return broken.select("staging_row_id", *PROBLEM_COLUMNS).orderBy("order_item_id", "staging_row_id").limit(n)


DISTINCT = {
    "distinct_orders": "order_id", "distinct_customers": "customer_id", "distinct_products": "product_card_id",
    "distinct_categories": "category_id", "distinct_shipping_modes": "shipping_mode",
}


def business_summary(stg: DataFrame) -> DataFrame:
    sums = stg.agg(
        F.count("*").alias("order_item_rows"), *sales_and_profit(), margin_pct("overall_profit_margin_pct"),
        average("days_for_shipping_real", "average_actual_shipping_days"),
        rate_pct("is_late_delivery", "late_delivery_rate_pct"),
    )
    return sums.withColumns({n: stg.agg(F.count_distinct(c)).scalar() for n, c in DISTINCT.items()})


def readiness(stg: DataFrame, expected: int, minimum: int) -> DataFrame:
    """READY / READY WITH WARNINGS / NOT READY. `minimum` is the least number of rows worth a warning only."""
    real, scheduled = _schedule()
    absent = ["order_item_id", "order_id", "customer_id", "product_card_id", "category_id", "sales"]
    negative = ["sales", "order_item_product_price", "days_for_shipping_real", "days_for_shipment_scheduled"]
    either = lambda parts: reduce(lambda a, b: a | b, parts)
    counts = stg.agg(
        *_volume(),
        failures(either([F.col(c).isNull() for c in absent])).alias("missing_critical_fields"),
        failures(F.col("order_date").isNull() | F.col("shipping_date").isNull()).alias("invalid_dates"),
        failures(F.col("shipping_date") < F.col("order_date")).alias("shipping_before_order"),
        failures(either([F.col(c) < 0 for c in negative] + [F.col("order_item_quantity") <= 0])).alias("invalid_numeric_rows"),
        failures((F.col("shipping_delay_days") != (real - scheduled)) | wrong_late_flag()).alias("invalid_shipping_features"),
    )
    faults = ["missing_critical_fields", "invalid_dates", "shipping_before_order", "invalid_numeric_rows", "invalid_shipping_features"]
    exact = (F.col("total_rows") == expected) & (F.col("unique_order_item_ids") == expected)
    ready = exact & (F.col("duplicate_rows") == 0) & _all_zero(faults)
    usable = (F.col("total_rows") >= minimum) & (F.col("duplicate_rows") == 0) & (F.col("missing_critical_fields") == 0)
    label = F.when(ready, "READY").when(usable, "READY WITH WARNINGS").otherwise("NOT READY")
    return counts.withColumn("final_data_readiness", label)


def load_check(stg: DataFrame, expected: int) -> DataFrame:
    """Volume and dates of a finished load, its log status and the staging verdict."""
    counts = stg.agg(
        *_volume(),
        F.count("order_date").alias("valid_order_dates"),
        failures(F.col("order_date").isNull()).alias("null_order_dates"),
        F.count("shipping_date").alias("valid_shipping_dates"),
        failures(F.col("shipping_date").isNull()).alias("null_shipping_dates"),
        F.min("order_date").alias("minimum_order_date"),
        F.max("order_date").alias("maximum_order_date"),
        F.min("shipping_date").alias("minimum_shipping_date"),
        F.max("shipping_date").alias("maximum_shipping_date"),
    )
    dated = (F.col("valid_order_dates") == expected) & (F.col("valid_shipping_dates") == expected)
    complete = (F.col("total_rows") == expected) & (F.col("duplicate_rows") == 0) & dated
    status = F.when(complete, "SUCCESS").when(F.col("total_rows") > 0, "WARNING").otherwise("FAILED")
    return counts.withColumns({"load_status": status, "staging_status": verdict(complete, "READY", "REVIEW REQUIRED")})


def load_sample(stg: DataFrame, n: int = 20) -> DataFrame:
    shown = ["order_status", "shipping_date", "shipping_mode", "product_card_id", "product_name"]
    return stg.orderBy("order_item_id", "staging_row_id").limit(n).select(*shown)
