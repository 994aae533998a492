"""Profile of a raw or cleaned frame: schema, keys, numbers, categories, dates, outliers, rules, score."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.functions.dates import parse_datetime
from freightlens.functions.numbers import percent, ratio, rounded
from freightlens.operators.cleaning import clean_name, metric_rows, typed
from freightlens.operators.ranking import PERCENTILE_KINDS, quantiles
from freightlens.operators.rules import Rule, column_figures, column_values, exact_copies, null_cells, repeated_key_rows, rule_report
from freightlens.schemas import CLEAN_FIELDS

# Raw columns looked at one by one.
RAW_KEYS = ["Order Item Id", "Order Id", "Customer Id", "Product Card Id"]
RAW_DATES = ["order date (DateOrders)", "shipping date (DateOrders)"]
RAW_MEASURES = [
    "Sales", "Benefit per order", "Order Profit Per Order", "Order Item Product Price", "Order Item Discount",
    "Order Item Discount Rate", "Order Item Quantity", "Days for shipping (real)", "Days for shipment (scheduled)",
]
RAW_OUTLIER_COLUMNS = [
    "Sales", "Benefit per order", "Order Profit Per Order", "Order Item Product Price", "Order Item Discount",
    "Order Item Quantity", "Days for shipping (real)",
]
RAW_CATEGORIES = [
    "Delivery Status", "Late_delivery_risk", "Shipping Mode", "Order Status", "Market", "Order Region",
    "Customer Segment", "Category Name",
]
PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
RAW_COLUMN_COUNT = 53


def type_numbers(raw: DataFrame) -> DataFrame:
    """Raw text columns with the numeric ones typed; names, dates and text stay as they are."""
    kinds = {c: CLEAN_FIELDS.get(clean_name(c), "string") for c in raw.columns}
    return raw.select(
        *[
            (typed(F.col(f"`{c}`"), kinds[c]) if kinds[c] not in ("string", "timestamp_ntz") else F.col(f"`{c}`")).alias(c)
            for c in raw.columns
        ]
    )


def numeric_columns(df: DataFrame) -> dict[str, int | None]:
    """Numeric columns with their number of decimals; None for floats and doubles, which have no fixed one."""
    scales: dict[str, int | None] = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("float", "double"):
            scales[field.name] = None
        elif kind in PERCENTILE_KINDS:
            scales[field.name] = field.dataType.scale if kind == "decimal" else 0
    return scales


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def overview(df: DataFrame) -> DataFrame:
    counts = df.agg(F.count("*").alias("n")).withColumn("copies", exact_copies(df))
    width = len(df.columns)
    return metric_rows(
        counts,
        {"rows": F.col("n"), "columns": F.lit(width), "cells": F.col("n") * width, "exact_duplicate_rows": F.col("copies")},
    )


def _column_types(df: DataFrame) -> Column:
    pairs = [x for c, t in df.dtypes for x in (F.lit(c), F.lit(t))]
    return F.create_map(*pairs)


def _share(part: Column, whole: Column, digits: int) -> Column:
    return rounded(percent(part, whole), digits).cast("double")


def schema_report(*parts: DataFrame) -> DataFrame:
    """Type, filled and missing cells, distinct values and the smallest value of every column of a frame, or of frames that hold its columns."""
    whole = F.col("non_null") + F.col("null_count")
    reports = [
        column_figures(df, df.columns).where(whole > 0).select(
            "column", "non_null", "null_count", _share(F.col("null_count"), whole, 2).alias("null_pct"), "unique_count", "sample_value",
            _column_types(df)[F.col("column")].alias("dtype"),
        )
        for df in parts
    ]
    return reduce(DataFrame.unionByName, reports).orderBy(F.desc("null_pct"), F.desc("unique_count"), "column")


def missing_report(df: DataFrame, digits: int = 2) -> DataFrame:
    """Missing cells of the columns that have any."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), (F.col("_rows") - F.col(f"c{i}")).alias("missing_count")) for i, c in enumerate(df.columns)]
    report = counts.select("_rows", F.explode(F.array(*rows)).alias("r")).select("_rows", "r.*").where("missing_count > 0")
    share = _share(F.col("missing_count"), F.col("_rows"), digits).alias("missing_pct")
    return report.select("column", "missing_count", share).orderBy(F.desc("missing_pct"), "column")


def key_report(df: DataFrame, keys: Sequence[str] = RAW_KEYS) -> DataFrame:
    """Missing, distinct and repeated values of the key candidates; every copy of a repeated value counts."""
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    return column_values(df, [k for k in keys if k in df.columns]).groupBy("column").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.count("value").alias("unique"),
        repeated.alias("duplicated_rows"),
        (repeated == 0).alias("is_unique"),
    )


def _measurements(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, v) per cell; NaN is a missing value."""
    fractional = {c for c, t in df.dtypes if t in ("float", "double")}
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    value |= {c: F.when(~F.isnan(v), v) for c, v in value.items() if c in fractional}
    cells = [F.struct(F.lit(c).alias("column"), v.alias("v")) for c, v in value.items()]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _looked_up(values: dict[str, float | None]) -> Column:
    """Per-column figures as a literal map, looked up by the `column` cell."""
    pairs = [x for c, v in values.items() for x in (F.lit(c), F.lit(v).cast("double"))]
    return F.create_map(*pairs)[F.col("column")]


def numeric_report(df: DataFrame, columns: dict[str, int] | None = None) -> DataFrame:
    """count, mean, std, min, seven exact percentiles, max, and missing / zero / negative counts."""
    columns = columns or numeric_columns(df)
    found = quantiles(df, columns, PERCENTILES)
    report = _measurements(df, list(columns)).groupBy("column").agg(
        F.count("v").alias("count"),
        rounded(F.avg("v"), 4).cast("double").alias("mean"),
        rounded(F.stddev_samp("v"), 4).cast("double").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.sum(F.col("v").isNull().cast("int")).alias("missing"),
        F.coalesce(F.sum((F.col("v") == 0).cast("int")), F.lit(0)).alias("zero_count"),
        F.coalesce(F.sum((F.col("v") < 0).cast("int")), F.lit(0)).alias("negative_count"),
    )
    for i, p in enumerate(PERCENTILES):
        at = _looked_up({c: q[i] for c, q in found.items()})
        report = report.withColumn(f"p{round(p * 100):02d}", rounded(at, 4).cast("double"))
    return report


def histogram(df: DataFrame, columns: Sequence[str] = RAW_MEASURES, bins: int = 40) -> DataFrame:
    """Equal-width bins from the smallest to the largest value of each column, empty bins included."""
    values = _measurements(df, [c for c in columns if c in df.columns]).where("v is not null")
    flat = F.when(F.min("v") == F.max("v"), 0.5).otherwise(0.0)
    ends = values.groupBy("column").agg((F.min("v") - flat).alias("lo"), (F.max("v") + flat).alias("hi"))
    ends = F.broadcast(ends.withColumn("step", (F.col("hi") - F.col("lo")) / bins))  # one row per column
    place = F.least(F.floor((F.col("v") - F.col("lo")) / F.col("step")), F.lit(bins - 1)).cast("int")
    counts = values.join(ends, "column").groupBy("column", place.alias("bin")).agg(F.count("*").alias("n"))
    frame = ends.select("column", "lo", "step", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    lower = F.col("lo") + F.col("bin") * F.col("step")
    return frame.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        rounded(lower, 4).cast("double").alias("lower"),
        rounded(lower + F.col("step"), 4).cast("double").alias("upper"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def categorical_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct and missing values and the most frequent value of each text column (smallest on a tie)."""
    most = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("order"), "value")))
    return (
        column_values(df, columns or text_columns(df))
        .groupBy("column")
        .agg(
            F.count("value").alias("unique_count"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_count"),
            most.alias("m"),
        )
        .select(
            "column", "unique_count", "missing_count",
            F.col("m.value").alias("top_value"),
            F.coalesce(-F.col("m.order"), F.lit(0)).alias("top_frequency"),
        )
        .orderBy("unique_count", "column")
    )


def value_counts(df: DataFrame, columns: Sequence[str] = RAW_CATEGORIES, n: int = 20) -> DataFrame:
    """The n most frequent values of each column, NULL included."""
    frequent = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    counts = column_values(df, [c for c in columns if c in df.columns])
    return (
        counts.withColumn("place", F.row_number().over(frequent))
        .where(F.col("place") <= n)
        .select("column", "value", F.col("n").alias("count"))
    )


def date_report(df: DataFrame, columns: Sequence[str] = RAW_DATES) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), parse_datetime(F.col(f"`{c}`")).alias("d")) for c in columns if c in df.columns]
    parsed = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return parsed.groupBy("column").agg(
        F.min("d").alias("min_date"),
        F.max("d").alias("max_date"),
        F.sum(F.col("d").isNull().cast("int")).alias("invalid_or_missing"),
        F.count_distinct(F.to_date("d")).alias("distinct_dates"),
    )


def outlier_report(df: DataFrame, columns: Sequence[str], of_all_rows: bool = False) -> DataFrame:
    """Values outside 1.5 interquartile ranges. The share is of the filled cells, or of all rows."""
    scales = numeric_columns(df)
    columns = [c for c in columns if c in scales]
    found = quantiles(df, {c: scales[c] for c in columns}, [0.25, 0.75])
    q1 = _looked_up({c: q[0] for c, q in found.items()})
    q3 = _looked_up({c: q[1] for c, q in found.items()})
    fenced = _measurements(df, columns).withColumns({"q1": q1, "q3": q3})
    iqr = F.col("q3") - F.col("q1")
    fenced = fenced.withColumns({"iqr": iqr, "lower": F.col("q1") - iqr * 1.5, "upper": F.col("q3") + iqr * 1.5})
    outside = F.coalesce(F.sum(((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper"))).cast("int")), F.lit(0))
    whole = F.count("*") if of_all_rows else F.count("v")
    return (
        fenced.groupBy("column", "q1", "q3", "iqr", "lower", "upper")
        .agg(outside.alias("outlier_count"), rounded(percent(outside, whole), 4 if of_all_rows else 2).cast("double").alias("outlier_pct"))
        .select(
            "column",
            *[rounded(F.col(c), 4).cast("double").alias(c) for c in ("q1", "q3", "iqr")],
            *[rounded(F.col(c), 4).cast("double").alias(f"{c}_bound") for c in ("lower", "upper")],
            "outlier_count",
            "outlier_pct",
        )
        .orderBy(F.desc("outlier_pct"), "column")
    )


def raw_rules(df: DataFrame) -> list[Rule]:
    """Rules on typed raw columns, those whose columns df has. A missing rate or risk fails its rule, other missing values do not."""
    col = lambda c: F.col(f"`{c}`")
    status, risk = F.lower(F.trim(col("Delivery Status"))), col("Late_delivery_risk")
    not_one = F.coalesce(risk != 1, F.lit(True))
    late = F.coalesce(status == "late delivery", F.lit(False))
    key, rate = "Order Item Id", "Order Item Discount Rate"
    rules = [
        *[
            Rule(name, "high", col(c) < 0, needs=(c,))
            for name, c in (
                ("Negative actual shipping days", "Days for shipping (real)"),
                ("Negative scheduled shipping days", "Days for shipment (scheduled)"),
            )
        ],
        Rule("Quantity must be greater than zero", "high", col("Order Item Quantity") <= 0, needs=("Order Item Quantity",)),
        Rule("Sales must be non-negative", "high", col("Sales") < 0, needs=("Sales",)),
        Rule("Product price must be non-negative", "high", col("Order Item Product Price") < 0, needs=("Order Item Product Price",)),
        Rule("Discount rate outside 0–1", "high", ~F.coalesce(col(rate).between(0, 1), F.lit(False)), needs=(rate,)),
        Rule("Late delivery risk outside {0,1}", "high", ~F.coalesce(risk.isin(0, 1), F.lit(False)), needs=("Late_delivery_risk",)),
        Rule("Missing Order Item Id", "high", col(key).isNull(), needs=(key,)),
        Rule("Duplicated Order Item Id", "high", count=lambda: repeated_key_rows(df, key), needs=(key,)),
        Rule(
            "Delivery status vs late-risk inconsistency", "medium", (late & not_one) | (~late & ~not_one),
            needs=("Delivery Status", "Late_delivery_risk"),
        ),
    ]
    return [r for r in rules if r.applies(df)]


def business_rules(df: DataFrame) -> DataFrame:
    return rule_report(df, raw_rules(df), name="check")


# Weights of the raw score, and the score from which a verdict holds.
RAW_WEIGHTS = {"completeness": 0.30, "uniqueness": 0.25, "validity": 0.30, "schema": 0.15}
STRONG, USABLE = 95, 85


def quality_score(df: DataFrame, expected_columns: int = RAW_COLUMN_COUNT) -> DataFrame:
    """Score per dimension, and on every row the weighted total with its verdict."""
    rules = raw_rules(df)
    failed = business_rules(df).agg(F.coalesce(F.sum("failed_rows"), F.lit(0))).scalar()
    counts = df.agg(F.count("*").alias("n"), null_cells(df).alias("nulls"))
    counts = counts.withColumns({"copies": exact_copies(df), "failed": failed})
    scores = {
        "completeness": 1 - ratio(F.col("nulls"), F.col("n") * len(df.columns)),
        "uniqueness": 1 - ratio(F.col("copies"), F.col("n")),
        "validity": F.greatest(F.lit(0.0), 1 - ratio(F.col("failed"), F.col("n") * max(1, len(rules)))),
        "schema": F.lit(1.0 if len(df.columns) == expected_columns else 0.5),
    }
    readiness = sum((scores[d] * 100 * w for d, w in RAW_WEIGHTS.items()), F.lit(0.0))
    label = (
        F.when(readiness >= STRONG, "strong baseline")
        .when(readiness >= USABLE, "usable after cleaning")
        .otherwise("remediation required")
    )
    rows = [
        F.struct(
            F.lit(d).alias("dimension"),
            rounded(scores[d] * 100, 6).cast("double").alias("score_pct"),
            F.lit(w).alias("weight"),
            rounded(scores[d] * 100 * w, 6).cast("double").alias("weighted_score"),
        )
        for d, w in RAW_WEIGHTS.items()
    ]
    return counts.select(
        F.explode(F.array(*rows)).alias("r"), rounded(readiness, 2).cast("double").alias("readiness_score"), label.alias("assessment")
    ).select("r.*", "readiness_score", "assessment")


# ---- after cleaning ------------------------------------------------------------------------------


def clean_rule_list(df: DataFrame) -> list[Rule]:
    """Rules on cleaned columns, those whose columns df has."""
    col, key, rate = F.col, "order_item_id", "order_item_discount_rate"
    rules = [
        Rule("order_item_id is not null", "high", col(key).isNull(), needs=(key,)),
        Rule("order_item_id is unique", "high", count=lambda: repeated_key_rows(df, key), needs=(key,)),
        Rule("quantity > 0", "high", col("order_item_quantity") <= 0, needs=("order_item_quantity",)),
        Rule("sales >= 0", "high", col("sales") < 0, needs=("sales",)),
        Rule("product price >= 0", "high", col("order_item_product_price") < 0, needs=("order_item_product_price",)),
        Rule("discount rate between 0 and 1", "high", ~F.coalesce(col(rate).between(0, 1), F.lit(False)), needs=(rate,)),
        Rule("late_delivery_risk in {0,1}", "high", ~F.coalesce(col("late_delivery_risk").isin(0, 1), F.lit(False)), needs=("late_delivery_risk",)),
        Rule("shipping date is not before order date", "medium", col("shipping_date") < col("order_date"), needs=("shipping_date", "order_date")),
        Rule("actual shipping days >= 0", "high", col("days_for_shipping_real") < 0, needs=("days_for_shipping_real",)),
    ]
    return [r for r in rules if r.applies(df)]


def clean_rules(df: DataFrame) -> DataFrame:
    return rule_report(df, clean_rule_list(df))


def require_clean(df: DataFrame) -> None:
    """Raise unless the frame is non-empty, free of exact copies, and keyed by a unique non-null item id."""
    key = F.col("order_item_id")
    found = df.agg(F.count("*").alias("n"), F.count(key).alias("keyed"), F.count_distinct(key).alias("keys")).first()
    if found["n"] == 0:
        raise ValueError("clean dataset is empty")
    if found["keyed"] < found["n"]:
        raise ValueError("missing order_item_id remains")
    if found["keys"] < found["n"]:  # unique keys also rule out exact copies
        raise ValueError("order_item_id is not unique")


# Weights of the score after cleaning.
CLEAN_WEIGHTS = {"completeness": 0.35, "uniqueness": 0.25, "validity": 0.40}


def clean_score(df: DataFrame) -> DataFrame:
    failed = clean_rules(df).agg(F.coalesce(F.sum("failed_rows"), F.lit(0))).scalar()
    counts = df.agg(F.count("*").alias("n"), null_cells(df).alias("nulls"))
    counts = counts.withColumns({"copies": exact_copies(df), "failed": failed})
    scores = {
        "completeness": (1 - ratio(F.col("nulls"), F.col("n") * len(df.columns))) * 100,
        "uniqueness": (1 - ratio(F.col("copies"), F.col("n"))) * 100,
        "validity": F.greatest(F.lit(0.0), (1 - ratio(F.col("failed"), F.col("n") * max(1, len(clean_rule_list(df))))) * 100),
    }
    readiness = sum((scores[d] * w for d, w in CLEAN_WEIGHTS.items()), F.lit(0.0))
    return counts.select(
        *[rounded(v, 4).cast("double").alias(k) for k, v in scores.items()],
        rounded(readiness, 4).cast("double").alias("readiness_score"),
    )
