"""Checks on the dimensions and the fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.features import PROFIT
from freightlens.functions.numbers import failures, rounded
from freightlens.operators.rules import Rule, rule_report
from freightlens.plans.dims import DIMENSIONS
from freightlens.plans.facts import RESOLVED, resolve_keys
from freightlens.plans.measures import average, margin_pct, rate_pct, sales_and_profit
from freightlens.plans.quality import verdict
from freightlens.plans.warehouse import Warehouse

# Names of the seven keys in report columns, in report order.
KEY_LABELS = {
    "customer_key": "customer", "product_key": "product", "category_key": "category", "order_date_key": "order_date",
    "shipping_date_key": "shipping_date", "shipping_mode_key": "shipping_mode", "geography_key": "geography",
}
PLURALS = {
    "customer_key": "customers", "product_key": "products", "category_key": "categories", "order_date_key": "order_dates",
    "shipping_date_key": "shipping_dates", "shipping_mode_key": "shipping_modes", "geography_key": "geographies",
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unknown_members(w: Warehouse) -> DataFrame:
    """The key-0 rows as stored, one per dimension, with how many fact rows point at each."""
    rows = []
    for name, dim in DIMENSIONS.items():
        keys = [k for k, (d, *_rest) in RESOLVED.items() if d == name]
        used = w.fact.agg(F.coalesce(failures(reduce(lambda a, b: a | b, [F.col(k) == 0 for k in keys])), F.lit(0))).scalar()
        label = next(c for c in dim.columns if dim.unknown.get(c) == "Unknown")
        stored = w.dims[name].where(F.col(dim.key) == 0)
        rows.append(
            stored.select(
                F.lit(name).alias("dimension_name"), F.col(dim.key).cast("bigint").alias("member_key"),
                F.col(label).alias("label"), "record_source", used.alias("fact_rows"),
            )
        )
    return _union(rows)


def row_counts(w: Warehouse) -> DataFrame:
    return _union(
        [
            dim.agg(F.count("*").alias("total_rows")).select(
                F.lit(name).alias("dimension_name"), "total_rows", (F.col("total_rows") - 1).alias("business_members")
            )
            for name, dim in w.dims.items()
        ]
    )


def key_uniqueness(w: Warehouse) -> DataFrame:
    def one(name: str) -> DataFrame:
        dim = DIMENSIONS[name]
        counts = w.dims[name].where(F.col(dim.key) != 0).agg(
            F.count("*").alias("business_rows"), F.count_distinct(dim.natural).alias("distinct_natural_keys")
        )
        status = verdict(F.col("business_rows") == F.col("distinct_natural_keys"))
        return counts.select(F.lit(name).alias("dimension_name"), *counts.columns, status.alias("uniqueness_status"))

    return _union([one(n) for n in ("dim_customer", "dim_category", "dim_product")])


def _all_zero(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c) == 0 for c in columns])


def resolution_of(staged: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Staged rows without a member, per key, with both readiness labels."""
    places = ["market", "order_region", "order_country", "order_state", "order_city", "latitude", "longitude"]
    natural = ["customer_id", "product_card_id", "category_id", "order_date", "shipping_date", "shipping_mode", *places]
    keyed = resolve_keys(staged.select(*natural), tables)
    names = [f"unresolved_{p}" for p in PLURALS.values()]
    counts = keyed.agg(*[failures(F.col(k).isNull()).alias(n) for k, n in zip(PLURALS, names)])
    return counts.withColumns(
        {
            "dimension_readiness": verdict(_all_zero(names), "READY FOR FACT LOAD", "REVIEW UNRESOLVED MEMBERS"),
            "dimension_resolution_status": verdict(_all_zero(names), "PASS", "REVIEW BEFORE FACT LOAD"),
        }
    )


def resolution(w: Warehouse) -> DataFrame:
    return resolution_of(w.latest, w.dims)


def require_resolved(staged: DataFrame, tables: dict[str, DataFrame]) -> None:
    """Raise unless every staged row finds its seven members."""
    found = resolution_of(staged, tables).first()
    if found["dimension_readiness"] != "READY FOR FACT LOAD":
        raise ValueError(f"unresolved dimension members: {found.asDict()}")


def empty_before_load(fact: DataFrame) -> DataFrame:
    counts = fact.agg(F.count("*").alias("fact_rows"))
    return counts.withColumn("fact_table_status", verdict(F.col("fact_rows") == 0, "READY FOR FACT LOAD", "REVIEW EXISTING FACT DATA"))


def _any_unknown() -> Column:
    return reduce(lambda a, b: a | b, [F.col(k) == 0 for k in KEY_LABELS])


def load_status(fact: DataFrame, expected: int) -> DataFrame:
    """Volume, grain and unknown keys of a finished load with its status and the final decision."""
    unique = F.count_distinct("order_item_id")
    counts = fact.agg(
        F.count("*").alias("fact_rows"),
        unique.alias("unique_order_item_ids"),
        (F.count("*") - unique).alias("duplicate_rows"),
        failures(_any_unknown()).alias("rows_with_unknown_dimension_key"),
    )
    complete = (
        (F.col("fact_rows") == expected)
        & (F.col("unique_order_item_ids") == expected)
        & _all_zero(["duplicate_rows", "rows_with_unknown_dimension_key"])
    )
    status = F.when(complete, "SUCCESS").when(F.col("fact_rows") > 0, "WARNING").otherwise("FAILED")
    return counts.withColumns(
        {"etl_status": status, "final_fact_readiness": verdict(complete, "FACT LOAD COMPLETE", "REVIEW FACT LOAD")}
    )


def grain_check(fact: DataFrame, expected: int) -> DataFrame:
    unique = F.count_distinct("order_item_id")
    counts = fact.agg(
        F.count("*").alias("fact_rows"), unique.alias("unique_order_item_ids"), (F.count("*") - unique).alias("duplicate_rows")
    )
    passed = (F.col("fact_rows") == expected) & (F.col("unique_order_item_ids") == expected)
    return counts.withColumn("grain_and_volume_status", verdict(passed))


def unknown_keys(fact: DataFrame) -> DataFrame:
    names = [f"unknown_{label}_keys" for label in KEY_LABELS.values()]
    counts = fact.agg(*[failures(F.col(k) == 0).alias(n) for k, n in zip(KEY_LABELS, names)])
    return counts.withColumn("dimension_key_status", verdict(_all_zero(names), "PASS", "REVIEW"))


def orphans(w: Warehouse) -> DataFrame:
    """Fact rows whose key has no dimension row, per key. Keys are counted first, so that each dimension
    meets its distinct keys and not every fact row."""

    def orphaned(key: str) -> Column:
        dim, dim_key, *_rest = RESOLVED[key]
        used = w.fact.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
        known = w.dims[dim].select(F.col(dim_key).alias("k"))
        return used.join(known, "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()

    rows = w.fact.agg(F.count("*").alias("fact_rows"))
    return rows.select("fact_rows", *[orphaned(k).alias(f"orphan_{label}_keys") for k, label in KEY_LABELS.items()])


def reconcile(staged: DataFrame, fact: DataFrame) -> DataFrame:
    def sums(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"{name}_rows"), F.sum("sales").alias(f"{name}_sales"), F.sum(PROFIT).alias(f"{name}_profit")
        )

    loaded = sums(fact, "fact")
    both = sums(staged, "staging").withColumns({c: loaded.select(c).scalar() for c in loaded.columns})
    gap = {m: F.col(f"fact_{m}") - F.col(f"staging_{m}") for m in ("sales", "profit")}
    same = (F.col("staging_rows") == F.col("fact_rows")) & (F.abs(gap["sales"]) <= 0.01) & (F.abs(gap["profit"]) <= 0.01)
    return both.select(
        "staging_rows", "fact_rows",
        rounded(F.col("staging_sales")).alias("staging_sales"),
        rounded(F.col("fact_sales")).alias("fact_sales"),
        rounded(gap["sales"]).alias("sales_difference"),
        rounded(F.col("staging_profit")).alias("staging_profit"),
        rounded(F.col("fact_profit")).alias("fact_profit"),
        rounded(gap["profit"]).alias("profit_difference"),
        verdict(same).alias("reconciliation_status"),
    )


def summary(fact: DataFrame) -> DataFrame:
    sums = fact.agg(
        F.count("*").alias("order_item_rows"), *sales_and_profit(), margin_pct("overall_profit_margin_pct"),
        average("days_for_shipping_real", "average_actual_shipping_days"),
        rate_pct("is_late_delivery", "late_delivery_rate_pct"),
    )
    distinct = {
        "distinct_orders": "order_id", "represented_customer_keys": "customer_key",
        "represented_product_keys": "product_key", "represented_category_keys": "category_key",
    }
    return sums.withColumns({n: fact.agg(F.count_distinct(c)).scalar() for n, c in distinct.items()})


def star_sample(w: Warehouse, n: int = 20) -> DataFrame:
    """The first n fact rows with their members. They are taken after the joins, which drop orphans."""
    keys = list(KEY_LABELS)
    rows = w.fact.select("fact_order_item_key", "order_item_id", "order_id", *keys, "sales", PROFIT, "is_late_delivery")
    rows = w.attach(rows, "date", ["full_date"], on="order_date_key").withColumnRenamed("full_date", "order_date")
    rows = w.attach(rows, "date", ["full_date"], on="shipping_date_key").withColumnRenamed("full_date", "shipping_date")
    for dim, columns in {
        "customer": ["customer_segment"], "product": ["product_name"], "category": ["category_name"],
        "shipping_mode": ["shipping_mode"], "geography": ["market", "order_country"],
    }.items():
        rows = w.attach(rows, dim, columns)
    return rows.orderBy("fact_order_item_key").limit(n).select(
        "order_item_id", "order_id", "order_date", "shipping_date", "customer_segment", "product_name", "category_name",
        "shipping_mode", "market", "order_country", "sales", PROFIT, "is_late_delivery",
    )


def constraints(w: Warehouse) -> DataFrame:
    """Row rules the star tables must satisfy; NULL satisfies every rule but the weekend flag's."""
    binary = lambda c: ~F.col(c).isin(0, 1)
    between = lambda c, low, high: ~F.col(c).between(low, high)
    rules = {
        "fact_order_item": [
            ("order_item_quantity > 0", F.col("order_item_quantity") <= 0),
            *[(f"{c} in (0, 1)", binary(c)) for c in (
                "is_late_delivery", "is_on_time_delivery", "is_profitable_item", "is_loss_item", "requires_management_attention")],
        ],
        "dim_product": [("product_status in (0, 1)", binary("product_status"))],
        "dim_date": [
            ("calendar_month between 1 and 12", between("calendar_month", 1, 12)),
            ("calendar_quarter between 1 and 4", between("calendar_quarter", 1, 4)),
            ("is_weekend in (0, 1)", F.coalesce(binary("is_weekend"), F.lit(True))),
        ],
        "dim_geography": [
            ("latitude between -90 and 90", between("latitude", -90, 90)),
            ("longitude between -180 and 180", between("longitude", -180, 180)),
        ],
    }
    reports = []
    for table, conditions in rules.items():
        df = w.fact if table == "fact_order_item" else w.dims[table]
        report = rule_report(df, [Rule(name, "high", fails) for name, fails in conditions], name="constraint")
        reports.append(report.select(F.lit(table).alias("table_name"), "constraint", "failed_rows", "status"))
    return _union(reports)
