"""The order-item fact: staging with natural keys resolved to surrogate keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.operators.joins import join_by_group, lookup_join
from freightlens.plans.dims import PLACES, geography_hash
from freightlens.plans.staging import ROW_ID
from freightlens.schemas import FACT_KEYS, FACT_MEASURES, fields

# fact key → (dimension, dimension key, staging expression, natural key)
RESOLVED = {
    "customer_key": ("dim_customer", "customer_key", lambda: F.col("customer_id"), "customer_id"),
    "product_key": ("dim_product", "product_key", lambda: F.col("product_card_id"), "product_card_id"),
    "category_key": ("dim_category", "category_key", lambda: F.col("category_id"), "category_id"),
    "order_date_key": ("dim_date", "date_key", lambda: F.to_date("order_date"), "full_date"),
    "shipping_date_key": ("dim_date", "date_key", lambda: F.to_date("shipping_date"), "full_date"),
    "shipping_mode_key": ("dim_shipping_mode", "shipping_mode_key", lambda: F.col("shipping_mode"), "shipping_mode"),
    "geography_key": ("dim_geography", "geography_key", geography_hash, "geography_natural_key"),
}
# Staged columns that the keys are resolved from.
NATURAL = ["customer_id", "product_card_id", "category_id", "order_date", "shipping_date", "shipping_mode", *PLACES, "latitude", "longitude"]


def resolve_keys(staging: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Staging with the seven `_key` columns; NULL where a member is missing."""
    rows = staging.drop("order_date_key", "shipping_date_key")
    for key, (dim, dim_key, expression, natural) in RESOLVED.items():
        lookup = dims[dim].select(F.col(natural).alias(f"_{natural}"), F.col(dim_key).alias(key))
        rows = lookup_join(rows, lookup, [(expression(), f"_{natural}")], [key])
    return rows


def build_fact(staging: DataFrame, dims: dict[str, DataFrame], at: datetime) -> DataFrame:
    """One row per staged order item. order_item_id is unique at this grain, so it serves as the row's key."""
    return fact_rows(resolve_keys(staging, dims), at)


def fact_by_month(staging: DataFrame, dims: dict[str, DataFrame], at: datetime) -> DataFrame:
    """The same rows dealt out by month, of staged rows stored and numbered: keys are resolved beside them, so that wide rows move once."""
    keys = resolve_keys(staging.select(ROW_ID, *NATURAL, "order_year_month"), dims).select(ROW_ID, *RESOLVED, "order_year_month")
    return fact_rows(join_by_group(staging.drop(*RESOLVED), keys, ROW_ID, "order_year_month"), at)


def fact_rows(resolved: DataFrame, at: datetime) -> DataFrame:
    return resolved.select(
        F.col("order_item_id").alias("fact_order_item_key"),
        *[F.coalesce(F.col(k), F.lit(0)).cast(t).alias(k) for k, t in fields(FACT_KEYS).items()],
        *FACT_MEASURES,
        F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz").alias("loaded_at"),
    )
