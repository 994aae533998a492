"""Staging: cleaned items with all features and load columns, one row per order item."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions import features
from freightlens.functions.dates import year_month
from freightlens.operators.cleaning import SLOT
from freightlens.operators.joins import join_by_group, lookup_join
from freightlens.operators.ranking import order_statistics
from freightlens.schemas import STAGING_FIELDS, conform
from freightlens.session import Workspace

# Fixed value: prefix of a load batch tag.
BATCH_PREFIX = "DATACO_"
ROW_ID = "staging_row_id"
MONTH = "order_year_month"
LAYOUT = {c: t for c, t in STAGING_FIELDS.items() if c != ROW_ID}  # as written

ORDER_FEATURES = [
    "order_total_sales", "order_total_profit", "order_total_quantity", "order_item_count", "order_profit_margin_pct",
]
CUSTOMER_FEATURES = [
    "customer_order_count", "customer_lifetime_sales", "customer_average_item_sales", "customer_lifetime_profit",
    "customer_first_order_date", "customer_last_order_date", "customer_tenure_days",
]


def batch_tag(loaded_at: datetime) -> str:
    return BATCH_PREFIX + loaded_at.strftime("%Y%m%d_%H%M%S_%f")


def sales_tier_cuts(items: DataFrame) -> list[tuple] | None:
    """Last (sales, order_item_id) pair of each of the first three quartiles of the non-null sales,
    ordered by sales and then order_item_id. None when fewer than four sales values are distinct."""
    scale = 10_000
    sales = items.select((F.col("sales") * scale).cast("long").alias("v"), "order_item_id").where("v is not null")
    edges, sizes = order_statistics(sales, {"v": lambda n: [1, *_quartile_ends(n), n]})
    if len({v for v, _ in edges.values()}) < 4 and sales.select("v").distinct().limit(4).count() < 4:
        return None
    picked = [edges[("v", r)] for r in _quartile_ends(sizes["v"])]  # (scaled sales, rank among its ties)
    ties = sales.where(F.col("v").isin([v for v, _ in picked])).select(
        *[F.when(F.col("v") == v, F.col("order_item_id")).alias(f"t{i}") for i, (v, _) in enumerate(picked)]
    )
    last, _ = order_statistics(ties, {f"t{i}": lambda n, inside=inside: [inside] for i, (_, inside) in enumerate(picked)})
    return [(Decimal(v) / scale, last[(f"t{i}", inside)][0]) for i, (v, inside) in enumerate(picked)]


def _quartile_ends(n: int) -> list[int]:
    return [1 + (n - 1) * q // 4 for q in (1, 2, 3)]


def attach_totals(items: DataFrame, orders: DataFrame, customers: DataFrame, few_orders: bool | None = None) -> DataFrame:
    """Order and customer totals joined back. Rows without an order or customer form one group each. Totals are stored tables, order totals
    may be a plan as well if `few_orders` says whether they are to be broadcast."""
    items = lookup_join(items, orders, [("order_id", "order_id")], ORDER_FEATURES, null_safe=True, small=few_orders)
    return attach_customers(items, customers)


def attach_customers(items: DataFrame, customers: DataFrame) -> DataFrame:
    items = lookup_join(items, customers, [("customer_id", "customer_id")], CUSTOMER_FEATURES, null_safe=True)
    return items.transform(features.add_frequency_segment)


def ready_items(clean: DataFrame, customers: DataFrame) -> DataFrame:
    """Cleaned items (a stored table, read several times) to the analytics-ready layout, as a plan.

    The totals are joined to the narrow rows, the many row features come last. A reader of some columns runs the joins behind them only.
    """
    return finished(with_totals(clean, customers), sales_tier_cuts(clean))


def with_totals(clean: DataFrame, customers: DataFrame) -> DataFrame:
    return attach_totals(clean, features.order_totals(clean), customers, few_orders=False)


def with_totals_by_month(clean: DataFrame, customers: DataFrame) -> DataFrame:
    """The same rows and their `order_year_month`, dealt out by it, of cleaned items with their SLOT: totals are attached beside them, so that wide rows move once."""
    clean = clean.withColumn(MONTH, year_month(F.col("order_date")))
    slim = clean.select(SLOT, MONTH, "order_id", "customer_id")
    totals = attach_totals(slim, features.order_totals(clean), customers, few_orders=False)
    totals = totals.select(SLOT, MONTH, *ORDER_FEATURES, *CUSTOMER_FEATURES)
    return join_by_group(clean, totals, SLOT, MONTH).transform(features.add_frequency_segment).drop(SLOT)


def finished(items: DataFrame, cuts: list[tuple] | None) -> DataFrame:
    return features.add_sales_tier(items.transform(features.add_row_features), cuts)


def staged(ready: DataFrame, loaded_at: datetime, source_file_name: str, *keep: str) -> DataFrame:
    """Ready items with the columns of their load, without row numbers; long columns to `keep` come last."""
    tagged = ready.withColumns(
        {
            "source_file_name": F.lit(source_file_name),
            "load_batch_id": F.lit(batch_tag(loaded_at)),
            "loaded_at": F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz"),
        }
    )
    return conform(tagged, {**LAYOUT, **{c: "bigint" for c in keep}})


def store(ws: Workspace, ready: DataFrame, loaded_at: datetime, source_file_name: str) -> DataFrame:
    """Full refresh of the staging table, each row with the SLOT it is written at."""
    rows = staged(ready, loaded_at, source_file_name)
    return ws.write(rows.withColumn(SLOT, F.monotonically_increasing_id()), ws.fresh("staging"))


def number_rows(stored: DataFrame) -> DataFrame:
    """Stored staging with its rows numbered 1..n in the order they were written, without moving any row."""
    part = F.shiftright(SLOT, 33)
    starts, seen = [], 1
    for p, n in sorted((r["p"], r["count"]) for r in stored.groupBy(part.alias("p")).count().collect()):
        starts.append((p, seen))
        seen += n
    starts = stored.sparkSession.createDataFrame(starts, "_part long, _start long")  # one row per written task
    place = F.col("_start") + F.col(SLOT) - F.shiftleft(part, 33)
    return lookup_join(stored, starts, [(part, "_part")], ["_start"], small=True).withColumn(ROW_ID, place).select(*STAGING_FIELDS)


def latest_batch(staging: DataFrame) -> DataFrame:
    """Rows of the batch loaded last."""
    newest = staging.where("load_batch_id is not null").agg(F.max_by("load_batch_id", "loaded_at").alias("b"))
    return staging.where(F.col("load_batch_id") == newest.scalar())
