"""Order items assembled from the normalised Parquet tables (lineitem, orders, customer, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions.numbers import ratio, rounded
from freightlens.schemas import RAW_HEADERS

MONEY = "decimal(18,4)"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """One typed row per order item under the cleaned column names.

    Place columns the tables have no source for are left out rather than filled with NULL.
    """
    table = lambda name: read_table(spark, folder, name)
    # buyers are attached to the orders, so that the far more numerous line items are shuffled by part and order only;
    # the orders come last, so that the items lie together by order for the steps that follow
    bought = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    joined = (
        table("lineitem")
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    real = ((F.col("l_suppkey") + F.col("l_linenumber")) % 7).cast("int")
    scheduled = _by_priority({"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}, 4)
    gross = F.col("l_extendedprice").cast(MONEY)
    rate = F.round("l_discount", 2).cast("decimal(12,6)")
    category = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    department = category % 5
    money = (
        joined.withColumn("_discount", (gross * rate).cast(MONEY))
        .withColumn("_sales", (gross - F.col("_discount")).cast(MONEY))
        .withColumn(
            "_profit",
            (F.col("_sales") - F.col("l_quantity").cast("int") * F.col("p_retailprice").cast(MONEY)).cast(MONEY),
        )
    )
    return money.select(
        F.col("l_returnflag").alias("payment_type"),
        real.alias("days_for_shipping_real"),
        scheduled.alias("days_for_shipment_scheduled"),
        F.col("_profit").alias("order_profit"),
        F.col("_sales").alias("sales_per_customer"),
        F.when(real > scheduled, "Late Delivery")
        .when(real == scheduled, "Shipping On Time")
        .otherwise("Advance Shipping")
        .alias("delivery_status"),
        (real > scheduled).cast("int").alias("late_delivery_risk"),
        category.alias("category_id"),
        F.col("p_brand").alias("category_name"),
        F.col("n_name").alias("customer_country"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        department.alias("department_id"),
        F.concat(F.lit("Department "), department.cast("string")).alias("department_name"),
        (F.col("n_nationkey") * 3 - 36).cast("decimal(10,7)").alias("latitude"),
        (F.col("n_nationkey") * 7 - 90).cast("decimal(10,7)").alias("longitude"),
        F.col("r_name").alias("market"),
        F.col("n_name").alias("order_country"),
        F.col("o_custkey").alias("order_customer_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        F.col("o_orderkey").alias("order_id"),
        F.col("p_partkey").alias("order_item_cardprod_id"),
        F.col("_discount").alias("order_item_discount"),
        rate.alias("order_item_discount_rate"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("p_retailprice").cast(MONEY).alias("order_item_product_price"),
        rounded(ratio(F.col("_profit"), F.col("_sales")), 4).cast("decimal(18,6)").alias("order_item_profit_ratio"),
        F.col("l_quantity").cast("int").alias("order_item_quantity"),
        F.col("_sales").alias("sales"),
        F.col("_sales").alias("order_item_total"),
        F.col("_profit").alias("order_profit_per_order"),
        F.col("r_name").alias("order_region"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipping_date"),
        _by_priority({"1-URGENT": "Same Day", "2-HIGH": "First Class", "3-MEDIUM": "Second Class"}, "Standard Class").alias(
            "shipping_mode"
        ),
        F.col("p_partkey").alias("product_card_id"),
        category.alias("product_category_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast(MONEY).alias("product_price"),
        F.lit(0).alias("product_status"),
    )


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """The same items as they look in the raw file: 53 text columns, original headers and labels."""
    items = order_items(spark, folder)
    labels = {"Late Delivery": "Late delivery", "Shipping On Time": "Shipping on time", "Advance Shipping": "Advance shipping"}
    status = F.col("delivery_status")
    for clean, raw in labels.items():
        status = F.when(F.col("delivery_status") == clean, raw).otherwise(status)
    special: dict[str, Column] = {
        "Type": F.col("payment_type"),
        "Benefit per order": F.col("order_profit"),
        "Delivery Status": status,
        "Customer Email": F.lit("XXXXXXXXX"),
        "Customer Password": F.lit("XXXXXXXXX"),
        "Customer Fname": F.lit("Customer"),
        "Customer Lname": F.col("customer_id"),
        "Days for shipping (real)": F.col("days_for_shipping_real"),
        "Days for shipment (scheduled)": F.col("days_for_shipment_scheduled"),
        "order date (DateOrders)": F.date_format("order_date", "M/d/yyyy H:mm"),
        "shipping date (DateOrders)": F.date_format("shipping_date", "M/d/yyyy H:mm"),
    }
    columns = []
    for header in RAW_HEADERS:
        name = header.lower().replace(" ", "_")
        value = special.get(header, F.col(name) if name in items.columns else F.lit(None))
        columns.append(value.cast("string").alias(header))
    return items.select(*columns)


def _by_priority(values: dict, default) -> Column:
    choice = F.lit(default)
    for priority, value in values.items():
        choice = F.when(F.col("o_orderpriority") == priority, value).otherwise(choice)
    return choice
