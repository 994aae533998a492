"""Table layouts. Column names and types are fixed values: results must carry exactly these."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The 53 headers of the raw order-item file, in file order.
RAW_HEADERS = [
    "Type", "Days for shipping (real)", "Days for shipment (scheduled)", "Benefit per order",
    "Sales per customer", "Delivery Status", "Late_delivery_risk", "Category Id", "Category Name",
    "Customer City", "Customer Country", "Customer Email", "Customer Fname", "Customer Id",
    "Customer Lname", "Customer Password", "Customer Segment", "Customer State", "Customer Street",
    "Customer Zipcode", "Department Id", "Department Name", "Latitude", "Longitude", "Market",
    "Order City", "Order Country", "Order Customer Id", "order date (DateOrders)", "Order Id",
    "Order Item Cardprod Id", "Order Item Discount", "Order Item Discount Rate", "Order Item Id",
    "Order Item Product Price", "Order Item Profit Ratio", "Order Item Quantity", "Sales",
    "Order Item Total", "Order Profit Per Order", "Order Region", "Order State", "Order Status",
    "Order Zipcode", "Product Card Id", "Product Category Id", "Product Description", "Product Image",
    "Product Name", "Product Price", "Product Status", "shipping date (DateOrders)", "Shipping Mode",
]

# The 85 headers of the analytics-ready file, in file order.
READY_HEADERS = [
    "payment_type", "days_for_shipping", "days_for_shipment", "order_profit", "sales_per_customer",
    "delivery_status", "late_delivery_risk", "category_id", "category_name", "customer_city",
    "customer_country", "customer_id", "customer_segment", "customer_state", "customer_zipcode",
    "department_id", "department_name", "latitude", "longitude", "market", "order_city",
    "order_country", "order_customer_id", "order_date", "order_id", "order_item_cardprod_id",
    "order_item_discount", "order_item_discount_rate", "order_item_id", "order_item_product_price",
    "order_item_profit_ratio", "order_item_quantity", "sales", "order_item_total",
    "order_profit_per_order", "order_region", "order_state", "order_status", "order_zipcode",
    "product_card_id", "product_category_id", "product_name", "product_price", "product_status",
    "shipping_date", "shipping_mode", "is_late_delivery", "profit_margin_pct",
    "gross_sales_before_discount", "profitability_status", "order_year", "order_quarter",
    "order_month", "order_month_name", "order_week", "order_day", "order_day_name",
    "order_date_key", "shipping_date_key", "order_quarter_number", "order_year_month",
    "is_weekend_order", "shipping_year_month", "discount_pct_calculated", "discount_rate_pct",
    "is_profitable_item", "is_loss_item", "sales_value_tier", "margin_band", "discount_band",
    "order_total_sales", "order_total_profit", "order_total_quantity", "order_item_count",
    "order_profit_margin_pct", "customer_order_count", "customer_lifetime_sales",
    "customer_average_item_sales", "customer_lifetime_profit", "customer_first_order_date",
    "customer_last_order_date", "customer_tenure_days", "customer_frequency_segment",
    "requires_management_attention", "operational_risk_segment",
]

# Fixed values. Cleaned order items: the 46 source columns after renaming, order_zipcode left out.
CLEAN = """
payment_type string, days_for_shipping_real int, days_for_shipment_scheduled int,
order_profit decimal(18,4), sales_per_customer decimal(18,4), delivery_status string,
late_delivery_risk int, category_id int, category_name string, customer_city string,
customer_country string, customer_id bigint, customer_segment string, customer_state string,
customer_zipcode string, department_id int, department_name string, latitude decimal(10,7),
longitude decimal(10,7), market string, order_city string, order_country string,
order_customer_id bigint, order_date timestamp_ntz, order_id bigint, order_item_cardprod_id bigint,
order_item_discount decimal(18,4), order_item_discount_rate decimal(12,6), order_item_id bigint,
order_item_product_price decimal(18,4), order_item_profit_ratio decimal(18,6),
order_item_quantity int, sales decimal(18,4), order_item_total decimal(18,4),
order_profit_per_order decimal(18,4), order_region string, order_state string,
order_status string, shipping_date timestamp_ntz, shipping_mode string, product_card_id bigint,
product_category_id int, product_name string, product_price decimal(18,4), product_status int
"""

FEATURES = """
shipping_delay_days int, delivery_performance string, is_late_delivery int,
profit_margin_pct decimal(18,6), gross_sales_before_discount decimal(18,4),
profitability_status string, order_year int, order_quarter string, order_month int,
order_month_name string, order_week int, order_day_name string, order_date_key int,
shipping_date_key int, order_quarter_number int, order_year_month string, order_day int,
is_weekend_order int, shipping_year_month string, absolute_schedule_variance_days int,
is_on_time_delivery int, shipping_efficiency_ratio decimal(18,6), delivery_delay_severity string,
shipping_speed_segment string, discount_pct_calculated decimal(18,6),
discount_rate_pct decimal(18,6), is_profitable_item int, is_loss_item int,
sales_value_tier string, margin_band string, discount_band string,
order_total_sales decimal(20,4), order_total_profit decimal(20,4), order_total_quantity int,
order_item_count int, order_profit_margin_pct decimal(18,6), customer_order_count int,
customer_lifetime_sales decimal(20,4), customer_average_item_sales decimal(18,4),
customer_lifetime_profit decimal(20,4), customer_first_order_date timestamp_ntz,
customer_last_order_date timestamp_ntz, customer_tenure_days int,
customer_frequency_segment string, requires_management_attention int,
operational_risk_segment string
"""

LOAD_COLUMNS = "staging_row_id bigint, source_file_name string, load_batch_id string, loaded_at timestamp_ntz"

FACT_KEYS = """
customer_key bigint, product_key bigint, category_key bigint, order_date_key int,
shipping_date_key int, shipping_mode_key bigint, geography_key bigint
"""

FACT_MEASURES = [
    "order_item_id", "order_id", "order_customer_id", "order_item_cardprod_id", "payment_type",
    "delivery_status", "order_status", "order_item_quantity", "sales", "sales_per_customer",
    "order_item_total", "order_item_product_price", "product_price", "order_item_discount",
    "order_item_discount_rate", "discount_pct_calculated", "discount_rate_pct",
    "gross_sales_before_discount", "order_profit", "order_profit_per_order",
    "order_item_profit_ratio", "profit_margin_pct", "profitability_status", "is_profitable_item",
    "is_loss_item", "days_for_shipping_real", "days_for_shipment_scheduled", "shipping_delay_days",
    "absolute_schedule_variance_days", "shipping_efficiency_ratio", "late_delivery_risk",
    "is_late_delivery", "is_on_time_delivery", "delivery_performance", "delivery_delay_severity",
    "shipping_speed_segment", "order_total_sales", "order_total_profit", "order_total_quantity",
    "order_item_count", "order_profit_margin_pct", "customer_order_count",
    "customer_lifetime_sales", "customer_average_item_sales", "customer_lifetime_profit",
    "customer_tenure_days", "customer_frequency_segment", "sales_value_tier", "margin_band",
    "discount_band", "requires_management_attention", "operational_risk_segment",
    "source_file_name", "load_batch_id", "staging_row_id",
]

RUN_LOG = """
etl_run_id string, pipeline_name string, source_file_name string, process_name string,
process_status string, rows_read bigint, rows_inserted bigint, rows_rejected bigint,
started_at timestamp_ntz, completed_at timestamp_ntz, error_message string
"""


def fields(layout: str) -> dict[str, str]:
    """Column name → type of a layout string."""
    return dict(re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", layout))


CLEAN_FIELDS = fields(CLEAN)
READY_FIELDS = {**CLEAN_FIELDS, **fields(FEATURES)}
STAGING_FIELDS = {**fields(LOAD_COLUMNS), **READY_FIELDS}
FACT_FIELDS = {
    "fact_order_item_key": "bigint", **fields(FACT_KEYS), **{c: STAGING_FIELDS[c] for c in FACT_MEASURES}, "loaded_at": "timestamp_ntz",
}


def conform(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Exactly the layout's columns and types; columns the input lacks are NULL."""
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in layout.items()]
    )
