"""Common table expressions from the raw tables up to the star schema, and small SQL snippets."""

from __future__ import annotations

from freightlens.schemas import CLEAN_FIELDS, FACT_MEASURES, READY_FIELDS

LOADED_AT = "2024-01-01 00:00:00"
BATCH = "DATACO_20240101_000000_000000"
SOURCE_FILE = "order_items"


def dec(expr: str, digits: int = 2) -> str:
    """Half-up rounding in decimals."""
    return f"ROUND(CAST({expr} AS DECIMAL(38,10)), {digits})"


def r(expr: str, digits: int = 2) -> str:
    return f"CAST({dec(expr, digits)} AS DOUBLE)"


def total(column: str) -> str:
    return r(f"SUM({column})")


def mean(column: str) -> str:
    return f"(CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0))"


def avg(column: str, digits: int = 2) -> str:
    return r(mean(column), digits)


def rate(column: str) -> str:
    return r(f"{mean(column)} * 100")


def pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100)"


def margin(sales: str = "sales", profit: str = "order_profit_per_order") -> str:
    return r(pct(f"SUM({profit})", f"SUM({sales})"))


def plain(layout: dict[str, str], names=None, alias: str = "") -> str:
    """Select list with decimals as doubles, integers as bigint and timestamps as text."""
    out = []
    for name in names or layout:
        kind, column = layout[name], f"{alias}{name}"
        if kind.startswith("decimal"):
            out.append(f"CAST({column} AS DOUBLE) AS {name}")
        elif kind in ("int", "bigint"):
            out.append(f"CAST({column} AS BIGINT) AS {name}")
        elif kind == "timestamp_ntz":
            out.append(f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name}")
        elif kind == "date":
            out.append(f"strftime({column}, '%Y-%m-%d') AS {name}")
        else:
            out.append(f"{column} AS {name}")
    return ",\n  ".join(out)


ITEMS = f"""
items_source AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,4)) AS gross,
    CAST(ROUND(l_discount, 2) AS DECIMAL(12,6)) AS rate,
    CAST((l_suppkey + l_linenumber) % 7 AS INTEGER) AS real_days,
    CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS plan_days,
    CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS cat,
    CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(ROUND(l_discount, 2) AS DECIMAL(12,6)) AS DECIMAL(18,4)) AS disc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
items_priced AS (
  SELECT *, CAST(gross - disc AS DECIMAL(18,4)) AS net,
    CAST(gross - disc - CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS gain
  FROM items_source
),
items AS (
  SELECT l_returnflag AS payment_type, real_days AS days_for_shipping_real, plan_days AS days_for_shipment_scheduled,
    gain AS order_profit, net AS sales_per_customer,
    CASE WHEN real_days > plan_days THEN 'Late Delivery' WHEN real_days = plan_days THEN 'Shipping On Time'
         ELSE 'Advance Shipping' END AS delivery_status,
    CAST(real_days > plan_days AS INTEGER) AS late_delivery_risk,
    cat AS category_id, p_brand AS category_name, n_name AS customer_country, o_custkey AS customer_id,
    c_mktsegment AS customer_segment, cat % 5 AS department_id, 'Department ' || (cat % 5) AS department_name,
    CAST(n_nationkey * 3 - 36 AS DECIMAL(10,7)) AS latitude, CAST(n_nationkey * 7 - 90 AS DECIMAL(10,7)) AS longitude,
    r_name AS market, n_name AS order_country, o_custkey AS order_customer_id, o_orderdate AS order_date,
    o_orderkey AS order_id, p_partkey AS order_item_cardprod_id, disc AS order_item_discount,
    rate AS order_item_discount_rate, l_orderkey * 10 + l_linenumber AS order_item_id,
    CAST(p_retailprice AS DECIMAL(18,4)) AS order_item_product_price,
    CAST({dec("CAST(gain AS DOUBLE) / NULLIF(CAST(net AS DOUBLE), 0)", 4)} AS DECIMAL(18,6)) AS order_item_profit_ratio,
    CAST(l_quantity AS INTEGER) AS order_item_quantity, net AS sales, net AS order_item_total,
    gain AS order_profit_per_order, r_name AS order_region, o_orderstatus AS order_status,
    l_shipdate AS shipping_date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
         WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS shipping_mode,
    p_partkey AS product_card_id, cat AS product_category_id, p_name AS product_name,
    CAST(p_retailprice AS DECIMAL(18,4)) AS product_price, 0 AS product_status
  FROM items_priced
)"""

# Columns the items have, in their order; the others stay NULL.
ITEM_COLUMNS = [
    "payment_type", "days_for_shipping_real", "days_for_shipment_scheduled", "order_profit", "sales_per_customer",
    "delivery_status", "late_delivery_risk", "category_id", "category_name", "customer_country", "customer_id",
    "customer_segment", "department_id", "department_name", "latitude", "longitude", "market", "order_country",
    "order_customer_id", "order_date", "order_id", "order_item_cardprod_id", "order_item_discount",
    "order_item_discount_rate", "order_item_id", "order_item_product_price", "order_item_profit_ratio",
    "order_item_quantity", "sales", "order_item_total", "order_profit_per_order", "order_region", "order_status",
    "shipping_date", "shipping_mode", "product_card_id", "product_category_id", "product_name", "product_price",
    "product_status",
]
ABSENT = [c for c in CLEAN_FIELDS if c not in ITEM_COLUMNS]
TIE_BREAK = ", ".join(f"{c} NULLS FIRST" for c in ITEM_COLUMNS)
FILLED = " + ".join(f"({c} IS NOT NULL)::INT" for c in ITEM_COLUMNS)


def title(column: str) -> str:
    """Capital after every non-letter; the place names here are letters, digits and '_'."""
    return f"upper({column}[1]) || lower({column}[2:])"


CLEAN = (
    ITEMS
    + f""",
clean AS (
  SELECT * REPLACE ({title('customer_country')} AS customer_country, {title('order_country')} AS order_country),
    {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ABSENT)}
  FROM (SELECT * FROM items
        QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY {FILLED} DESC, {TIE_BREAK}) = 1)
)"""
)

P, S = "order_profit_per_order", "sales"
ITEM_MARGIN = pct(P, S)

READY = (
    CLEAN
    + f""",
order_totals AS (
  SELECT order_id AS o_id, CAST(SUM(sales) AS DECIMAL(20,4)) AS order_total_sales,
    CAST(SUM({P}) AS DECIMAL(20,4)) AS order_total_profit, CAST(SUM(order_item_quantity) AS INTEGER) AS order_total_quantity,
    CAST(COUNT(order_item_id) AS INTEGER) AS order_item_count,
    {dec(pct(f"SUM({P})", "SUM(sales)"), 4)} AS order_profit_margin_pct
  FROM clean GROUP BY order_id
),
customer_totals AS (
  SELECT customer_id AS c_id, CAST(COUNT(DISTINCT order_id) AS INTEGER) AS customer_order_count,
    CAST(SUM(sales) AS DECIMAL(20,4)) AS customer_lifetime_sales, {dec(mean("sales"), 4)} AS customer_average_item_sales,
    CAST(SUM({P}) AS DECIMAL(20,4)) AS customer_lifetime_profit, MIN(order_date) AS customer_first_order_date,
    MAX(order_date) AS customer_last_order_date,
    CAST(floor((epoch(MAX(order_date)) - epoch(MIN(order_date))) / 86400) AS INTEGER) AS customer_tenure_days
  FROM clean GROUP BY customer_id
),
tiers AS (
  SELECT order_item_id AS t_id, row_number() OVER (ORDER BY sales, order_item_id) AS place, COUNT(*) OVER () AS n
  FROM clean WHERE sales IS NOT NULL
),
featured AS (
  SELECT *, days_for_shipping_real - days_for_shipment_scheduled AS delay, {ITEM_MARGIN} AS raw_margin,
    CASE WHEN abs(order_item_discount_rate) <= 1 THEN order_item_discount_rate * 100
         ELSE order_item_discount_rate END AS rate_pct,
    sales + order_item_discount AS gross_sales
  FROM clean JOIN order_totals ON order_id IS NOT DISTINCT FROM o_id
  JOIN customer_totals ON customer_id IS NOT DISTINCT FROM c_id LEFT JOIN tiers ON order_item_id = t_id
),
ready AS (
  SELECT {", ".join(CLEAN_FIELDS)},
    delay AS shipping_delay_days,
    CASE WHEN delay > 0 THEN 'Late' WHEN delay = 0 THEN 'On Schedule' WHEN delay < 0 THEN 'Early' ELSE 'Unknown' END
      AS delivery_performance,
    CAST(delay > 0 AS INTEGER) AS is_late_delivery,
    {dec("raw_margin", 4)} AS profit_margin_pct,
    gross_sales AS gross_sales_before_discount,
    CASE WHEN {P} > 0 THEN 'Profitable' WHEN {P} = 0 THEN 'Break Even' WHEN {P} < 0 THEN 'Loss' ELSE 'Unknown' END
      AS profitability_status,
    year(order_date) AS order_year, 'Q' || quarter(order_date) AS order_quarter, month(order_date) AS order_month,
    monthname(order_date) AS order_month_name, weekofyear(order_date) AS order_week, dayname(order_date) AS order_day_name,
    CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
    CAST(strftime(shipping_date, '%Y%m%d') AS INTEGER) AS shipping_date_key,
    quarter(order_date) AS order_quarter_number, strftime(order_date, '%Y-%m') AS order_year_month,
    day(order_date) AS order_day, CAST(isodow(order_date) IN (6, 7) AS INTEGER) AS is_weekend_order,
    strftime(shipping_date, '%Y-%m') AS shipping_year_month,
    abs(delay) AS absolute_schedule_variance_days, CAST(delay <= 0 AS INTEGER) AS is_on_time_delivery,
    CASE WHEN days_for_shipment_scheduled > 0
         THEN {dec("CAST(days_for_shipping_real AS DOUBLE) / days_for_shipment_scheduled", 6)} END AS shipping_efficiency_ratio,
    CASE WHEN delay IS NULL THEN 'Unknown' WHEN delay < 0 THEN 'Early' WHEN delay = 0 THEN 'On Schedule'
         WHEN delay = 1 THEN '1 Day Late' WHEN delay <= 3 THEN '2–3 Days Late' ELSE '4+ Days Late' END AS delivery_delay_severity,
    CASE WHEN days_for_shipping_real IS NULL THEN 'Unknown' WHEN days_for_shipping_real <= 2 THEN 'Express'
         WHEN days_for_shipping_real <= 4 THEN 'Standard' WHEN days_for_shipping_real <= 6 THEN 'Slow'
         ELSE 'Very Slow' END AS shipping_speed_segment,
    CASE WHEN gross_sales > 0 THEN {dec(pct("order_item_discount", "gross_sales"), 4)} END AS discount_pct_calculated,
    CAST(rate_pct AS DECIMAL(18,6)) AS discount_rate_pct,
    CAST(coalesce({P} > 0, false) AS INTEGER) AS is_profitable_item, CAST(coalesce({P} < 0, false) AS INTEGER) AS is_loss_item,
    CASE WHEN (SELECT COUNT(DISTINCT sales) FROM clean) < 4 OR place IS NULL THEN NULL
         WHEN place <= 1 + (n - 1) / 4.0 THEN 'Low' WHEN place <= 1 + (n - 1) / 2.0 THEN 'Medium'
         WHEN place <= 1 + 3 * (n - 1) / 4.0 THEN 'High' ELSE 'Premium' END AS sales_value_tier,
    CASE WHEN raw_margin IS NULL THEN NULL WHEN raw_margin <= 0 THEN 'Negative' WHEN raw_margin <= 10 THEN '0–10%'
         WHEN raw_margin <= 20 THEN '10–20%' WHEN raw_margin <= 30 THEN '20–30%' ELSE '30%+' END AS margin_band,
    CASE WHEN rate_pct IS NULL THEN NULL WHEN rate_pct <= 0 THEN 'No Discount' WHEN rate_pct <= 5 THEN '0–5%'
         WHEN rate_pct <= 10 THEN '5–10%' WHEN rate_pct <= 20 THEN '10–20%' ELSE '20%+' END AS discount_band,
    order_total_sales, order_total_profit, order_total_quantity, order_item_count, order_profit_margin_pct,
    customer_order_count, customer_lifetime_sales, customer_average_item_sales, customer_lifetime_profit,
    customer_first_order_date, customer_last_order_date, customer_tenure_days,
    CASE WHEN customer_order_count < 1 THEN NULL WHEN customer_order_count = 1 THEN 'One-Time'
         WHEN customer_order_count = 2 THEN 'Occasional' WHEN customer_order_count <= 5 THEN 'Repeat'
         WHEN customer_order_count <= 10 THEN 'Loyal' ELSE 'VIP' END AS customer_frequency_segment,
    CAST(coalesce(delay > 0, false) OR coalesce({P} < 0, false) AS INTEGER) AS requires_management_attention,
    CASE WHEN delay > 0 AND {P} < 0 THEN 'Late and Loss' WHEN delay > 0 THEN 'Late Only'
         WHEN delay <= 0 AND {P} < 0 THEN 'Loss Only' ELSE 'Healthy' END AS operational_risk_segment
  FROM featured
),
stg AS (
  SELECT *, '{SOURCE_FILE}' AS source_file_name, '{BATCH}' AS load_batch_id, TIMESTAMP '{LOADED_AT}' AS loaded_at FROM ready
)"""
)


def highest(columns: str) -> str:
    return ", ".join(f"MAX({c.strip()}) AS {c.strip()}" for c in columns.split(","))


DIMS = (
    READY
    + f""",
dim_customer AS (
  SELECT 0 AS customer_key, CAST(NULL AS BIGINT) AS customer_id, 'Unknown' AS customer_segment, 'Unknown' AS customer_city,
    'Unknown' AS customer_state, 'Unknown' AS customer_country, 'Unknown' AS customer_zipcode,
    NULL AS customer_order_count, NULL AS customer_lifetime_sales, NULL AS customer_average_item_sales,
    NULL AS customer_lifetime_profit, NULL AS customer_first_order_date, NULL AS customer_last_order_date,
    NULL AS customer_tenure_days, 'Unknown' AS customer_frequency_segment, 'System' AS record_source
  UNION ALL
  SELECT row_number() OVER (ORDER BY customer_id), customer_id,
    {highest("customer_segment, customer_city, customer_state, customer_country, customer_zipcode, customer_order_count, customer_lifetime_sales, customer_average_item_sales, customer_lifetime_profit")},
    MIN(customer_first_order_date), MAX(customer_last_order_date), MAX(customer_tenure_days),
    MAX(customer_frequency_segment), 'DataCo'
  FROM stg WHERE customer_id IS NOT NULL GROUP BY customer_id
),
dim_category AS (
  SELECT 0 AS category_key, CAST(NULL AS INTEGER) AS category_id, 'Unknown' AS category_name,
    CAST(NULL AS INTEGER) AS department_id, 'Unknown' AS department_name, 'System' AS record_source
  UNION ALL
  SELECT row_number() OVER (ORDER BY category_id), category_id, {highest("category_name, department_id, department_name")}, 'DataCo'
  FROM stg WHERE category_id IS NOT NULL GROUP BY category_id
),
dim_product AS (
  SELECT 0 AS product_key, CAST(NULL AS BIGINT) AS product_card_id, 'Unknown' AS product_name,
    CAST(NULL AS DECIMAL(18,4)) AS product_price, CAST(NULL AS INTEGER) AS product_status,
    CAST(NULL AS INTEGER) AS product_category_id, 'Unknown' AS category_name, 'Unknown' AS department_name,
    'System' AS record_source
  UNION ALL
  SELECT row_number() OVER (ORDER BY product_card_id), product_card_id,
    {highest("product_name, product_price, product_status, product_category_id, category_name, department_name")}, 'DataCo'
  FROM stg WHERE product_card_id IS NOT NULL GROUP BY product_card_id
),
all_days AS (
  SELECT CAST(order_date AS DATE) AS d FROM stg UNION SELECT CAST(shipping_date AS DATE) FROM stg
  UNION SELECT CAST(customer_first_order_date AS DATE) FROM stg UNION SELECT CAST(customer_last_order_date AS DATE) FROM stg
),
dim_date AS (
  SELECT 0 AS date_key, CAST(NULL AS DATE) AS full_date, NULL AS calendar_year, NULL AS calendar_quarter, 'NA' AS quarter_name,
    NULL AS calendar_month, 'Unknown' AS month_name, '0000-00' AS calendar_year_month, NULL AS week_of_year,
    NULL AS day_of_month, NULL AS day_of_week, 'Unknown' AS day_name, 0 AS is_weekend, 'System' AS record_source
  UNION ALL
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER), d, year(d), quarter(d), 'Q' || quarter(d), month(d), monthname(d),
    strftime(d, '%Y-%m'), weekofyear(d), day(d), isodow(d), dayname(d), CAST(isodow(d) IN (6, 7) AS INTEGER), 'DataCo'
  FROM all_days WHERE d IS NOT NULL
),
dim_shipping_mode AS (
  SELECT 0 AS shipping_mode_key, 'Unknown' AS shipping_mode, 'Unknown' AS service_level_group,
    CAST(NULL AS DECIMAL(10,2)) AS default_scheduled_days, 'System' AS record_source
  UNION ALL
  SELECT row_number() OVER (ORDER BY shipping_mode), shipping_mode,
    CASE WHEN lower(shipping_mode) LIKE '%same day%' THEN 'Same Day' WHEN lower(shipping_mode) LIKE '%first class%' THEN 'Expedited'
         WHEN lower(shipping_mode) LIKE '%second class%' THEN 'Standard Plus' WHEN lower(shipping_mode) LIKE '%standard%' THEN 'Standard'
         ELSE 'Other' END,
    CAST({dec(mean("days_for_shipment_scheduled"))} AS DECIMAL(10,2)), 'DataCo'
  FROM stg WHERE shipping_mode IS NOT NULL GROUP BY shipping_mode
),
stg_geo AS (
  SELECT *, sha256(concat_ws('|', coalesce(trim(market), 'Unknown'), coalesce(trim(order_region), 'Unknown'),
      coalesce(trim(order_country), 'Unknown'), coalesce(trim(order_state), 'Unknown'), coalesce(trim(order_city), 'Unknown'),
      coalesce(CAST(CAST(latitude AS DECIMAL(10,6)) AS VARCHAR), 'Unknown'),
      coalesce(CAST(CAST(longitude AS DECIMAL(10,6)) AS VARCHAR), 'Unknown'))) AS geo_hash FROM stg
),
dim_geography AS (
  SELECT 0 AS geography_key, repeat('0', 64) AS geography_natural_key, 'Unknown' AS market, 'Unknown' AS order_region,
    'Unknown' AS order_country, 'Unknown' AS order_state, 'Unknown' AS order_city,
    CAST(NULL AS DECIMAL(10,6)) AS latitude, CAST(NULL AS DECIMAL(10,6)) AS longitude, 'System' AS record_source
  UNION ALL
  SELECT row_number() OVER (ORDER BY geo_hash), geo_hash, market, order_region, order_country, order_state, order_city,
    latitude, longitude, 'DataCo'
  FROM (SELECT DISTINCT geo_hash, coalesce(trim(market), 'Unknown') AS market, coalesce(trim(order_region), 'Unknown') AS order_region,
          coalesce(trim(order_country), 'Unknown') AS order_country, coalesce(trim(order_state), 'Unknown') AS order_state,
          coalesce(trim(order_city), 'Unknown') AS order_city, CAST(latitude AS DECIMAL(10,6)) AS latitude,
          CAST(longitude AS DECIMAL(10,6)) AS longitude FROM stg_geo)
)"""
)

MEASURES = [c for c in FACT_MEASURES if c != "staging_row_id"]

RESOLVED = f"""
resolved AS (
  SELECT s.* EXCLUDE (order_date_key, shipping_date_key), c.customer_key, p.product_key, k.category_key,
    od.date_key AS order_date_key, sd.date_key AS shipping_date_key, m.shipping_mode_key, g.geography_key
  FROM stg_geo s LEFT JOIN dim_customer c ON c.customer_id = s.customer_id
  LEFT JOIN dim_product p ON p.product_card_id = s.product_card_id
  LEFT JOIN dim_category k ON k.category_id = s.category_id
  LEFT JOIN dim_date od ON od.full_date = CAST(s.order_date AS DATE)
  LEFT JOIN dim_date sd ON sd.full_date = CAST(s.shipping_date AS DATE)
  LEFT JOIN dim_shipping_mode m ON m.shipping_mode = s.shipping_mode
  LEFT JOIN dim_geography g ON g.geography_natural_key = s.geo_hash
)"""

KEYS = ["customer_key", "product_key", "category_key", "order_date_key", "shipping_date_key", "shipping_mode_key", "geography_key"]

STAR = (
    DIMS
    + ","
    + RESOLVED
    + f""",
fact AS (
  SELECT order_item_id AS fact_order_item_key, {", ".join(f"CAST(coalesce({k}, 0) AS BIGINT) AS {k}" for k in KEYS)},
    {", ".join(MEASURES)}, TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM resolved
)"""
)

FACT_FIELDS = {"fact_order_item_key": "bigint", **{k: "bigint" for k in KEYS}}
FACT_FIELDS.update({c: {**READY_FIELDS, "source_file_name": "string", "load_batch_id": "string"}[c] for c in MEASURES})
FACT_FIELDS["loaded_at"] = "timestamp_ntz"


def on_items(body: str) -> str:
    return f"WITH {ITEMS}\n{body}"


def on_clean(body: str) -> str:
    return f"WITH {CLEAN}\n{body}"


def on_stg(body: str, extra: str = "") -> str:
    return f"WITH {READY}{extra}\n{body}"


def on_dims(body: str, extra: str = "") -> str:
    return f"WITH {DIMS}{extra}\n{body}"


def on_star(body: str, extra: str = "") -> str:
    return f"WITH {STAR}{extra}\n{body}"
