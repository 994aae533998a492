"""Dimensions, fact and the checks on them."""

from freightlens.plans.dims import DIMENSIONS
from freightlens.schemas import fields
from oracle.base import FACT_FIELDS, P, READY, avg, highest, margin, on_dims, on_star, plain, r, rate, total

BODIES, OVER_DIMS = {}, {}


def dim_layout(name: str) -> dict[str, str]:
    d = DIMENSIONS[name]
    return {d.key: "bigint", **fields(d.attributes), "record_source": "string"}


for _name in DIMENSIONS:
    OVER_DIMS[f"{_name}_load"] = f"SELECT {plain(dim_layout(_name))} FROM {_name}"

OVER_DIMS["dim_row_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS dimension_name, COUNT(*) AS total_rows, COUNT(*) - 1 AS business_members FROM {n}" for n in DIMENSIONS
)
OVER_DIMS["dim_key_uniqueness"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS dimension_name, COUNT(*) AS business_rows, COUNT(DISTINCT {DIMENSIONS[n].natural}) AS distinct_natural_keys,
    CASE WHEN COUNT(*) = COUNT(DISTINCT {DIMENSIONS[n].natural}) THEN 'PASS' ELSE 'FAIL' END AS uniqueness_status
    FROM {n} WHERE {DIMENSIONS[n].key} <> 0""" for n in ("dim_customer", "dim_category", "dim_product")
)

LABELS = {"customer": "customer_key", "product": "product_key", "category": "category_key", "order_date": "order_date_key",
          "shipping_date": "shipping_date_key", "shipping_mode": "shipping_mode_key", "geography": "geography_key"}
PLURAL = {"customer": "customers", "product": "products", "category": "categories", "order_date": "order_dates",
          "shipping_date": "shipping_dates", "shipping_mode": "shipping_modes", "geography": "geographies"}
_unresolved = ", ".join(f"COUNT(*) FILTER (WHERE {k} IS NULL) AS unresolved_{PLURAL[n]}" for n, k in LABELS.items())
_none = " AND ".join(f"unresolved_{p} = 0" for p in PLURAL.values())
BODIES["dim_resolution"] = f"""SELECT *, CASE WHEN {_none} THEN 'READY FOR FACT LOAD' ELSE 'REVIEW UNRESOLVED MEMBERS' END AS dimension_readiness,
  CASE WHEN {_none} THEN 'PASS' ELSE 'REVIEW BEFORE FACT LOAD' END AS dimension_resolution_status FROM (SELECT {_unresolved} FROM resolved)"""
BODIES["fact_load"] = f"SELECT {plain(FACT_FIELDS)} FROM fact"
_unknown = " OR ".join(f"{k} = 0" for k in LABELS.values())
COUNTS = """COUNT(*) AS fact_rows, COUNT(DISTINCT order_item_id) AS unique_order_item_ids,
  COUNT(*) - COUNT(DISTINCT order_item_id) AS duplicate_rows"""
_ok = "fact_rows = (SELECT COUNT(*) FROM stg) AND unique_order_item_ids = (SELECT COUNT(*) FROM stg)"
BODIES["fact_load_status"] = f"""SELECT * EXCLUDE (ok), CASE WHEN ok THEN 'SUCCESS' WHEN fact_rows > 0 THEN 'WARNING' ELSE 'FAILED' END AS etl_status,
  CASE WHEN ok THEN 'FACT LOAD COMPLETE' ELSE 'REVIEW FACT LOAD' END AS final_fact_readiness FROM (
    SELECT *, {_ok} AND duplicate_rows = 0 AND rows_with_unknown_dimension_key = 0 AS ok FROM (
      SELECT {COUNTS}, COUNT(*) FILTER (WHERE {_unknown}) AS rows_with_unknown_dimension_key FROM fact))"""
BODIES["fact_grain_check"] = f"""SELECT *, CASE WHEN {_ok} THEN 'PASS' ELSE 'FAIL' END AS grain_and_volume_status
  FROM (SELECT {COUNTS} FROM fact)"""
_zero = ", ".join(f"COUNT(*) FILTER (WHERE {k} = 0) AS unknown_{n}_keys" for n, k in LABELS.items())
BODIES["fact_unknown_keys"] = f"""SELECT *, CASE WHEN {" AND ".join(f"unknown_{n}_keys = 0" for n in LABELS)} THEN 'PASS' ELSE 'REVIEW' END
  AS dimension_key_status FROM (SELECT {_zero} FROM fact)"""
_dim = {"customer": ("dim_customer", "customer_key"), "product": ("dim_product", "product_key"), "category": ("dim_category", "category_key"),
        "order_date": ("dim_date", "date_key"), "shipping_date": ("dim_date", "date_key"),
        "shipping_mode": ("dim_shipping_mode", "shipping_mode_key"), "geography": ("dim_geography", "geography_key")}
BODIES["fact_orphans"] = "SELECT COUNT(*) AS fact_rows, " + ", ".join(
    f"(SELECT COUNT(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {_dim[n][0]} d WHERE d.{_dim[n][1]} = f.{k})) AS orphan_{n}_keys"
    for n, k in LABELS.items()
) + " FROM fact"
BODIES["fact_reconcile"] = f"""SELECT staging_rows, fact_rows, {r('s1')} AS staging_sales, {r('s2')} AS fact_sales, {r('s2 - s1')} AS sales_difference,
  {r('p1')} AS staging_profit, {r('p2')} AS fact_profit, {r('p2 - p1')} AS profit_difference,
  CASE WHEN staging_rows = fact_rows AND abs(s2 - s1) <= 0.01 AND abs(p2 - p1) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS reconciliation_status
  FROM (SELECT COUNT(*) AS staging_rows, SUM(sales) AS s1, SUM({P}) AS p1 FROM stg),
    (SELECT COUNT(*) AS fact_rows, SUM(sales) AS s2, SUM({P}) AS p2 FROM fact)"""
BODIES["fact_summary"] = f"""SELECT COUNT(*) AS order_item_rows, COUNT(DISTINCT order_id) AS distinct_orders,
  COUNT(DISTINCT customer_key) AS represented_customer_keys, COUNT(DISTINCT product_key) AS represented_product_keys,
  COUNT(DISTINCT category_key) AS represented_category_keys, {total('sales')} AS total_sales, {total(P)} AS total_profit,
  {margin()} AS overall_profit_margin_pct, {avg('days_for_shipping_real')} AS average_actual_shipping_days,
  {rate('is_late_delivery')} AS late_delivery_rate_pct FROM fact"""
BODIES["fact_star_sample"] = f"""SELECT order_item_id, order_id, strftime(od.full_date, '%Y-%m-%d') AS order_date,
  strftime(sd.full_date, '%Y-%m-%d') AS shipping_date, customer_segment, product_name, k.category_name, shipping_mode, market,
  order_country, CAST(sales AS DOUBLE) AS sales, CAST({P} AS DOUBLE) AS {P}, CAST(is_late_delivery AS BIGINT) AS is_late_delivery
  FROM fact JOIN dim_customer USING (customer_key) JOIN dim_product p USING (product_key) JOIN dim_category k USING (category_key)
  JOIN dim_date od ON od.date_key = order_date_key JOIN dim_date sd ON sd.date_key = shipping_date_key
  JOIN dim_shipping_mode USING (shipping_mode_key) JOIN dim_geography USING (geography_key)
  ORDER BY fact_order_item_key LIMIT 20"""
RULES = {
    "fact": [("order_item_quantity > 0", "order_item_quantity <= 0")] + [
        (f"{c} in (0, 1)", f"{c} NOT IN (0, 1)") for c in
        ("is_late_delivery", "is_on_time_delivery", "is_profitable_item", "is_loss_item", "requires_management_attention")],
    "dim_product": [("product_status in (0, 1)", "product_status NOT IN (0, 1)")],
    "dim_date": [("calendar_month between 1 and 12", "calendar_month NOT BETWEEN 1 AND 12"),
                 ("calendar_quarter between 1 and 4", "calendar_quarter NOT BETWEEN 1 AND 4"),
                 ("is_weekend in (0, 1)", "coalesce(is_weekend NOT IN (0, 1), true)")],
    "dim_geography": [("latitude between -90 and 90", "latitude NOT BETWEEN -90 AND 90"),
                      ("longitude between -180 and 180", "longitude NOT BETWEEN -180 AND 180")],
}
BODIES["fact_constraints"] = "SELECT *, CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM (" + " UNION ALL ".join(
    f"""SELECT '{"fact_order_item" if t == "fact" else t}' AS table_name, '{n}' AS "constraint", COUNT(*) FILTER (WHERE {c}) AS failed_rows FROM {t}"""
    for t, rules in RULES.items() for n, c in rules
) + ")"
_LABEL = {"dim_customer": "customer_segment", "dim_category": "category_name", "dim_product": "product_name", "dim_date": "month_name",
          "dim_shipping_mode": "shipping_mode", "dim_geography": "market"}
_USES = {"dim_customer": "customer_key = 0", "dim_category": "category_key = 0", "dim_product": "product_key = 0",
         "dim_date": "order_date_key = 0 OR shipping_date_key = 0", "dim_shipping_mode": "shipping_mode_key = 0",
         "dim_geography": "geography_key = 0"}
BODIES["dim_unknown_member"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS dimension_name, CAST({d.key} AS BIGINT) AS member_key, {_LABEL[n]} AS label, record_source,
    (SELECT COUNT(*) FROM fact WHERE {_USES[n]}) AS fact_rows FROM {n} WHERE {d.key} = 0""" for n, d in DIMENSIONS.items()
)

# Customers of the orders up to a year load first, all customers load second: keys given out first stay.
UPSERT_BEFORE = 1996
_c = "customer_segment, customer_city, customer_state, customer_country, customer_zipcode, customer_order_count, customer_lifetime_sales, customer_average_item_sales, customer_lifetime_profit"
UPSERT = f"""WITH {READY},
members AS (SELECT customer_id, {highest(_c)}, MIN(customer_first_order_date) AS customer_first_order_date,
  MAX(customer_last_order_date) AS customer_last_order_date, MAX(customer_tenure_days) AS customer_tenure_days,
  MAX(customer_frequency_segment) AS customer_frequency_segment, bool_or(order_year < {UPSERT_BEFORE}) AS early
  FROM stg WHERE customer_id IS NOT NULL GROUP BY customer_id),
keyed AS (SELECT *, row_number() OVER (ORDER BY NOT early, customer_id) AS customer_key, 'DataCo' AS record_source FROM members
  UNION ALL SELECT NULL, 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Unknown', NULL, 0, 'System')
SELECT {plain(dim_layout("dim_customer"))} FROM keyed"""

STAR = {n: on_star(b) for n, b in BODIES.items()} | {n: on_dims(b) for n, b in OVER_DIMS.items()} | {"dim_upsert": UPSERT}
