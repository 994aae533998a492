"""Staging quality checks."""

from oracle.base import P, avg, margin, on_items, on_stg, pct, rate, total


def rules(conditions: dict[str, str], status: str) -> str:
    sums = ", ".join(f"CAST(SUM(CAST({c} AS INTEGER)) AS BIGINT) AS {n}" for n, c in conditions.items())
    ok = " AND ".join(f"{n} = 0" for n in conditions)
    return f"SELECT *, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS {status} FROM (SELECT {sums} FROM stg)"


N = "(SELECT COUNT(*) FROM stg)"
VOLUME = """COUNT(*) AS total_rows, COUNT(DISTINCT order_item_id) AS unique_order_item_ids,
  COUNT(*) - COUNT(DISTINCT order_item_id) AS duplicate_rows"""


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


RANGE = f"""{day('MIN(order_date)')} AS minimum_order_date, {day('MAX(order_date)')} AS maximum_order_date,
  {day('MIN(shipping_date)')} AS minimum_shipping_date, {day('MAX(shipping_date)')} AS maximum_shipping_date"""
NULL_DATES = """CAST(SUM(CAST(order_date IS NULL AS INTEGER)) AS BIGINT) AS null_order_dates,
  CAST(SUM(CAST(shipping_date IS NULL AS INTEGER)) AS BIGINT) AS null_shipping_dates"""
REAL, PLAN = "days_for_shipping_real", "days_for_shipment_scheduled"
LATE = f"is_late_delivery <> CASE WHEN {REAL} > {PLAN} THEN 1 ELSE 0 END"
STATUS = f"""profitability_status <> CASE WHEN {P} > 0 THEN 'Profitable' WHEN {P} = 0 THEN 'Break Even'
  WHEN {P} < 0 THEN 'Loss' ELSE 'Unknown' END"""

BODIES = {
    "dq_01_latest_batch": f"""SELECT MAX(load_batch_id) AS latest_batch_id, COUNT(*) AS latest_batch_rows,
      {day('MIN(loaded_at)')} AS load_started_at, {day('MAX(loaded_at)')} AS load_completed_at FROM stg""",
    "dq_02_volume_unique": f"""SELECT *, CASE WHEN total_rows = {N} AND unique_order_item_ids = {N} THEN 'PASS' ELSE 'FAIL' END
      AS volume_and_uniqueness_status FROM (SELECT {VOLUME} FROM stg)""",
    "dq_03_completeness": rules(
        {
            "missing_order_item_id": "order_item_id IS NULL", "missing_order_id": "order_id IS NULL",
            "missing_customer_id": "customer_id IS NULL", "missing_product_card_id": "product_card_id IS NULL",
            "missing_category_id": "category_id IS NULL", "missing_order_date": "order_date IS NULL",
            "missing_shipping_date": "shipping_date IS NULL", "missing_sales": "sales IS NULL",
            "missing_quantity": "order_item_quantity IS NULL",
        },
        "completeness_status",
    ),
    "dq_05_dates": f"""SELECT * EXCLUDE (n), CASE WHEN valid_order_dates = n AND valid_shipping_dates = n
        AND shipping_before_order = 0 THEN 'PASS' ELSE 'FAIL' END AS date_quality_status FROM (
      SELECT COUNT(*) AS n, COUNT(order_date) AS valid_order_dates, COUNT(shipping_date) AS valid_shipping_dates, {NULL_DATES},
        CAST(SUM(CAST(shipping_date < order_date AS INTEGER)) AS BIGINT) AS shipping_before_order, {RANGE} FROM stg)""",
    "dq_06_numeric_rules": rules(
        {
            "negative_sales": "sales < 0", "invalid_quantity": "order_item_quantity <= 0",
            "negative_item_price": "order_item_product_price < 0", "negative_product_price": "product_price < 0",
            "negative_discount": "order_item_discount < 0", "negative_actual_shipping_days": f"{REAL} < 0",
            "negative_scheduled_shipping_days": f"{PLAN} < 0",
        },
        "numeric_rule_status",
    ),
    "dq_07_discount_rate": rules(
        {
            "invalid_raw_discount_rate": "(order_item_discount_rate < 0 OR order_item_discount_rate > 1)",
            "invalid_discount_rate_pct": "(discount_rate_pct < 0 OR discount_rate_pct > 100)",
        },
        "discount_rate_status",
    ),
    "dq_08_geo_range": rules(
        {"invalid_latitude": "(latitude < -90 OR latitude > 90)", "invalid_longitude": "(longitude < -180 OR longitude > 180)"},
        "geography_status",
    ),
    "dq_09_shipping_features": rules(
        {
            "invalid_shipping_delay": f"(abs(shipping_delay_days - ({REAL} - {PLAN})) > 0.0001)",
            "invalid_late_delivery_flag": f"({LATE})",
            "invalid_on_time_flag": f"(is_on_time_delivery <> CASE WHEN {REAL} <= {PLAN} THEN 1 ELSE 0 END)",
        },
        "shipping_feature_status",
    ),
    "dq_10_financial_features": rules(
        {
            "invalid_gross_sales": "(abs(gross_sales_before_discount - (sales + order_item_discount)) > 0.01)",
            "invalid_profit_margin": f"(sales <> 0 AND abs(CAST(profit_margin_pct AS DOUBLE) - {pct(P, 'sales')}) > 0.05)",
            "invalid_profitability_status": f"({STATUS})",
        },
        "financial_feature_status",
    ),
    "dq_11_binary_fields": rules(
        {
            "invalid_is_late_delivery": "(is_late_delivery NOT IN (0, 1))",
            "invalid_is_on_time_delivery": "(is_on_time_delivery NOT IN (0, 1))",
            "invalid_is_profitable_item": "(is_profitable_item NOT IN (0, 1))",
            "invalid_is_loss_item": "(is_loss_item NOT IN (0, 1))",
            "invalid_is_weekend_order": "(is_weekend_order NOT IN (0, 1))",
            "invalid_management_attention": "(requires_management_attention NOT IN (0, 1))",
        },
        "binary_field_status",
    ),
    "dq_12_domains": rules(
        {
            "invalid_delivery_performance": "(delivery_performance NOT IN ('Late', 'On Schedule', 'Early', 'Unknown'))",
            "invalid_profitability_status": "(profitability_status NOT IN ('Profitable', 'Break Even', 'Loss', 'Unknown'))",
            "invalid_operational_risk_segment":
                "(operational_risk_segment NOT IN ('Late and Loss', 'Late Only', 'Loss Only', 'Healthy'))",
        },
        "categorical_domain_status",
    ),
    "dq_13_problem_rows": f"""SELECT order_item_id, order_id, customer_id, product_card_id, {day('order_date')} AS order_date,
      {day('shipping_date')} AS shipping_date, CAST(sales AS DOUBLE) AS sales, CAST(order_item_quantity AS BIGINT) AS order_item_quantity,
      CAST(shipping_delay_days AS BIGINT) AS shipping_delay_days, CAST(is_late_delivery AS BIGINT) AS is_late_delivery,
      profitability_status FROM stg
      WHERE order_item_id IS NULL OR order_id IS NULL OR customer_id IS NULL OR product_card_id IS NULL OR stg.order_date IS NULL
        OR stg.shipping_date IS NULL OR stg.shipping_date < stg.order_date OR stg.sales < 0 OR stg.order_item_quantity <= 0
        OR stg.is_late_delivery NOT IN (0, 1) ORDER BY order_item_id LIMIT 100""",
    "dq_14_reconciliation": f"""SELECT COUNT(*) AS order_item_rows, COUNT(DISTINCT order_id) AS distinct_orders,
      COUNT(DISTINCT customer_id) AS distinct_customers, COUNT(DISTINCT product_card_id) AS distinct_products,
      COUNT(DISTINCT category_id) AS distinct_categories, COUNT(DISTINCT shipping_mode) AS distinct_shipping_modes,
      {total('sales')} AS total_sales, {total(P)} AS total_profit, {margin()} AS overall_profit_margin_pct,
      {avg(REAL)} AS average_actual_shipping_days, {rate('is_late_delivery')} AS late_delivery_rate_pct FROM stg""",
    "dq_15_readiness": f"""SELECT *, CASE WHEN total_rows = {N} AND unique_order_item_ids = {N} AND duplicate_rows = 0
        AND missing_critical_fields = 0 AND invalid_dates = 0 AND shipping_before_order = 0 AND invalid_numeric_rows = 0
        AND invalid_shipping_features = 0 THEN 'READY'
        WHEN total_rows >= {N} AND duplicate_rows = 0 AND missing_critical_fields = 0 THEN 'READY WITH WARNINGS'
        ELSE 'NOT READY' END AS final_data_readiness FROM (SELECT {VOLUME},
          CAST(SUM(CAST(order_item_id IS NULL OR order_id IS NULL OR customer_id IS NULL OR product_card_id IS NULL
            OR category_id IS NULL OR sales IS NULL AS INTEGER)) AS BIGINT) AS missing_critical_fields,
          CAST(SUM(CAST(order_date IS NULL OR shipping_date IS NULL AS INTEGER)) AS BIGINT) AS invalid_dates,
          CAST(SUM(CAST(shipping_date < order_date AS INTEGER)) AS BIGINT) AS shipping_before_order,
          CAST(SUM(CAST(sales < 0 OR order_item_quantity <= 0 OR order_item_product_price < 0 OR {REAL} < 0
            OR {PLAN} < 0 AS INTEGER)) AS BIGINT) AS invalid_numeric_rows,
          CAST(SUM(CAST(shipping_delay_days <> ({REAL} - {PLAN}) OR {LATE} AS INTEGER)) AS BIGINT) AS invalid_shipping_features
        FROM stg)""",
    "dq_load_check": f"""SELECT *, CASE WHEN ok THEN 'SUCCESS' WHEN total_rows > 0 THEN 'WARNING' ELSE 'FAILED' END AS load_status,
        CASE WHEN ok THEN 'READY' ELSE 'REVIEW REQUIRED' END AS staging_status FROM (
          SELECT *, total_rows = {N} AND duplicate_rows = 0 AND valid_order_dates = {N} AND valid_shipping_dates = {N} AS ok FROM (
            SELECT {VOLUME}, COUNT(order_date) AS valid_order_dates, COUNT(shipping_date) AS valid_shipping_dates, {NULL_DATES},
              {RANGE} FROM stg))""",
}
BODIES["dq_load_check"] = BODIES["dq_load_check"].replace("SELECT *, CASE WHEN ok", "SELECT * EXCLUDE (ok), CASE WHEN ok")

QUALITY = {name: on_stg(body) for name, body in BODIES.items()}
# The duplicate-key list runs over the items before they are reduced to one row per key.
QUALITY["dq_04_duplicate_keys"] = on_items(
    """SELECT order_item_id, COUNT(*) AS duplicate_count FROM items GROUP BY 1 HAVING COUNT(*) > 1
    ORDER BY duplicate_count DESC, order_item_id LIMIT 100"""
)
