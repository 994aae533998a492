"""Profile of the raw frame, and the rules and score after cleaning."""

from freightlens.plans.profiling import PERCENTILES, RAW_CATEGORIES, RAW_DATES, RAW_KEYS, RAW_MEASURES, RAW_OUTLIER_COLUMNS
from freightlens.schemas import CLEAN_FIELDS, RAW_HEADERS
from oracle.base import CLEAN, ITEM_COLUMNS, ITEMS, pct, r

SPECIAL = {
    "Type": "payment_type",
    "Benefit per order": "order_profit",
    "Days for shipping (real)": "days_for_shipping_real",
    "Days for shipment (scheduled)": "days_for_shipment_scheduled",
    "Delivery Status": "CASE delivery_status WHEN 'Late Delivery' THEN 'Late delivery' WHEN 'Shipping On Time' THEN 'Shipping on time' ELSE 'Advance shipping' END",
    "Customer Email": "'XXXXXXXXX'",
    "Customer Password": "'XXXXXXXXX'",
    "Customer Fname": "'Customer'",
    "Customer Lname": "CAST(customer_id AS VARCHAR)",
    "order date (DateOrders)": "strftime(order_date, '%-m/%-d/%Y %-H:%M')",
    "shipping date (DateOrders)": "strftime(shipping_date, '%-m/%-d/%Y %-H:%M')",
}


def raw_value(header: str) -> str:
    name = header.lower().replace(" ", "_")
    return SPECIAL.get(header, name if name in ITEM_COLUMNS else "CAST(NULL AS VARCHAR)")


RAW = ITEMS + ",\nraw AS (SELECT " + ",\n  ".join(f'{raw_value(h)} AS "{h}"' for h in RAW_HEADERS) + " FROM items)"
DATE_TEXT = set(RAW_DATES)


def kind(header: str) -> str:
    name = {"Type": "payment_type", "Benefit per order": "order_profit", "Days for shipping (real)": "days_for_shipping_real",
            "Days for shipment (scheduled)": "days_for_shipment_scheduled"}.get(header, header.lower().replace(" ", "_"))
    return "string" if header in DATE_TEXT else CLEAN_FIELDS.get(name, "string")


def on_raw(body: str, extra: str = "") -> str:
    return f"WITH {RAW}{extra}\n{body}"


def value_rows(columns, table: str = "raw") -> str:
    parts = [f"""SELECT '{c}' AS "column", CAST("{c}" AS VARCHAR) AS value, COUNT(*) AS n FROM {table} GROUP BY 2""" for c in columns]
    return "cells AS (" + "\nUNION ALL ".join(parts) + ")"


def measure_rows(columns, table: str = "raw") -> str:
    parts = [f"""SELECT '{c}' AS "column", CAST("{c}" AS DOUBLE) AS v FROM {table}""" for c in columns]
    return "m AS (" + "\nUNION ALL ".join(parts) + ")"


NUMERIC = [h for h in RAW_HEADERS if kind(h) not in ("string", "timestamp_ntz")]
TEXT = [h for h in RAW_HEADERS if kind(h) == "string"]
big = lambda e: f"CAST({e} AS BIGINT)"
NULLS = big("coalesce(SUM(CASE WHEN value IS NULL THEN n ELSE 0 END), 0)")
REPEATED = big("SUM(CASE WHEN n > 1 THEN n ELSE 0 END)")
TYPES = "CASE \"column\" " + " ".join(f"WHEN '{h}' THEN '{kind(h)}'" for h in RAW_HEADERS) + " END"
ROWS = "(SELECT COUNT(*) FROM raw)"


def copies(table: str, columns) -> str:
    return f"(SELECT (SELECT COUNT(*) FROM {table}) - COUNT(*) FROM (SELECT DISTINCT {columns} FROM {table}))"


RAW_COPIES = copies("raw", "*")
RULES = [
    ("Negative actual shipping days", "high", '"Days for shipping (real)" < 0'),
    ("Negative scheduled shipping days", "high", '"Days for shipment (scheduled)" < 0'),
    ("Quantity must be greater than zero", "high", '"Order Item Quantity" <= 0'),
    ("Sales must be non-negative", "high", '"Sales" < 0'),
    ("Product price must be non-negative", "high", '"Order Item Product Price" < 0'),
    ("Discount rate outside 0–1", "high", 'NOT coalesce("Order Item Discount Rate" BETWEEN 0 AND 1, false)'),
    ("Late delivery risk outside {0,1}", "high", 'NOT coalesce("Late_delivery_risk" IN (0, 1), false)'),
    ("Missing Order Item Id", "high", '"Order Item Id" IS NULL'),
    ("Duplicated Order Item Id", "high", '(SELECT COUNT(*) FROM raw r2 WHERE r2."Order Item Id" = raw."Order Item Id") > 1'),
    ("Delivery status vs late-risk inconsistency", "medium",
     """(lower(trim("Delivery Status")) = 'late delivery') <> coalesce("Late_delivery_risk" = 1, false)"""),
]
CLEAN_RULES = [
    ("order_item_id is not null", "high", "order_item_id IS NULL"),
    ("order_item_id is unique", "high", "(SELECT COUNT(*) FROM clean c2 WHERE c2.order_item_id = clean.order_item_id) > 1"),
    ("quantity > 0", "high", "order_item_quantity <= 0"),
    ("sales >= 0", "high", "sales < 0"),
    ("product price >= 0", "high", "order_item_product_price < 0"),
    ("discount rate between 0 and 1", "high", "NOT coalesce(order_item_discount_rate BETWEEN 0 AND 1, false)"),
    ("late_delivery_risk in {0,1}", "high", "NOT coalesce(late_delivery_risk IN (0, 1), false)"),
    ("shipping date is not before order date", "medium", "shipping_date < order_date"),
    ("actual shipping days >= 0", "high", "days_for_shipping_real < 0"),
]


def rule_rows(rules, table: str, name: str) -> str:
    parts = [
        f"SELECT '{n}' AS \"{name}\", '{s}' AS severity, COUNT(*) FILTER (WHERE {c}) AS failed_rows, COUNT(*) AS n FROM {table}"
        for n, s, c in rules
    ]
    return f"""SELECT "{name}", severity, failed_rows, {r(pct('failed_rows', 'n'), 4)} AS failed_pct,
      CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM ({" UNION ALL ".join(parts)})"""


RAW_NULLS = f"(SELECT {big('SUM(CASE WHEN value IS NULL THEN n ELSE 0 END)')} FROM cells)"
RAW_FAILED = f"(SELECT SUM(failed_rows) FROM ({rule_rows(RULES, 'raw', 'check')}))"
COMPLETE = f"(1 - CAST({RAW_NULLS} AS DOUBLE) / ({ROWS} * {len(RAW_HEADERS)}))"
UNIQUE = f"(1 - CAST({RAW_COPIES} AS DOUBLE) / {ROWS})"
VALID = f"greatest(0.0, 1 - CAST({RAW_FAILED} AS DOUBLE) / ({ROWS} * {len(RULES)}))"

PRESENT = ", ".join(ITEM_COLUMNS)
CLEAN_N = "(SELECT COUNT(*) FROM clean)"
CLEAN_NULLS = "(SELECT " + " + ".join(f"COUNT(*) - COUNT({c})" for c in ITEM_COLUMNS) + " FROM clean)"
C_COMPLETE = f"((1 - CAST({CLEAN_NULLS} AS DOUBLE) / ({CLEAN_N} * {len(ITEM_COLUMNS)})) * 100)"
C_UNIQUE = f"((1 - CAST({copies('clean', PRESENT)} AS DOUBLE) / {CLEAN_N}) * 100)"
C_VALID = f"greatest(0.0, (1 - CAST((SELECT SUM(failed_rows) FROM ({rule_rows(CLEAN_RULES, 'clean', 'rule')})) AS DOUBLE) / ({CLEAN_N} * {len(CLEAN_RULES)})) * 100)"

STATS = ", ".join(f"{r(f'quantile_cont(v, {p})', 4)} AS p{round(p * 100):02d}" for p in PERCENTILES)


def outliers(columns, table: str, whole: str, digits: int) -> tuple[str, str]:
    extra = "," + measure_rows(columns, table) + """,
q AS (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM m GROUP BY 1),
fences AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""
    body = f"""SELECT "column", {r('q1', 4)} AS q1, {r('q3', 4)} AS q3, {r('iqr', 4)} AS iqr, {r('lo', 4)} AS lower_bound,
      {r('hi', 4)} AS upper_bound, COUNT(*) FILTER (WHERE v < lo OR v > hi) AS outlier_count,
      {r(f"CAST(COUNT(*) FILTER (WHERE v < lo OR v > hi) AS DOUBLE) / {whole} * 100", digits)} AS outlier_pct
      FROM m JOIN fences USING ("column") GROUP BY "column", q1, q3, iqr, lo, hi"""
    return body, extra


_out_body, _out_extra = outliers(RAW_OUTLIER_COLUMNS, "raw", "COUNT(v)", 2)

PROFILING = {
    "prof_overview": on_raw(f"""SELECT 'rows' AS metric, CAST({ROWS} AS DOUBLE) AS value UNION ALL SELECT 'columns', 53
      UNION ALL SELECT 'cells', {ROWS} * 53 UNION ALL SELECT 'exact_duplicate_rows', {RAW_COPIES}"""),
    "prof_schema": on_raw(f"""SELECT "column", {TYPES} AS dtype, {big('SUM(CASE WHEN value IS NULL THEN 0 ELSE n END)')} AS non_null,
      {NULLS} AS null_count, {r(pct(NULLS, 'SUM(n)'))} AS null_pct, COUNT(value) AS unique_count, MIN(value) AS sample_value
      FROM cells GROUP BY 1""", "," + value_rows(RAW_HEADERS)),
    "prof_missing": on_raw(f"""SELECT "column", {NULLS} AS missing_count, {r(pct(NULLS, 'SUM(n)'))} AS missing_pct FROM cells
      GROUP BY 1 HAVING {NULLS} > 0""", "," + value_rows(RAW_HEADERS)),
    "prof_keys": on_raw(f"""SELECT "column", {NULLS} AS missing, COUNT(value) AS "unique", {REPEATED} AS duplicated_rows,
      {REPEATED} = 0 AS is_unique FROM cells GROUP BY 1""", "," + value_rows(RAW_KEYS)),
    "prof_numeric": on_raw(f"""SELECT "column", COUNT(v) AS count, {r('AVG(v)', 4)} AS mean, {r('stddev_samp(v)', 4)} AS std,
      MIN(v) AS min, {STATS}, MAX(v) AS max, COUNT(*) - COUNT(v) AS missing, COUNT(*) FILTER (WHERE v = 0) AS zero_count,
      COUNT(*) FILTER (WHERE v < 0) AS negative_count FROM m GROUP BY 1""", "," + measure_rows(NUMERIC)),
    "prof_categorical": on_raw(f"""SELECT "column", COUNT(value) AS unique_count, {NULLS} AS missing_count,
      (SELECT value FROM cells c2 WHERE c2."column" = cells."column" AND value IS NOT NULL ORDER BY n DESC, value LIMIT 1) AS top_value,
      coalesce(MAX(n) FILTER (WHERE value IS NOT NULL), 0) AS top_frequency FROM cells GROUP BY 1""", "," + value_rows(TEXT)),
    "prof_value_counts": on_raw("""SELECT "column", value, n AS count FROM cells
      QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS FIRST) <= 20""", "," + value_rows(RAW_CATEGORIES)),
    "prof_dates": on_raw(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", strftime(MIN(d), '%Y-%m-%d %H:%M:%S') AS min_date, strftime(MAX(d), '%Y-%m-%d %H:%M:%S') AS max_date,
        COUNT(*) - COUNT(d) AS invalid_or_missing, COUNT(DISTINCT CAST(d AS DATE)) AS distinct_dates
        FROM (SELECT try_strptime("{c}", '%m/%d/%Y %H:%M') AS d FROM raw)""" for c in RAW_DATES)),
    "prof_outliers_iqr": on_raw(_out_body, _out_extra),
    "prof_business_rules": on_raw(rule_rows(RULES, "raw", "check")),
    "prof_quality_score": on_raw(f"""SELECT dimension, {r('score * 100', 6)} AS score_pct, weight, {r('score * 100 * weight', 6)} AS weighted_score,
        {r('readiness')} AS readiness_score, CASE WHEN readiness >= 95 THEN 'strong baseline' WHEN readiness >= 85 THEN 'usable after cleaning'
        ELSE 'remediation required' END AS assessment
      FROM (SELECT *, SUM(score * 100 * weight) OVER () AS readiness FROM (
        SELECT 'completeness' AS dimension, {COMPLETE} AS score, 0.30::DOUBLE AS weight UNION ALL SELECT 'uniqueness', {UNIQUE}, 0.25::DOUBLE
        UNION ALL SELECT 'validity', {VALID}, 0.30::DOUBLE UNION ALL SELECT 'schema', 1.0, 0.15::DOUBLE))""", "," + value_rows(RAW_HEADERS)),
    "clean_rules": f"WITH {CLEAN}\n" + rule_rows(CLEAN_RULES, "clean", "rule"),
    "clean_score": f"""WITH {CLEAN} SELECT {r('c', 4)} AS completeness, {r('u', 4)} AS uniqueness, {r('v', 4)} AS validity,
      {r('0.35 * c + 0.25 * u + 0.40 * v', 4)} AS readiness_score
      FROM (SELECT {C_COMPLETE} AS c, {C_UNIQUE} AS u, {C_VALID} AS v)""",
}
PROFILING["prof_histogram"] = on_raw(f"""SELECT e."column", b AS bin, {r('lo + b * step', 4)} AS lower, {r('lo + b * step + step', 4)} AS upper,
      coalesce(n, 0) AS count
    FROM (SELECT *, (hi - lo) / 40 AS step FROM (SELECT "column", MIN(v) AS lo, MAX(v) AS hi FROM m GROUP BY 1)) e
    CROSS JOIN range(40) bins(b)
    LEFT JOIN (SELECT m."column", CAST(least(floor((v - lo) / ((hi - lo) / 40)), 39) AS BIGINT) AS k, COUNT(*) AS n
      FROM m JOIN (SELECT "column", MIN(v) AS lo, MAX(v) AS hi FROM m GROUP BY 1) x USING ("column") GROUP BY 1, 2) h
    ON h."column" = e."column" AND h.k = b""", "," + measure_rows(RAW_MEASURES))
PROFILING["prof_schema_approx"] = on_raw(f"""SELECT "column", {TYPES} AS dtype, {big('SUM(CASE WHEN value IS NULL THEN 0 ELSE n END)')} AS non_null,
      {NULLS} AS null_count, {r(pct(NULLS, 'SUM(n)'))} AS null_pct, MIN(value) AS sample_value, true AS within_bound
      FROM cells GROUP BY 1""", "," + value_rows(RAW_HEADERS))
PROFILING["prof_numeric_approx"] = on_raw(f"""SELECT "column", COUNT(v) AS count, {r('AVG(v)', 4)} AS mean, {r('stddev_samp(v)', 4)} AS std,
      MIN(v) AS min, MAX(v) AS max, COUNT(*) - COUNT(v) AS missing, COUNT(*) FILTER (WHERE v = 0) AS zero_count,
      COUNT(*) FILTER (WHERE v < 0) AS negative_count, true AS within_bound FROM m GROUP BY 1""", "," + measure_rows(NUMERIC))
