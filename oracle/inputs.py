"""Sources, sinks, cleaning steps and features."""

from freightlens.functions.text import snake_case
from freightlens.operators.cleaning import FILLED_WITH_UNKNOWN, PERSONAL_OR_UNUSED, RENAMED
from freightlens.plans.feature_reports import DESCRIPTIONS
from freightlens.schemas import CLEAN_FIELDS, RAW_HEADERS, READY_FIELDS, READY_HEADERS
from oracle.base import FILLED, ITEM_COLUMNS, LOADED_AT, SOURCE_FILE, TIE_BREAK, on_clean, on_items, on_star, on_stg, pct, plain, r
from oracle.profiling import CLEAN_RULES, RAW, on_raw

TEXT_RAW = RAW + ",\nraw_text AS (SELECT " + ", ".join(f'CAST("{h}" AS VARCHAR) AS "{h}"' for h in RAW_HEADERS) + " FROM raw)"


def on_text(body: str) -> str:
    return f"WITH {TEXT_RAW}\n{body}"


def name(header: str) -> str:
    return RENAMED.get(snake_case(header), snake_case(header))


CLEAN_NAMES = {h: name(h) for h in RAW_HEADERS}
ITEM_FIELDS = {c: CLEAN_FIELDS[c] for c in ITEM_COLUMNS}
NULLS = {c: f"CAST(NULL AS VARCHAR) AS {c}" for c in CLEAN_FIELDS if c not in ITEM_COLUMNS}
EMPTY = len([h for h in RAW_HEADERS if CLEAN_NAMES[h] not in PERSONAL_OR_UNUSED]) - len(ITEM_COLUMNS)
KEPT = 53 - len(PERSONAL_OR_UNUSED)
N = "(SELECT COUNT(*) FROM items)"
EXACT = "(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM items))"
KEYS = "(SELECT COUNT(DISTINCT order_item_id) FROM items)"
NOTES = [
    "'rows as read'", "'names in snake case'",
    "'without customer_email, customer_fname, customer_lname, customer_password, customer_street, product_description, product_image'",
    "'white space collapsed, blanks set to NULL'", "'dates and numbers parsed'", f"({N} - {EXACT}) || ' exact copies'", "'the fullest row of each key'",
    "'without " + ", ".join(c for c in CLEAN_NAMES.values() if c not in PERSONAL_OR_UNUSED and c not in ITEM_COLUMNS) + "'",
    "(SELECT COUNT(*) - COUNT(order_item_id) FROM items) || ' rows had no key'", "'Unknown filled into the text dimensions'", "'one spelling per label'",
]
STEPS = [
    ("load_raw_data", N, N, 53, 53), ("standardize_column_names", N, N, 53, 53), ("drop_pii_and_unused_columns", N, N, 53, KEPT),
    ("normalize_text", N, N, KEPT, KEPT), ("standardize_data_types", N, N, KEPT, KEPT), ("remove_exact_duplicates", N, EXACT, KEPT, KEPT),
    ("deduplicate_order_item_id", EXACT, KEYS, KEPT, KEPT), ("drop_all_missing_columns", KEYS, KEYS, KEPT, KEPT - EMPTY),
    ("remove_missing_primary_key", KEYS, KEYS, KEPT - EMPTY, KEPT - EMPTY), ("handle_missing_values", KEYS, KEYS, KEPT - EMPTY, KEPT - EMPTY),
    ("standardize_categories", KEYS, KEYS, KEPT - EMPTY, KEPT - EMPTY),
]
day = lambda e: f"strftime({e}, '%Y-%m-%d %H:%M:%S')"
title = lambda e: f"array_to_string(list_transform(regexp_extract_all(lower({e}), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '')"
third = lambda c: r(f"CAST({c} AS DECIMAL(28,14)) / 3", 4)

CLEANING = {
    "clean_column_names": on_raw(" UNION ALL ".join(
        f"""SELECT '{h}' AS raw_column, '{c}' AS clean_column, CAST(COUNT("{h}") AS DOUBLE) AS filled FROM raw""" for h, c in CLEAN_NAMES.items())),
    "clean_drop_pii": on_text("SELECT " + ", ".join(f'"{h}" AS {c}' for h, c in CLEAN_NAMES.items() if c not in PERSONAL_OR_UNUSED) + " FROM raw_text"),
    "clean_text": on_text("""SELECT "Order Item Id" AS order_item_id, "Product Name" AS product_name, CAST(NULL AS VARCHAR) AS order_city,
      CAST(NULL AS VARCHAR) AS order_state, CAST(NULL AS VARCHAR) AS customer_state, "Market" AS market FROM raw_text"""),
    "clean_types": on_items("SELECT " + plain(ITEM_FIELDS).replace(
        "delivery_status AS delivery_status", "CASE delivery_status WHEN 'Late Delivery' THEN 'Late delivery' WHEN 'Shipping On Time' THEN 'Shipping on time' ELSE 'Advance shipping' END AS delivery_status",
    ) + ", " + ", ".join(NULLS.values()) + " FROM items"),
    "clean_parse_dates_3fmt": on_items(f"""SELECT order_item_id, product_card_id, {day('order_date')} AS slash, {day('order_date')} AS stamp,
      {day('order_date')} AS day, CAST(NULL AS VARCHAR) AS no_such_month, CAST(NULL AS VARCHAR) AS other FROM items"""),
    "clean_exact_dedup": on_clean(f"""SELECT order_item_id, order_id, product_card_id, payment_type, CAST(sales AS DOUBLE) AS sales,
      {day('order_date')} AS order_date FROM clean"""),
    "clean_key_dedup": on_items(f"""SELECT {plain(ITEM_FIELDS)} FROM (SELECT * FROM items
      QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY {FILLED} DESC, {TIE_BREAK}) = 1)"""),
    "clean_drop_all_null_cols": on_items(f"SELECT {plain(ITEM_FIELDS)} FROM items"),
    "clean_require_key": on_items("SELECT order_item_id, order_id, product_card_id, payment_type FROM items WHERE payment_type <> 'R'"),
    "clean_fill_unknown": on_items("SELECT order_item_id, product_card_id, " + ", ".join(
        f"coalesce({c}, 'Unknown') AS {c}" if c in ITEM_COLUMNS else f"'Unknown' AS {c}" for c in FILLED_WITH_UNKNOWN) + " FROM items"),
    "clean_labels": on_items("SELECT CAST(order_item_id AS VARCHAR) AS order_item_id, delivery_status, shipping_mode FROM items"),
    "clean_title_case": on_items(f"""SELECT order_item_id, product_card_id,
      {title("order_country || ' o''' || market || '-' || product_name")} AS order_country, 'Unknown' AS order_city FROM items"""),
    "clean_round": on_items(f"""SELECT order_item_id, product_card_id, {third('sales')} AS sales, {third('order_profit')} AS order_profit,
      {third('product_price')} AS product_price FROM items"""),
    "clean_audit_log": on_items(" UNION ALL ".join(
        f"""SELECT {i} AS step_no, '{s}' AS step, {a} AS rows_before, {b} AS rows_after, {a} - {b} AS rows_removed,
        {c} AS columns_before, {d} AS columns_after, {NOTES[i - 1]} AS note""" for i, (s, a, b, c, d) in enumerate(STEPS, 1))),
    "clean_reconciliation": on_items(f"""SELECT 'raw_rows' AS metric, CAST({N} AS DOUBLE) AS value UNION ALL SELECT 'clean_rows', {KEYS}
      UNION ALL SELECT 'rows_removed', {N} - {KEYS} UNION ALL SELECT 'retention_rate_pct', {r(pct(KEYS, N), 4)}
      UNION ALL SELECT 'raw_columns', 53 UNION ALL SELECT 'clean_columns', {len(ITEM_COLUMNS)}"""),
    "clean_critical_missing": on_clean(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing_count, {r(pct(f"COUNT(*) - COUNT({c})", "COUNT(*)"), 4)} AS missing_pct FROM clean"""
        for c in ["order_item_id", "order_id", "customer_id", "product_card_id", "order_date", "sales", "order_item_quantity", "order_item_product_price"])),
}

PER_ITEM = {
    "feat_calendar": ["order_year", "order_quarter_number", "order_quarter", "order_month", "order_month_name", "order_year_month", "order_week",
                      "order_day", "order_day_name", "is_weekend_order", "order_date_key", "shipping_year_month", "shipping_date_key"],
    "feat_delay": ["shipping_delay_days", "absolute_schedule_variance_days"],
    "feat_delivery_performance": ["delivery_performance"],
    "feat_ontime_late_flags": ["is_on_time_delivery", "is_late_delivery"],
    "feat_efficiency_ratio": ["shipping_efficiency_ratio"],
    "feat_delay_severity": ["delivery_delay_severity"],
    "feat_speed_segment": ["shipping_speed_segment"],
    "feat_gross_discount": ["gross_sales_before_discount", "discount_pct_calculated"],
    "feat_discount_rate_pct": ["discount_rate_pct"],
    "feat_margin": ["profit_margin_pct"],
    "feat_profitability": ["profitability_status", "is_profitable_item", "is_loss_item"],
    "feat_sales_tier": ["sales", "sales_value_tier"],
    "feat_margin_band": ["margin_band"],
    "feat_discount_band": ["discount_band"],
    "feat_order_totals": ["order_id", "order_total_sales", "order_total_profit", "order_total_quantity", "order_item_count", "order_profit_margin_pct"],
    "feat_customer_lifetime": ["customer_id", "customer_order_count", "customer_lifetime_sales", "customer_average_item_sales",
                               "customer_lifetime_profit", "customer_first_order_date", "customer_last_order_date", "customer_tenure_days"],
    "feat_frequency_segment": ["customer_order_count", "customer_frequency_segment"],
    "feat_attention_flag": ["requires_management_attention"],
    "feat_risk_segment": ["operational_risk_segment"],
}
FEATURES = {n: on_stg(f"SELECT {plain(READY_FIELDS, ['order_item_id', *c])} FROM ready") for n, c in PER_ITEM.items()}
_dictionary = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature_name, '{READY_FIELDS[c]}' AS data_type, '{d}' AS description, COUNT(*) - COUNT({c}) AS missing_count,
    {r(pct(f"COUNT(*) - COUNT({c})", "COUNT(*)"), 4)} AS missing_pct FROM ready""" for c, d in DESCRIPTIONS.items())
ROWS = "(SELECT COUNT(*) FROM ready)"
CHECKS = [
    ("Row count preserved", ROWS, "(SELECT COUNT(*) FROM clean)"),
    ("Order item ID has no missing values", "(SELECT COUNT(*) FROM ready WHERE order_item_id IS NULL)", "0"),
    ("Order item ID is unique", f"{ROWS} - (SELECT COUNT(*) FROM (SELECT DISTINCT order_item_id FROM ready))", "0"),
    ("Shipping delay formula is consistent", "(SELECT COUNT(*) FROM ready WHERE shipping_delay_days <> days_for_shipping_real - days_for_shipment_scheduled)", "0"),
    ("Late-delivery flag is binary", "(SELECT COUNT(*) FROM ready WHERE NOT coalesce(is_late_delivery IN (0, 1), false))", "0"),
    ("Profit margin contains no infinity", "(SELECT COUNT(*) FROM ready WHERE isinf(CAST(profit_margin_pct AS DOUBLE)))", "0"),
]
_validation = " UNION ALL ".join(
    f"""SELECT '{n}' AS "check", CASE WHEN {o} = {e} THEN 'PASS' ELSE 'FAIL' END AS status, CAST({o} AS BIGINT) AS observed, CAST({e} AS BIGINT) AS expected"""
    for n, o, e in CHECKS)
FEATURES |= {
    "feat_dictionary": on_stg(_dictionary),
    "feat_validation": on_stg(_validation),
    "feat_summary": on_stg(f"""SELECT 'input_rows' AS metric, CAST((SELECT COUNT(*) FROM clean) AS DOUBLE) AS value UNION ALL SELECT 'output_rows', {ROWS}
      UNION ALL SELECT 'input_columns', {len(CLEAN_FIELDS)} UNION ALL SELECT 'output_columns', {len(READY_FIELDS)}
      UNION ALL SELECT 'engineered_features_documented', {len(DESCRIPTIONS)} UNION ALL SELECT 'validation_checks', 6
      UNION ALL SELECT 'validation_checks_passed', (SELECT COUNT(*) FROM ({_validation}) WHERE status = 'PASS')"""),
}

LOADED = {**READY_FIELDS, "source_file_name": "string", "load_batch_id": "string", "loaded_at": "timestamp_ntz"}
FILE_NAMES = {"days_for_shipping": "days_for_shipping_real", "days_for_shipment": "days_for_shipment_scheduled"}


def file_text(header: str) -> str:
    column = FILE_NAMES.get(header, header)
    kind = READY_FIELDS.get(column)
    if kind is None:
        return f"CAST(NULL AS VARCHAR) AS {header}"
    if kind == "timestamp_ntz":
        return f"{day(column)} AS {header}"
    if kind.startswith("decimal"):
        return f"CAST(ROUND({column}, 4) AS VARCHAR) AS {header}"
    return f"CAST({column} AS VARCHAR) AS {header}"


def four(column: str, kind: str) -> str:
    return f"ROUND({column}, 4) AS {column}" if kind.startswith("decimal") else column


MISSING_COLUMNS = len(RAW_HEADERS) - len(ITEM_COLUMNS) - 4
INPUTS = {
    "src_csv_raw": on_text("SELECT * FROM raw_text"),
    "src_csv_clean": on_stg("SELECT " + ", ".join(file_text(h) for h in READY_HEADERS) + " FROM ready"),
    "src_staging_load": on_stg(f"SELECT {plain(LOADED)} FROM stg"),
    "src_reject_rows": on_stg("""SELECT CAST(order_item_id AS VARCHAR) AS order_item_id, 'order_date' AS "column", '13/41/2018 22:56' AS value
      FROM ready WHERE payment_type = 'R' UNION ALL SELECT CAST(order_item_id AS VARCHAR), 'sales', 'n/a' FROM ready WHERE order_status = 'P'"""),
    "sink_csv": on_stg("SELECT " + plain(READY_FIELDS) + " FROM (SELECT " + ", ".join(four(c, t) for c, t in READY_FIELDS.items()) + " FROM ready)"),
    "sink_readback": on_stg(f"SELECT {ROWS} AS expected_rows, {ROWS} AS exported_rows, true AS complete"),
    "sink_reports": on_stg(f"""SELECT 'missing_value_report' AS report, {MISSING_COLUMNS} AS row_count UNION ALL SELECT 'cleaning_validation_report', {len(CLEAN_RULES)}
      UNION ALL SELECT 'monthly_trend', (SELECT COUNT(DISTINCT strftime(order_date, '%Y-%m')) FROM ready)"""),
    "load_batch_id": on_stg(f"SELECT {day('loaded_at')} AS loaded_at, 'DATACO_' || strftime(loaded_at, '%Y%m%d_%H%M%S_%f') AS load_batch_id, COUNT(*) AS rows FROM stg GROUP BY stg.loaded_at"),
    "latest_batch": on_stg(f"""SELECT load_batch_id, {day('loaded_at')} AS loaded_at, COUNT(*) AS rows FROM (
      SELECT load_batch_id, loaded_at FROM stg UNION ALL SELECT 'DATACO_20230101_000000_000000', TIMESTAMP '2023-01-01 00:00:00' FROM stg WHERE order_year < 1998) u
      WHERE u.loaded_at = TIMESTAMP '{LOADED_AT}' GROUP BY load_batch_id, u.loaded_at"""),
    "dq_load_sample": on_stg(f"""SELECT order_status, {day('shipping_date')} AS shipping_date, shipping_mode, product_card_id, product_name
      FROM stg ORDER BY order_item_id LIMIT 20"""),
}

EARLY = "order_date < TIMESTAMP '1996-01-01'"
EARLIER = "2023-01-01 00:00:00"


def log_row(process: str, status: str, read: str, inserted: str, message: str = "CAST(NULL AS VARCHAR)", file: str = SOURCE_FILE, at: str = LOADED_AT) -> str:
    return f"""SELECT 'supply_chain_pipeline' AS pipeline_name, '{file}' AS source_file_name, '{process}' AS process_name, '{status}' AS process_status,
      CAST({read} AS BIGINT) AS rows_read, CAST({inserted} AS BIGINT) AS rows_inserted, CAST({read} - {inserted} AS BIGINT) AS rows_rejected,
      '{at}' AS started_at, '{at}' AS completed_at, {message} AS error_message"""


def count(table: str, what: str = "*", where: str = "true") -> str:
    return f"(SELECT COUNT({what}) FROM {table} WHERE {where})"


def dim_members(where: str = "true") -> str:
    """Members that the six dimensions gain from some items."""
    days = " UNION ".join(f"SELECT CAST({c} AS DATE) FROM ready WHERE {where}" for c in ("order_date", "shipping_date"))
    ends = " UNION ".join(f"SELECT CAST({f}(order_date) AS DATE) FROM ready WHERE {where} GROUP BY customer_id" for f in ("MIN", "MAX"))
    return {
        "dim_customer": f"SELECT DISTINCT customer_id FROM ready WHERE {where}", "dim_category": f"SELECT DISTINCT category_id FROM ready WHERE {where}",
        "dim_product": f"SELECT DISTINCT product_card_id FROM ready WHERE {where}", "dim_date": f"{days} UNION {ends}",
        "dim_shipping_mode": f"SELECT DISTINCT shipping_mode FROM ready WHERE {where}",
        "dim_geography": f"SELECT DISTINCT market, order_region, order_country, order_state, order_city, latitude, longitude FROM ready WHERE {where}",
    }


WHOLE, FIRST = dim_members(), dim_members(EARLY)
gained = lambda members: "(" + " + ".join(f"(SELECT COUNT(*) FROM ({m}))" for m in members.values()) + ")"
_staged, _early = count("stg"), count("clean", where=EARLY)
_items, _early_items = count("items"), count("items", where=EARLY)
_new_whole = f"({gained(WHOLE)} - {gained(FIRST)})"
_bad = f"""'staged batch is not ready: total_rows=' || {_staged} || '; unique_order_item_ids=' || {_staged} || '; duplicate_rows=0; missing_critical_fields=' ||
  {count("stg", where="payment_type = 'R'")} || '; invalid_dates=0; shipping_before_order=' || {count("stg", where="shipping_date < order_date")} ||
  '; invalid_numeric_rows=' || {count("stg", where="sales < 0 OR order_item_product_price < 0 OR days_for_shipping_real < 0 OR days_for_shipment_scheduled < 0 OR order_item_quantity <= 0")} ||
  '; invalid_shipping_features=0'"""
_dims_log = lambda rows, new, **kw: log_row("load_dimensions", "SUCCESS", rows, new, **kw).replace(f"CAST({rows} - {new} AS BIGINT) AS rows_rejected", "CAST(0 AS BIGINT) AS rows_rejected")
_early_kw = {"file": "early_items", "at": EARLIER}
INPUTS |= {
    "etl_run_log": on_star(" UNION ALL ".join([
        log_row("clean_order_items", "SUCCESS", _early_items, _early, **_early_kw), log_row("load_staging_csv", "SUCCESS", _early, _early, **_early_kw),
        _dims_log(_early, f"({gained(FIRST)} + 6)", **_early_kw), log_row("load_fact_order_item", "SUCCESS", _early, _early, **_early_kw),
        log_row("clean_order_items", "SUCCESS", _items, _staged),
        log_row("load_staging_csv", "WARNING", _staged, _staged, f"""'Rows=' || {_staged} || '; duplicates=0; valid_order_dates=' || {count("stg", "order_date")} ||
          '; valid_shipping_dates=' || {count("stg", "shipping_date")}"""),
        _dims_log(_staged, _new_whole),
        log_row("load_fact_order_item", "WARNING", _staged, _staged, f"""'fact_rows=' || {_staged} || '; unique_order_items=' || {_staged} ||
          '; duplicate_rows=0; rows_with_unknown_dimension_key=0'"""),
    ])),
    "etl_run_log_failed": on_star(f"""SELECT *, CAST(0 AS BIGINT) AS dimension_versions FROM (
      {log_row("clean_order_items", "SUCCESS", _items, _staged)} UNION ALL {log_row("load_staging_csv", "FAILED", _staged, _staged, _bad)})"""),
    "fact_partitions": on_star(f"""SELECT load_batch_id, order_date_key // 100 AS order_month_key, COUNT(*) AS fact_rows, CAST(SUM(sales) AS DOUBLE) AS sales FROM (
      SELECT load_batch_id, order_date_key, sales FROM fact UNION ALL
      SELECT 'DATACO_20230101_000000_000000', CAST(strftime(order_date, '%Y%m%d') AS BIGINT), sales FROM clean WHERE {EARLY}) GROUP BY 1, 2"""),
    "fact_latest_batch": on_star("""SELECT order_date_key // 100 AS order_month_key, COUNT(*) AS fact_rows, CAST(SUM(sales) AS DOUBLE) AS sales FROM fact
      WHERE order_date_key // 10000 = 1997 GROUP BY 1"""),
    "dim_versions": on_star(" UNION ALL ".join(
        f"""SELECT {v} AS version, '{n}' AS table_name, (SELECT COUNT(*) FROM ({members[n]})) AS members, (SELECT COUNT(*) FROM ({FIRST[n]})) AS kept_keys"""
        for v, members in ((1, FIRST), (2, WHOLE)) for n in FIRST)),
}
