"""Exploratory tables."""

from freightlens.plans.eda import (
    CORRELATED, CUSTOMER_DIMENSIONS, INSIGHTS, LOSS_DIMENSIONS, MARKET_DIMENSIONS, OUTLIER_COLUMNS, PLACE_DIMENSIONS,
    PRODUCT_DIMENSIONS, SCATTER,
)
from oracle.base import P, avg, mean, on_stg, pct, r, rate
from oracle.profiling import outliers

S = "coalesce(SUM(sales), 0)"
G = f"coalesce(SUM({P}), 0)"
SG = f"CAST({S} AS DOUBLE) AS total_sales, CAST({G} AS DOUBLE) AS total_profit"
MARGIN = f"{r(pct(G, S), 4)} AS profit_margin_pct"
ORDERS = "COUNT(DISTINCT order_id) AS orders"


def top(d: str, n: int, head: str = "") -> str:
    name = f"'{d}' AS dimension, {d} AS member" if head else d
    return f"(SELECT {name}, {SG}, {ORDERS}, {MARGIN} FROM stg GROUP BY {d} ORDER BY SUM(sales) DESC, {d} NULLS FIRST LIMIT {n})"


def tops(dims) -> str:
    return " UNION ALL ".join(top(d, 15, "x") for d in dims)


def loss(d: str) -> str:
    return f"""(SELECT '{d}' AS dimension, {d} AS member, {SG}, COUNT(*) AS item_rows, COUNT(*) FILTER (WHERE {P} < 0) AS loss_items,
      {MARGIN}, {r(pct(f"COUNT(*) FILTER (WHERE {P} < 0)", "COUNT(*)"), 4)} AS loss_item_rate_pct
      FROM stg GROUP BY {d} ORDER BY SUM({P}), {d} NULLS FIRST LIMIT 15)"""


def group(d: str) -> str:
    return f"""SELECT '{d}' AS dimension, {d} AS member, {SG}, COUNT(DISTINCT customer_id) AS customers, {ORDERS},
      {r(f"CAST({S} AS DOUBLE) / COUNT(DISTINCT customer_id)", 4)} AS sales_per_customer, {MARGIN} FROM stg GROUP BY {d}"""


def money(expr: str) -> str:
    return f"format('{{:,.2f}}', {r(expr)})"


def first(d: str, value: str, order: str) -> str:
    return f"(SELECT {value} FROM stg GROUP BY {d} ORDER BY {order}, {d} NULLS FIRST LIMIT 1)"


def sentence(area: str, *values: str) -> str:
    layout, implication = INSIGHTS[area]
    parts = layout.replace("%%", "\0").split("%s")
    text = f"'{parts[0]}'" + "".join(f" || {v} || '{p}'" for v, p in zip(values, parts[1:]))
    return f"SELECT '{area}' AS analysis_area, {text} AS finding, '{implication}' AS business_implication".replace("\0", "%")


_body, _extra = outliers(OUTLIER_COLUMNS, "stg", "COUNT(*)", 4)
_pairs = " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 6)} AS correlation FROM stg"
    for a in CORRELATED for b in CORRELATED
)
_kpis = {
    "Total Sales": f"CAST({S} AS DOUBLE)", "Total Profit": f"CAST({G} AS DOUBLE)", "Profit Margin": r(pct(G, S), 4),
    "Distinct Orders": "CAST(COUNT(DISTINCT order_id) AS DOUBLE)", "Distinct Customers": "CAST(COUNT(DISTINCT customer_id) AS DOUBLE)",
    "Order Item Rows": "CAST(COUNT(*) AS DOUBLE)", "Average Order Value": r(f"CAST({S} AS DOUBLE) / COUNT(DISTINCT order_id)", 4),
    "Late Delivery Rate": r(f"{mean('is_late_delivery')} * 100", 4),
}
_MODES = ["First Class", "Same Day", "Second Class", "Standard Class"]
_scatter = [f"CAST({c} AS DOUBLE) AS {c}" if c not in ("category_name", "market") else c for c in SCATTER]

BODIES = {
    "eda_top": top("product_name", 10),
    "eda_kpis": " UNION ALL ".join(f"SELECT '{k}' AS \"KPI\", {v} AS \"Value\" FROM stg" for k, v in _kpis.items()),
    "eda_monthly": f"SELECT strftime(order_date, '%Y-%m') AS order_month, {SG}, {ORDERS} FROM stg WHERE order_date IS NOT NULL GROUP BY 1",
    "eda_market_tables": tops(MARKET_DIMENSIONS),
    "eda_product_tables": tops(PRODUCT_DIMENSIONS),
    "eda_loss_tables": " UNION ALL ".join(loss(d) for d in LOSS_DIMENSIONS),
    "eda_customer_tables": " UNION ALL ".join(group(d) for d in CUSTOMER_DIMENSIONS),
    "eda_shipping": f"""SELECT shipping_mode, COUNT(*) AS item_rows, {SG}, {avg('days_for_shipping_real', 4)} AS avg_actual_shipping_days,
      {avg('shipping_delay_days', 4)} AS avg_delay_days, {r(f"{mean('is_late_delivery')} * 100", 4)} AS late_delivery_rate_pct
      FROM stg GROUP BY 1""",
    "eda_delivery_status": f"SELECT delivery_status, COUNT(*) AS item_rows, CAST({S} AS DOUBLE) AS total_sales FROM stg GROUP BY 1",
    "eda_late_pivot": "SELECT market, " + ", ".join(
        f"""MAX(rate) FILTER (WHERE shipping_mode = '{m}') AS "{m}" """ for m in _MODES
    ) + f"FROM (SELECT market, shipping_mode, {rate('is_late_delivery')} AS rate FROM stg GROUP BY 1, 2) GROUP BY 1",
    "eda_sample": f"""SELECT order_item_id, {", ".join(_scatter)} FROM stg WHERE {" AND ".join(f"stg.{c} IS NOT NULL" for c in SCATTER)}
      ORDER BY md5('42:' || order_item_id), order_item_id LIMIT 20000""",
    "eda_correlation": _pairs,
    "eda_geo_tables": tops(PLACE_DIMENSIONS),
    "eda_geo_points": f"""SELECT CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude,
      CAST({S} AS DOUBLE) AS total_sales, COUNT(*) AS item_rows FROM stg WHERE stg.longitude IS NOT NULL AND stg.latitude IS NOT NULL
      GROUP BY 1, 2 ORDER BY SUM(sales) DESC, 1, 2 LIMIT 5000""",
    "eda_risk_summary": f"SELECT operational_risk_segment, COUNT(*) AS item_rows, {SG} FROM stg GROUP BY 1",
    "eda_priority_category": f"""SELECT category_name, COUNT(*) AS item_rows,
      CAST(coalesce(SUM(requires_management_attention), 0) AS BIGINT) AS attention_items, {SG},
      {r(pct('coalesce(SUM(requires_management_attention), 0)', 'COUNT(*)'), 4)} AS attention_rate_pct FROM stg GROUP BY 1""",
    "eda_insights": " UNION ALL ".join([
        sentence("Executive", money(f"(SELECT {S} FROM stg)"), money(f"(SELECT {G} FROM stg)")),
        sentence("Delivery", money(f"(SELECT {mean('is_late_delivery')} * 100 FROM stg)")),
        sentence("Market", first("market", "market", "SUM(sales) DESC"), money(first("market", "SUM(sales)", "SUM(sales) DESC"))),
        sentence("Category", first("category_name", "category_name", "SUM(sales) DESC"),
                 money(first("category_name", "SUM(sales)", "SUM(sales) DESC"))),
        sentence("Profitability", first("category_name", "category_name", f"SUM({P})"), money(first("category_name", f"SUM({P})", f"SUM({P})"))),
    ]),
}
EDA = {name: on_stg(body) for name, body in BODIES.items()}
EDA["eda_outliers"] = on_stg(_body, _extra)
