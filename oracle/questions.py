"""The fifty business questions."""

from oracle.base import FACT_FIELDS, P, avg, mean, on_star, pct, plain, r, rate, total
from oracle.views import MARGIN, ORDERS, ROWS, SP, qty

CUSTOMER = "fact JOIN dim_customer USING (customer_key)"
CATEGORY = "fact JOIN dim_category USING (category_key)"
PRODUCT = "fact f JOIN dim_product p USING (product_key)"
GEO = "fact JOIN dim_geography USING (geography_key)"
MODE = "fact JOIN dim_shipping_mode m USING (shipping_mode_key)"
DATE = "fact JOIN dim_date ON date_key = order_date_key"
YEAR, MONTH = "CAST(calendar_year AS BIGINT) AS calendar_year", "CAST(calendar_month AS BIGINT) AS calendar_month"
SALES = f"{total('sales')} AS total_sales"
MONTHLY = f"""monthly AS (SELECT {YEAR}, {MONTH}, calendar_year_month, SUM(sales) AS total_sales
  FROM {DATE} GROUP BY ALL)"""
BY_MONTH = "OVER (ORDER BY calendar_year, calendar_month)"
SERVICE = f"""
SELECT shipping_mode, service_level_group, {ROWS}, {avg('days_for_shipping_real')} AS avg_actual_days,
  {avg('days_for_shipment_scheduled')} AS avg_scheduled_days, {avg('shipping_delay_days')} AS avg_delay_days,
  {rate('is_late_delivery')} AS late_delivery_rate_pct
FROM {MODE} GROUP BY shipping_mode, service_level_group"""
LATE_MARKETS = f"""
SELECT market, COUNT(*) AS n, {mean('is_late_delivery')} AS rate, (SELECT {mean('is_late_delivery')} FROM fact) AS overall
FROM {GEO} GROUP BY market HAVING {mean('is_late_delivery')} > (SELECT {mean('is_late_delivery')} FROM fact)"""


def above_key_mean(dim: str, name: str) -> str:
    return f"""
SELECT {name}, {SALES} FROM fact JOIN dim_{dim} USING ({dim}_key) GROUP BY {name}
HAVING CAST(SUM(sales) AS DOUBLE) > (SELECT {mean('s')} FROM (SELECT SUM(sales) AS s FROM fact GROUP BY {dim}_key))"""


BODIES = {
    "a1_q01": f"SELECT {plain(FACT_FIELDS)} FROM fact ORDER BY fact.fact_order_item_key LIMIT 20",
    "a1_q02": "SELECT COUNT(*) AS total_order_items FROM fact",
    "a1_q03": "SELECT COUNT(DISTINCT customer_key) AS total_customers FROM fact",
    "a1_q04": f"SELECT {SP} FROM fact",
    "a1_q05": f"SELECT product_name, {SALES} FROM {PRODUCT} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "a1_q06": f"SELECT customer_segment, {SALES} FROM {CUSTOMER} GROUP BY 1",
    "a1_q07": f"SELECT category_name, {SALES} FROM {CATEGORY} GROUP BY 1",
    "a1_q08": f"SELECT {YEAR}, {MONTH}, month_name, {SALES} FROM {DATE} GROUP BY ALL",
    "a1_q09": f"""SELECT CAST(is_late_delivery AS BIGINT) AS is_late_delivery, COUNT(*) AS total_rows,
      {avg('shipping_delay_days')} AS avg_delay_days FROM fact GROUP BY ALL""",
    "a1_q10": f"""SELECT shipping_mode, COUNT(*) AS total_orders, {avg('days_for_shipping_real')} AS avg_shipping_days, {SALES}
      FROM {MODE} GROUP BY shipping_mode""",
    "a2_q01": f"""SELECT customer_segment, {ORDERS}, COUNT(DISTINCT customer_key) AS total_customers, {SP}, {MARGIN}
      FROM {CUSTOMER} GROUP BY 1""",
    "a2_q02": f"""SELECT category_name, {SALES}, CASE WHEN SUM(sales) >= 1000000 THEN 'High Sales'
      WHEN SUM(sales) >= 500000 THEN 'Medium Sales' ELSE 'Low Sales' END AS sales_performance_group FROM {CATEGORY} GROUP BY 1""",
    "a2_q03": above_key_mean("category", "category_name"),
    "a2_q04": SERVICE,
    "a2_q05": f"""SELECT market, {SP}, {MARGIN}, CASE WHEN SUM({P}) < 0 THEN 'Loss Market'
      WHEN {pct(f"SUM({P})", "SUM(sales)")} >= 15 THEN 'Strong Margin' ELSE 'Moderate Margin' END AS profitability_status
      FROM {GEO} GROUP BY 1""",
    "a2_q06": f"""SELECT coalesce(product_name, 'Unknown Product') AS product_name,
      coalesce(category_name, 'Unknown Category') AS category_name, {ORDERS}, {qty()} AS total_quantity, {SP}
      FROM fact f LEFT JOIN dim_product p USING (product_key) GROUP BY 1, 2 ORDER BY total_sales DESC, 1, 2 LIMIT 20""",
    "a2_q07": f"""SELECT {YEAR}, {MONTH}, month_name, {SP}, CASE WHEN SUM({P}) > 0 THEN 'Profitable Month'
      WHEN SUM({P}) = 0 THEN 'Break Even Month' ELSE 'Loss Month' END AS month_status FROM {DATE} GROUP BY ALL""",
    "a2_q08": f"""SELECT 'Profitable Items' AS item_group, COUNT(*) AS item_count, {SP} FROM fact WHERE {P} > 0
      UNION ALL SELECT 'Loss Items', COUNT(*), {total('sales')}, {total(P)} FROM fact WHERE {P} < 0""",
    "a2_q09": f"""SELECT customer_id, customer_segment, customer_country, {ORDERS}, {SP} FROM {CUSTOMER}
      GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT order_id) > 5""",
    "a2_q10": f"""SELECT market, operational_risk_segment, {ROWS}, {SP}, {avg('shipping_delay_days')} AS avg_delay_days,
      {rate('requires_management_attention')} AS management_attention_rate_pct FROM {GEO} GROUP BY 1, 2""",
    "a3_q01": above_key_mean("product", "product_name"),
    "a3_q02": f"""SELECT customer_id, customer_segment, {r('s')} AS customer_sales FROM (
        SELECT *, CAST(SUM(s) OVER (PARTITION BY customer_segment) AS DOUBLE) / COUNT(s) OVER (PARTITION BY customer_segment) AS m
        FROM (SELECT customer_id, customer_segment, SUM(sales) AS s FROM {CUSTOMER} GROUP BY 1, 2))
      WHERE CAST(s AS DOUBLE) > m""",
    "a3_q03": f"""SELECT DISTINCT category_name FROM dim_category c WHERE EXISTS (SELECT 1 FROM {PRODUCT}
      WHERE f.category_key = c.category_key AND f.{P} < 0)""",
    "a3_q04": f"""SELECT product_name FROM dim_product p WHERE product_key <> 0
      AND NOT EXISTS (SELECT 1 FROM fact f WHERE f.product_key = p.product_key AND f.{P} < 0)""",
    "a3_q05": f"SELECT market, {SP}, {MARGIN} FROM {GEO} GROUP BY 1 ORDER BY total_profit DESC, 1 LIMIT 1",
    "a3_q06": f"""SELECT order_id, {total('sales')} AS order_sales FROM fact GROUP BY 1
      HAVING CAST(SUM(sales) AS DOUBLE) > (SELECT {mean('s')} FROM (SELECT SUM(sales) AS s FROM fact GROUP BY order_id))""",
    "a3_q07": f"SELECT market, {r('rate * 100')} AS market_late_rate_pct FROM ({LATE_MARKETS})",
    "a3_q08": f"""SELECT customer_segment, {total('sales')} AS segment_sales,
      {r("CAST(SUM(sales) AS DOUBLE) / (SELECT CAST(SUM(sales) AS DOUBLE) FROM fact) * 100")} AS sales_contribution_pct
      FROM {CUSTOMER} GROUP BY 1 HAVING CAST(SUM(sales) AS DOUBLE) / (SELECT CAST(SUM(sales) AS DOUBLE) FROM fact) >= 0.20""",
    "a3_q09": """SELECT f.fact_order_item_key, f.order_item_id, f.customer_key, f.product_key, f.category_key FROM fact f
      LEFT JOIN dim_customer c ON c.customer_key = f.customer_key LEFT JOIN dim_product p ON p.product_key = f.product_key
      LEFT JOIN dim_category k ON k.category_key = f.category_key
      WHERE c.customer_key IS NULL OR p.product_key IS NULL OR k.category_key IS NULL""",
    "a3_q10": f"""SELECT category_name, department_name, CAST(t AS DOUBLE) AS total_profit, m AS department_average_profit,
        {r('CAST(t AS DOUBLE) - m')} AS difference_from_department_average FROM (
        SELECT *, CAST(SUM(t) OVER (PARTITION BY department_name) AS DOUBLE) / COUNT(t) OVER (PARTITION BY department_name) AS m
        FROM (SELECT category_name, department_name, SUM({P}) AS t FROM {CATEGORY} GROUP BY 1, 2))""",
    "a4_q01": f"""SELECT product_name, CAST(SUM(sales) AS DOUBLE) AS total_sales,
      row_number() OVER (ORDER BY SUM(sales) DESC, product_name) AS row_num FROM {PRODUCT} GROUP BY product_name""",
    "a4_q02": f"""SELECT product_name, CAST(SUM({P}) AS DOUBLE) AS total_profit, rank() OVER (ORDER BY SUM({P}) DESC) AS profit_rank
      FROM {PRODUCT} GROUP BY product_name""",
    "a4_q03": f"""SELECT category_name, CAST(SUM(sales) AS DOUBLE) AS total_sales,
      dense_rank() OVER (ORDER BY SUM(sales) DESC) AS sales_rank FROM {CATEGORY} GROUP BY category_name""",
    "a4_q04": """SELECT market, category_name, CAST(SUM(sales) AS DOUBLE) AS total_sales,
      row_number() OVER (PARTITION BY market ORDER BY SUM(sales) DESC, category_name) AS market_rank
      FROM fact JOIN dim_geography USING (geography_key) JOIN dim_category USING (category_key) GROUP BY market, category_name""",
    "a4_q05": f"""SELECT calendar_year, calendar_month, calendar_year_month, CAST(total_sales AS DOUBLE) AS total_sales,
      CAST(LAG(total_sales) {BY_MONTH} AS DOUBLE) AS previous_month_sales,
      CAST(total_sales - LAG(total_sales) {BY_MONTH} AS DOUBLE) AS sales_change FROM monthly""",
    "a4_q06": f"""SELECT calendar_year, calendar_month, calendar_year_month, CAST(total_sales AS DOUBLE) AS total_sales,
      CAST(LEAD(total_sales) {BY_MONTH} AS DOUBLE) AS next_month_sales FROM monthly""",
    "a4_q07": f"""SELECT calendar_year_month, CAST(total_sales AS DOUBLE) AS monthly_sales,
      CAST(SUM(total_sales) {BY_MONTH} AS DOUBLE) AS running_total_sales FROM monthly""",
    "a4_q08": f"""SELECT calendar_year, calendar_month, calendar_year_month, CAST(total_sales AS DOUBLE) AS total_sales,
      CAST(SUM(total_sales) OVER w AS DOUBLE) / COUNT(total_sales) OVER w AS moving_avg_3_months FROM monthly
      WINDOW w AS (ORDER BY calendar_year, calendar_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "a4_q09": f"""SELECT customer_id, CAST(SUM(sales) AS DOUBLE) AS total_sales,
      ntile(4) OVER (ORDER BY SUM(sales) DESC, customer_id NULLS FIRST) AS sales_quartile FROM {CUSTOMER} GROUP BY customer_id""",
    "a4_q10": """SELECT market, calendar_year_month, CAST(s AS DOUBLE) AS total_sales,
      CAST(first_value(s) OVER (PARTITION BY market ORDER BY calendar_year_month) AS DOUBLE) AS first_month_sales,
      CAST(last_value(s) OVER (PARTITION BY market ORDER BY calendar_year_month
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS DOUBLE) AS last_month_sales
      FROM (SELECT market, calendar_year_month, SUM(sales) AS s FROM fact JOIN dim_geography USING (geography_key)
        JOIN dim_date ON date_key = order_date_key GROUP BY market, calendar_year_month)""",
    "a5_q01": f"SELECT {YEAR}, {MONTH}, calendar_year_month, {SP}, {ORDERS}, {MARGIN} FROM {DATE} GROUP BY ALL",
    "a5_q02": f"""SELECT product_name, category_name, {r('s')} AS total_sales, {r('p')} AS total_profit, total_quantity FROM (
      SELECT product_key, p.product_name, p.category_name, SUM(sales) AS s, SUM({P}) AS p, {qty()} AS total_quantity
      FROM {PRODUCT} GROUP BY 1, 2, 3 ORDER BY s DESC, product_key LIMIT 10)""",
    "a5_q03": f"""SELECT customer_id, customer_segment, customer_country, total_orders, {r('s')} AS total_sales,
      {r('p')} AS total_profit, {r('m')} AS average_customer_sales FROM (
        SELECT *, CAST(SUM(s) OVER () AS DOUBLE) / COUNT(s) OVER () AS m FROM (
          SELECT customer_key, customer_id, customer_segment, customer_country, SUM(sales) AS s, SUM({P}) AS p, {ORDERS}
          FROM {CUSTOMER} GROUP BY 1, 2, 3, 4)) WHERE CAST(s AS DOUBLE) > m""",
    "a5_q04": f"""SELECT category_name, department_name, {r('s')} AS total_sales, {r('p')} AS total_profit,
      {r(pct('p', 's'))} AS profit_margin_pct, dense_rank() OVER (ORDER BY p DESC) AS profit_rank FROM (
        SELECT category_key, category_name, department_name, SUM(sales) AS s, SUM({P}) AS p FROM {CATEGORY} GROUP BY 1, 2, 3)""",
    "a5_q05": f"""SELECT market, n AS order_item_rows, {r('rate * 100')} AS market_late_delivery_rate_pct,
      {r('overall * 100')} AS global_late_delivery_rate_pct FROM ({LATE_MARKETS})""",
    "a5_q06": SERVICE,
    "a5_q07": f"""SELECT discount_band, {ROWS}, {SP}, {avg('discount_rate_pct')} AS avg_discount_rate_pct,
      {avg('profit_margin_pct')} AS avg_profit_margin_pct FROM fact GROUP BY 1""",
    "a5_q08": f"""SELECT category_name, {ROWS}, {qty('requires_management_attention')} AS attention_items,
      {r(pct('SUM(requires_management_attention)', 'COUNT(*)'))} AS attention_rate_pct,
      {rate('is_late_delivery')} AS late_delivery_rate_pct, {rate('is_loss_item')} AS loss_item_rate_pct, {SP}
      FROM {CATEGORY} GROUP BY 1""",
    "a5_q09": f"""SELECT CAST(y AS BIGINT) AS calendar_year, {r('s')} AS total_sales, {r('p')} AS total_profit,
      {r('b')} AS previous_year_sales, {r(pct('s - b', 'b'))} AS sales_growth_pct FROM (
        SELECT *, LAG(s) OVER (ORDER BY y) AS b FROM (
          SELECT calendar_year AS y, SUM(sales) AS s, SUM({P}) AS p FROM {DATE} GROUP BY 1))""",
    "a5_q10": f"""SELECT n AS month_number, monthname(make_date(2000, CAST(n AS INTEGER), 1)) AS month_name,
      {r('coalesce(s, 0)')} AS total_sales FROM range(1, 13) t(n)
      LEFT JOIN (SELECT calendar_month AS m, SUM(sales) AS s FROM {DATE} GROUP BY 1) ON m = n""",
}

QUESTIONS = {
    name: on_star(body, f",\n{MONTHLY}" if "FROM monthly" in body else "") for name, body in BODIES.items()
}
