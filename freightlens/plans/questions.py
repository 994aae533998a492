"""The fifty business questions over the star schema, in five groups of ten.

Rankings, top-n and NTILE end in a natural key so that ties resolve the same way every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from freightlens.functions.features import PROFIT
from freightlens.functions.numbers import mean, percent, ratio, rounded
from freightlens.operators import ranking
from freightlens.operators.distinct import with_distinct_counts
from freightlens.plans.measures import (
    average, average_of, item_rows, margin_of, margin_pct, orders, rate_of, rows_of, sales_and_profit,
    sales_and_profit_of, subtotals, sum_of, total_of,
)
from freightlens.plans.warehouse import Warehouse

SALES = "sales"


def by_sales() -> Column:
    return F.desc("total_sales")


def _sales_by(w: Warehouse, dim: str, attributes: list[str], *columns: str, key: str | None = None) -> DataFrame:
    """Subtotals of sales (and more columns) per surrogate key, with the dimension's attributes."""
    per_key = subtotals(w.fact, [key or f"{dim}_key"], [SALES, *columns])
    return w.attach(per_key, dim, attributes, on=key)


def _by_month(w: Warehouse, *columns: str) -> DataFrame:
    """Unrounded sales per calendar month; there are as many rows as months."""
    months = ["calendar_year", "calendar_month", "calendar_year_month"]
    return (
        _sales_by(w, "date", months, *columns, key="order_date_key")
        .groupBy(*months)
        .agg(sum_of(SALES).alias("total_sales"), *[sum_of(c).alias(c) for c in columns])
    )


def in_month_order() -> WindowSpec:
    """Over one row per calendar month, so one task is enough for it."""
    return Window.orderBy("calendar_year", "calendar_month")


# ---- basic ---------------------------------------------------------------------------------------


def first_fact_rows(w: Warehouse) -> DataFrame:
    return w.fact.orderBy("fact_order_item_key").limit(20)


def count_order_items(w: Warehouse) -> DataFrame:
    return w.fact.agg(F.count("*").alias("total_order_items"))


def count_customers(w: Warehouse) -> DataFrame:
    return w.fact.agg(F.count_distinct("customer_key").alias("total_customers"))


def sales_totals(w: Warehouse) -> DataFrame:
    return w.fact.agg(*sales_and_profit())


def top_products(w: Warehouse) -> DataFrame:
    sold = _sales_by(w, "product", ["product_name"]).groupBy("product_name").agg(total_of(SALES, "total_sales"))
    return sold.orderBy(by_sales(), "product_name").limit(10)


def sales_by_segment(w: Warehouse) -> DataFrame:
    sold = _sales_by(w, "customer", ["customer_segment"]).groupBy("customer_segment")
    return sold.agg(total_of(SALES, "total_sales")).orderBy(by_sales(), "customer_segment")


def sales_by_category(w: Warehouse) -> DataFrame:
    sold = _sales_by(w, "category", ["category_name"]).groupBy("category_name")
    return sold.agg(total_of(SALES, "total_sales")).orderBy(by_sales(), "category_name")


def sales_by_month(w: Warehouse) -> DataFrame:
    month = ["calendar_year", "calendar_month", "month_name"]
    sold = _sales_by(w, "date", month, key="order_date_key").groupBy(*month)
    return sold.agg(total_of(SALES, "total_sales")).orderBy("calendar_year", "calendar_month")


def delay_by_late_flag(w: Warehouse) -> DataFrame:
    return w.fact.groupBy("is_late_delivery").agg(
        item_rows("total_rows"), average("shipping_delay_days", "avg_delay_days")
    )


def shipping_mode_totals(w: Warehouse) -> DataFrame:
    sold = _sales_by(w, "shipping_mode", ["shipping_mode"], "days_for_shipping_real").groupBy("shipping_mode")
    return sold.agg(
        rows_of("total_orders"),
        average_of("days_for_shipping_real", "avg_shipping_days"),
        total_of(SALES, "total_sales"),
    ).orderBy(by_sales(), "shipping_mode")


# ---- grouped -------------------------------------------------------------------------------------


def segment_profit(w: Warehouse) -> DataFrame:
    per_order = subtotals(w.fact, ["customer_key", "order_id"], [SALES, PROFIT])
    return (
        w.attach(per_order, "customer", ["customer_segment"])
        .groupBy("customer_segment")
        .agg(
            orders(), F.count_distinct("customer_key").alias("total_customers"), *sales_and_profit_of(), margin_of()
        )
        .orderBy(by_sales(), "customer_segment")
    )


def category_sales_class(w: Warehouse) -> DataFrame:
    sold = sum_of(SALES)
    label = F.when(sold >= 1_000_000, "High Sales").when(sold >= 500_000, "Medium Sales").otherwise("Low Sales")
    return (
        _sales_by(w, "category", ["category_name"])
        .groupBy("category_name")
        .agg(total_of(SALES, "total_sales"), label.alias("sales_performance_group"))
        .orderBy(by_sales(), "category_name")
    )


def _above_key_mean(w: Warehouse, dim: str, name: str) -> DataFrame:
    """Names whose sales exceed the mean of the sales per surrogate key."""
    per_key = subtotals(w.fact, [f"{dim}_key"], [SALES])
    benchmark = per_key.agg(mean("sales_sum")).scalar()
    return (
        w.attach(per_key, dim, [name])
        .groupBy(name)
        .agg(sum_of(SALES).alias("_sales"))
        .where(F.col("_sales").cast("double") > benchmark)
        .select(name, rounded(F.col("_sales")).alias("total_sales"))
        .orderBy(by_sales(), name)
    )


def categories_above_mean(w: Warehouse) -> DataFrame:
    return _above_key_mean(w, "category", "category_name")


def _service(w: Warehouse) -> DataFrame:
    measures = ["days_for_shipping_real", "days_for_shipment_scheduled", "shipping_delay_days", "is_late_delivery"]
    return (
        _sales_by(w, "shipping_mode", ["shipping_mode", "service_level_group"], *measures)
        .groupBy("shipping_mode", "service_level_group")
        .agg(
            rows_of(),
            average_of("days_for_shipping_real", "avg_actual_days"),
            average_of("days_for_shipment_scheduled", "avg_scheduled_days"),
            average_of("shipping_delay_days", "avg_delay_days"),
            rate_of("is_late_delivery", "late_delivery_rate_pct"),
        )
        .orderBy(F.desc("late_delivery_rate_pct"), "shipping_mode")
    )


def service_levels(w: Warehouse) -> DataFrame:
    return _service(w)


def market_profit_class(w: Warehouse) -> DataFrame:
    profit = sum_of(PROFIT)
    label = (
        F.when(profit < 0, "Loss Market")
        .when(percent(profit, sum_of(SALES)) >= 15, "Strong Margin")
        .otherwise("Moderate Margin")
    )
    return (
        _sales_by(w, "geography", ["market"], PROFIT)
        .groupBy("market")
        .agg(*sales_and_profit_of(), margin_of(), label.alias("profitability_status"))
        .orderBy(F.desc("total_profit"), "market")
    )


def labelled_products(w: Warehouse) -> DataFrame:
    names = ["product_name", "category_name"]

    def labelled(rows: DataFrame) -> DataFrame:
        named = w.attach(rows, "product", names, how="left")
        return named.fillna({"product_name": "Unknown Product", "category_name": "Unknown Category"})

    per_key = subtotals(w.fact, ["product_key"], [SALES, PROFIT, "order_item_quantity"])
    groups = labelled(per_key).groupBy(*names).agg(sum_of("order_item_quantity").alias("total_quantity"), *sales_and_profit_of())
    counted = with_distinct_counts(groups, w.fact, names, {"total_orders": "order_id"}, by=["product_key"], attach=labelled)
    return counted.orderBy(by_sales(), *names).limit(20)


def month_status(w: Warehouse) -> DataFrame:
    month = ["calendar_year", "calendar_month", "month_name"]
    profit = sum_of(PROFIT)
    label = F.when(profit > 0, "Profitable Month").when(profit == 0, "Break Even Month").otherwise("Loss Month")
    return (
        _sales_by(w, "date", month, PROFIT, key="order_date_key")
        .groupBy(*month)
        .agg(*sales_and_profit_of(), label.alias("month_status"))
        .orderBy("calendar_year", "calendar_month")
    )


def profitable_and_loss_items(w: Warehouse) -> DataFrame:
    def group(label: str, condition) -> DataFrame:
        found = w.fact.where(condition).agg(item_rows("item_count"), *sales_and_profit())
        return found.select(F.lit(label).alias("item_group"), *found.columns)

    return group("Profitable Items", F.col(PROFIT) > 0).unionByName(group("Loss Items", F.col(PROFIT) < 0))


def frequent_customers(w: Warehouse) -> DataFrame:
    """Customers with more than five orders. Grouping by key first is the same, as the id is part of the group."""
    per_key = w.fact.groupBy("customer_key").agg(orders(), *sales_and_profit()).where("total_orders > 5")
    return (
        w.attach(per_key, "customer", ["customer_id", "customer_segment", "customer_country"])
        .drop("customer_key")
        .orderBy(by_sales(), "customer_id")
    )


def risk_by_market(w: Warehouse) -> DataFrame:
    per_key = subtotals(
        w.fact, ["geography_key", "operational_risk_segment"],
        [SALES, PROFIT, "shipping_delay_days", "requires_management_attention"],
    )
    return (
        w.attach(per_key, "geography", ["market"])
        .groupBy("market", "operational_risk_segment")
        .agg(
            rows_of(), *sales_and_profit_of(),
            average_of("shipping_delay_days", "avg_delay_days"),
            rate_of("requires_management_attention", "management_attention_rate_pct"),
        )
        .orderBy("market", F.desc("order_item_rows"), "operational_risk_segment")
    )


# ---- subqueries ----------------------------------------------------------------------------------


def products_above_mean(w: Warehouse) -> DataFrame:
    return _above_key_mean(w, "product", "product_name")


def customers_above_segment_mean(w: Warehouse) -> DataFrame:
    """The segment means form a small frame of their own, so that no segment gathers in one window task."""
    per_customer = (
        _sales_by(w, "customer", ["customer_id", "customer_segment"])
        .groupBy("customer_id", "customer_segment")
        .agg(sum_of(SALES).alias("_sales"))
    )
    means = per_customer.groupBy(F.col("customer_segment").alias("_segment")).agg(mean("_sales").alias("_mean"))
    return (
        per_customer.join(means, F.col("customer_segment") == F.col("_segment"))
        .where(F.col("_sales").cast("double") > F.col("_mean"))
        .select("customer_id", "customer_segment", rounded(F.col("_sales")).alias("customer_sales"))
        .orderBy(F.desc("customer_sales"), "customer_id")
    )


def categories_with_loss(w: Warehouse) -> DataFrame:
    losses = w.fact.where(F.col(PROFIT) < 0).select("category_key", "product_key").distinct()
    losses = w.attach(losses, "product", ["product_name"])
    return w.dim("category").join(losses, "category_key", "left_semi").select("category_name").distinct()


def products_without_loss(w: Warehouse) -> DataFrame:
    losing = w.fact.where(F.col(PROFIT) < 0).select("product_key").distinct()
    return (
        w.dim("product").where("product_key <> 0").join(losing, "product_key", "left_anti")
        .select("product_name").orderBy("product_name")
    )


def best_market(w: Warehouse) -> DataFrame:
    markets = _sales_by(w, "geography", ["market"], PROFIT).groupBy("market").agg(*sales_and_profit_of(), margin_of())
    return markets.orderBy(F.desc("total_profit"), "market").limit(1)


def orders_above_mean(w: Warehouse) -> DataFrame:
    per_order = w.fact.groupBy("order_id").agg(F.sum(SALES).alias("_sales"))
    benchmark = per_order.agg(mean("_sales")).scalar()
    return (
        per_order.where(F.col("_sales").cast("double") > benchmark)
        .select("order_id", rounded(F.col("_sales")).alias("order_sales"))
        .orderBy(F.desc("order_sales"), "order_id")
    )


def _late_markets(w: Warehouse) -> DataFrame:
    overall = w.fact.agg(mean("is_late_delivery")).scalar()
    return (
        _sales_by(w, "geography", ["market"], "is_late_delivery")
        .groupBy("market")
        .agg(rows_of(), ratio(sum_of("is_late_delivery"), F.sum("is_late_delivery_n")).alias("_rate"))
        .withColumn("_overall", overall)
        .where("_rate > _overall")
    )


def late_markets(w: Warehouse) -> DataFrame:
    found = _late_markets(w).select("market", rounded(F.col("_rate") * 100).alias("market_late_rate_pct"))
    return found.orderBy(F.desc("market_late_rate_pct"), "market")


def major_segments(w: Warehouse) -> DataFrame:
    per_key = subtotals(w.fact, ["customer_key"], [SALES])
    everything = w.fact.agg(F.sum(SALES)).scalar()
    return (
        w.attach(per_key, "customer", ["customer_segment"])
        .groupBy("customer_segment")
        .agg(sum_of(SALES).alias("_sales"))
        .withColumn("_share", ratio(F.col("_sales"), everything))
        .where("_share >= 0.20D")
        .select(
            "customer_segment",
            rounded(F.col("_sales")).alias("segment_sales"),
            rounded(F.col("_share") * 100).alias("sales_contribution_pct"),
        )
        .orderBy(F.desc("segment_sales"), "customer_segment")
    )


def orphan_fact_rows(w: Warehouse) -> DataFrame:
    """Fact rows with a key that has no member. The distinct keys meet the dimensions first; what is left of
    them is normally nothing, so the rows themselves need no shuffle."""
    keys = ["customer_key", "product_key", "category_key"]
    rows = w.fact.select("fact_order_item_key", "order_item_id", *keys)
    for key in keys:
        known = w.dim(key.removesuffix("_key")).select(key)
        orphans = w.fact.select(key).distinct().join(known, key, "left_anti")
        rows = rows.join(orphans.withColumn(f"_no_{key}", F.lit(True)), key, "left")
    return rows.where(" or ".join(f"_no_{k}" for k in keys)).select("fact_order_item_key", "order_item_id", *keys)


def category_vs_department(w: Warehouse) -> DataFrame:
    names = ["category_name", "department_name"]
    per_category = _sales_by(w, "category", names, PROFIT).groupBy(*names).agg(sum_of(PROFIT).alias("total_profit"))
    means = per_category.groupBy(F.col("department_name").alias("_department")).agg(
        mean("total_profit").alias("department_average_profit")
    )
    joined = per_category.join(means, F.col("department_name").eqNullSafe(F.col("_department")))
    return joined.select(
        *names,
        "total_profit",
        "department_average_profit",
        rounded(F.col("total_profit").cast("double") - F.col("department_average_profit")).alias(
            "difference_from_department_average"
        ),
    ).orderBy(F.desc("difference_from_department_average"), "category_name")


# ---- windows -------------------------------------------------------------------------------------


def _per_product_name(w: Warehouse, measure: str, name: str) -> DataFrame:
    per_key = w.attach(subtotals(w.fact, ["product_key"], [measure]), "product", ["product_name"])
    return per_key.groupBy("product_name").agg(sum_of(measure).alias(name))


def number_products(w: Warehouse) -> DataFrame:
    products = _per_product_name(w, SALES, "total_sales")
    order = [by_sales(), F.asc("product_name")]
    return ranking.row_number(w.workspace, products, order, "row_num")


def rank_products(w: Warehouse) -> DataFrame:
    products = _per_product_name(w, PROFIT, "total_profit")
    return ranking.rank(w.workspace, products, "total_profit", "profit_rank")


def rank_categories(w: Warehouse) -> DataFrame:
    categories = _sales_by(w, "category", ["category_name"]).groupBy("category_name").agg(sum_of(SALES).alias("total_sales"))
    return ranking.rank(w.workspace, categories, "total_sales", "sales_rank", dense=True)


def rank_categories_in_market(w: Warehouse) -> DataFrame:
    per_key = subtotals(w.fact, ["geography_key", "category_key"], [SALES])
    per_key = w.attach(w.attach(per_key, "geography", ["market"]), "category", ["category_name"])
    sold = per_key.groupBy("market", "category_name").agg(sum_of(SALES).alias("total_sales"))
    order = [by_sales(), F.asc("category_name")]
    return ranking.row_number(w.workspace, sold, order, "market_rank", ["market"])


def previous_month(w: Warehouse) -> DataFrame:
    before = F.lag("total_sales").over(in_month_order())
    return _by_month(w).withColumns({"previous_month_sales": before, "sales_change": F.col("total_sales") - before})


def next_month(w: Warehouse) -> DataFrame:
    return _by_month(w).withColumn("next_month_sales", F.lead("total_sales").over(in_month_order()))


def running_total(w: Warehouse) -> DataFrame:
    months = _by_month(w)
    return months.select(
        "calendar_year_month",
        F.col("total_sales").alias("monthly_sales"),
        F.sum("total_sales").over(in_month_order()).alias("running_total_sales"),
    )


def moving_average(w: Warehouse) -> DataFrame:
    three = in_month_order().rowsBetween(-2, 0)
    average_3 = ratio(F.sum("total_sales").over(three), F.count("total_sales").over(three))
    return _by_month(w).withColumn("moving_avg_3_months", average_3)


def customer_quartiles(w: Warehouse) -> DataFrame:
    sold = _sales_by(w, "customer", ["customer_id"]).groupBy("customer_id").agg(sum_of(SALES).alias("total_sales"))
    order = [by_sales(), F.asc_nulls_first("customer_id")]
    return ranking.ntile(w.workspace, sold, 4, order, "sales_quartile")


def first_and_last_month(w: Warehouse) -> DataFrame:
    per_key = subtotals(w.fact, ["geography_key", "order_date_key"], [SALES])
    per_key = w.attach(w.attach(per_key, "geography", ["market"]), "date", ["calendar_year_month"], on="order_date_key")
    sold = per_key.groupBy("market", "calendar_year_month").agg(sum_of(SALES).alias("total_sales"))
    months = Window.partitionBy("market").orderBy("calendar_year_month")  # one row per month and market
    whole = months.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sold.withColumns(
        {
            "first_month_sales": F.first_value("total_sales").over(months),
            "last_month_sales": F.last_value("total_sales").over(whole),
        }
    )


# ---- staged --------------------------------------------------------------------------------------


def monthly_margin(w: Warehouse) -> DataFrame:
    month = ["calendar_year", "calendar_month", "calendar_year_month"]
    return (
        w.attach(w.fact, "date", month, on="order_date_key")
        .groupBy(*month)
        .agg(*sales_and_profit(), orders(), margin_pct())
        .orderBy("calendar_year", "calendar_month")
    )


def top_product_keys(w: Warehouse) -> DataFrame:
    per_key = w.fact.groupBy("product_key").agg(
        F.sum(SALES).alias("_sales"), *sales_and_profit(), F.sum("order_item_quantity").alias("total_quantity")
    )
    ten = w.attach(per_key, "product", ["product_name", "category_name"])
    ten = ten.orderBy(F.desc("_sales"), "product_key").limit(10)
    return ten.select("product_name", "category_name", "total_sales", "total_profit", "total_quantity")


def high_value_customers(w: Warehouse) -> DataFrame:
    per_key = w.fact.groupBy("customer_key").agg(F.sum(SALES).alias("_sales"), F.sum(PROFIT).alias("_profit"), orders())
    benchmark = subtotals(w.fact, ["customer_key"], [SALES]).agg(mean("sales_sum")).scalar()
    above = per_key.withColumn("_mean", benchmark).where(F.col("_sales").cast("double") > F.col("_mean"))
    return (
        w.attach(above, "customer", ["customer_id", "customer_segment", "customer_country"])
        .select(
            "customer_id", "customer_segment", "customer_country", "total_orders",
            rounded(F.col("_sales")).alias("total_sales"),
            rounded(F.col("_profit")).alias("total_profit"),
            rounded(F.col("_mean")).alias("average_customer_sales"),
        )
        .orderBy(by_sales(), "customer_id")
    )


def category_profit_rank(w: Warehouse) -> DataFrame:
    per_key = w.fact.groupBy("category_key").agg(F.sum(SALES).alias("_sales"), F.sum(PROFIT).alias("_profit"))
    ranked = ranking.rank(w.workspace, per_key, "_profit", "profit_rank", dense=True)
    return (
        w.attach(ranked, "category", ["category_name", "department_name"])
        .select(
            "category_name", "department_name",
            rounded(F.col("_sales")).alias("total_sales"),
            rounded(F.col("_profit")).alias("total_profit"),
            rounded(percent(F.col("_profit"), F.col("_sales"))).alias("profit_margin_pct"),
            "profit_rank",
        )
        .orderBy("profit_rank", "category_name")
    )


def late_markets_with_baseline(w: Warehouse) -> DataFrame:
    return (
        _late_markets(w)
        .orderBy(F.desc("_rate"), "market")
        .select(
            "market", "order_item_rows",
            rounded(F.col("_rate") * 100).alias("market_late_delivery_rate_pct"),
            rounded(F.col("_overall") * 100).alias("global_late_delivery_rate_pct"),
        )
    )


def shipping_service(w: Warehouse) -> DataFrame:
    return _service(w)


def discount_impact(w: Warehouse) -> DataFrame:
    return (
        w.fact.groupBy("discount_band")
        .agg(
            item_rows(), *sales_and_profit(),
            average("discount_rate_pct", "avg_discount_rate_pct"),
            average("profit_margin_pct", "avg_profit_margin_pct"),
        )
        .orderBy("avg_discount_rate_pct", "discount_band")
    )


def category_risk(w: Warehouse) -> DataFrame:
    measures = ["requires_management_attention", "is_late_delivery", "is_loss_item", PROFIT]
    return (
        _sales_by(w, "category", ["category_name"], *measures)
        .groupBy("category_name")
        .agg(
            rows_of(),
            sum_of("requires_management_attention").alias("attention_items"),
            rounded(percent(sum_of("requires_management_attention"), F.sum("n"))).alias("attention_rate_pct"),
            rate_of("is_late_delivery", "late_delivery_rate_pct"),
            rate_of("is_loss_item", "loss_item_rate_pct"),
            *sales_and_profit_of(),
        )
        .orderBy(F.desc("attention_rate_pct"), "category_name")
    )


def yearly_growth(w: Warehouse) -> DataFrame:
    per_year = (
        _sales_by(w, "date", ["calendar_year"], PROFIT, key="order_date_key")
        .groupBy("calendar_year")
        .agg(sum_of(SALES).alias("_sales"), sum_of(PROFIT).alias("_profit"))
        .withColumn("_before", F.lag("_sales").over(Window.orderBy("calendar_year")))  # one row per year
    )
    return per_year.select(
        "calendar_year",
        rounded(F.col("_sales")).alias("total_sales"),
        rounded(F.col("_profit")).alias("total_profit"),
        rounded(F.col("_before")).alias("previous_year_sales"),
        rounded(percent(F.col("_sales") - F.col("_before"), F.col("_before"))).alias("sales_growth_pct"),
    ).orderBy("calendar_year")


def month_of_year_sales(w: Warehouse) -> DataFrame:
    """All twelve months, zero where nothing was sold."""
    sold = (
        _sales_by(w, "date", ["calendar_month"], key="order_date_key")
        .groupBy("calendar_month")
        .agg(sum_of(SALES).alias("_sales"))
    )
    months = w.spark.range(1, 13).select(F.col("id").cast("int").alias("month_number"))
    return (
        months.join(sold, F.col("month_number") == F.col("calendar_month"), "left")
        .select(
            "month_number",
            F.date_format(F.make_date(F.lit(2000), F.col("month_number"), F.lit(1)), "MMMM").alias("month_name"),
            rounded(F.coalesce("_sales", F.lit(0))).alias("total_sales"),
        )
        .orderBy("month_number")
    )


QUESTIONS = {
    "a1_q01": first_fact_rows, "a1_q02": count_order_items, "a1_q03": count_customers, "a1_q04": sales_totals,
    "a1_q05": top_products, "a1_q06": sales_by_segment, "a1_q07": sales_by_category, "a1_q08": sales_by_month,
    "a1_q09": delay_by_late_flag, "a1_q10": shipping_mode_totals,
    "a2_q01": segment_profit, "a2_q02": category_sales_class, "a2_q03": categories_above_mean, "a2_q04": service_levels,
    "a2_q05": market_profit_class, "a2_q06": labelled_products, "a2_q07": month_status,
    "a2_q08": profitable_and_loss_items, "a2_q09": frequent_customers, "a2_q10": risk_by_market,
    "a3_q01": products_above_mean, "a3_q02": customers_above_segment_mean, "a3_q03": categories_with_loss,
    "a3_q04": products_without_loss, "a3_q05": best_market, "a3_q06": orders_above_mean, "a3_q07": late_markets,
    "a3_q08": major_segments, "a3_q09": orphan_fact_rows, "a3_q10": category_vs_department,
    "a4_q01": number_products, "a4_q02": rank_products, "a4_q03": rank_categories, "a4_q04": rank_categories_in_market,
    "a4_q05": previous_month, "a4_q06": next_month, "a4_q07": running_total, "a4_q08": moving_average,
    "a4_q09": customer_quartiles, "a4_q10": first_and_last_month,
    "a5_q01": monthly_margin, "a5_q02": top_product_keys, "a5_q03": high_value_customers, "a5_q04": category_profit_rank,
    "a5_q05": late_markets_with_baseline, "a5_q06": shipping_service, "a5_q07": discount_impact,
    "a5_q08": category_risk, "a5_q09": yearly_growth, "a5_q10": month_of_year_sales,
}
