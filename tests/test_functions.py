"""Edge values of names, text, dates and row features."""

from decimal import Decimal

from pyspark.sql import functions as F

from freightlens.functions import dates, features, numbers, text
from freightlens.operators import cleaning


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_snake_case():
    names = {
        "Days for shipping (real)": "days_for_shipping", " order date (DateOrders)": "order_date",
        "Late_delivery_risk": "late_delivery_risk", "Margin %": "margin_percent", "A--b  c": "a_b_c",
    }
    assert {n: text.snake_case(n) for n in names} == names


def test_clean_names_keep_real_and_scheduled_apart():
    assert cleaning.clean_name("Days for shipping (real)") == "days_for_shipping_real"
    assert cleaning.clean_name("Days for shipment (scheduled)") == "days_for_shipment_scheduled"
    assert cleaning.clean_name("Benefit per order") == "order_profit"


def test_squeezed(spark):
    values = ["", "  ", "nan", "None", " a\t b \n", "None such", None]
    assert column(spark, values, "string", text.squeezed) == [None, None, None, None, "a b", "None such", None]


def test_title_case(spark):
    values = ["o'neil smith-jones", "SAN JOSÉ", "los angeles (ca)", "x2y", None]
    assert column(spark, values, "string", text.title_case) == [v and v.title() for v in values]


def test_parse_datetime(spark):
    values = ["1/31/2018 22:56", "2018-01-31 22:56:00", "2018-01-31", " 2018-01-31 ", "13/41/2018 22:56", "2018", "", None, "31.01.2018"]
    got = [v and str(v) for v in column(spark, values, "string", dates.parse_datetime)]
    assert got == ["2018-01-31 22:56:00", "2018-01-31 22:56:00", "2018-01-31 00:00:00", "2018-01-31 00:00:00", None, None, None, None, None]
    stamps = column(spark, values, "string", lambda c: dates.parse_datetime(c, date_only=False))
    assert [v is not None for v in stamps[:4]] == [True, True, False, False]


def test_typed_numbers(spark):
    values = ["3", "3.0", "3.5", "abc", "", None]
    assert column(spark, values, "string", lambda c: cleaning.typed(c, "int")) == [3, 3, None, None, None, None]
    assert column(spark, ["1.23456", "x"], "string", lambda c: cleaning.typed(c, "decimal(18,4)")) == [Decimal("1.2346"), None]


def test_rounded_is_half_up(spark):
    assert column(spark, [1.005, 2.675, -1.005, None], "double", numbers.rounded) == [
        Decimal("1.01"), Decimal("2.68"), Decimal("-1.01"), None,
    ]


def test_bands(spark):
    margins = column(spark, [-1.0, 0.0, 0.01, 10.0, 20.0, 30.0, 31.0, None], "double", lambda c: features.band(c, features.MARGIN_BANDS))
    assert margins == ["Negative", "Negative", "0–10%", "0–10%", "10–20%", "20–30%", "30%+", None]
    discounts = column(spark, [0.0, 5.0, 10.0, 20.0, 21.0], "double", lambda c: features.band(c, features.DISCOUNT_BANDS))
    assert discounts == ["No Discount", "0–5%", "5–10%", "10–20%", "20%+"]


def test_discount_rate_is_a_share_or_a_percentage(spark):
    df = spark.createDataFrame([(Decimal("1"),), (Decimal("1.5"),), (Decimal("0.07"),), (None,)], "order_item_discount_rate decimal(12,6)")
    got = [r["discount_rate_pct"] for r in features.add_discount_rate_pct(df).collect()]
    assert got == [Decimal("100"), Decimal("1.5"), Decimal("7"), None]


def test_delays(spark):
    days = [(1, 2), (2, 2), (3, 2), (4, 2), (5, 2), (6, 2), (None, 2), (2, None), (3, 0), (7, 7)]
    df = spark.createDataFrame(days, "days_for_shipping_real int, days_for_shipment_scheduled int")
    for step in (
        features.add_delay, features.add_delivery_performance, features.add_delivery_flags, features.add_efficiency_ratio,
        features.add_delay_severity, features.add_speed_segment,
    ):
        df = df.transform(step)
    rows = df.collect()
    assert [r.delivery_delay_severity for r in rows] == [
        "Early", "On Schedule", "1 Day Late", "2–3 Days Late", "2–3 Days Late", "4+ Days Late", "Unknown", "Unknown", "2–3 Days Late", "On Schedule",
    ]
    assert [r.delivery_performance for r in rows][5:8] == ["Late", "Unknown", "Unknown"]
    assert [(r.is_late_delivery, r.is_on_time_delivery) for r in rows][:3] == [(0, 1), (0, 1), (1, 0)]
    assert (rows[6].is_late_delivery, rows[6].is_on_time_delivery) == (None, None)
    assert [r.shipping_speed_segment for r in rows][:6] == ["Express", "Express", "Standard", "Standard", "Slow", "Slow"]
    assert (rows[6].shipping_speed_segment, rows[9].shipping_speed_segment) == ("Unknown", "Very Slow")
    assert rows[8].shipping_efficiency_ratio is None and rows[0].shipping_efficiency_ratio == Decimal("0.5")


def test_profit_and_risk(spark):
    rows = [(Decimal(p) if p is not None else None, Decimal(s), late) for p, s, late in
            [(5, 10, 1), (0, 10, 1), (-5, 10, 1), (-5, 10, 0), (None, 10, 0), (5, 0, None), (-5, 10, None)]]
    df = spark.createDataFrame(rows, "order_profit_per_order decimal(18,4), sales decimal(18,4), is_late_delivery int")
    for step in (features.add_margin, features.add_margin_band, features.add_profitability, features.add_attention_flag, features.add_risk_segment):
        df = df.transform(step)
    got = df.collect()
    assert [r.profitability_status for r in got] == ["Profitable", "Break Even", "Loss", "Loss", "Unknown", "Profitable", "Loss"]
    assert [r.operational_risk_segment for r in got] == ["Late Only", "Late Only", "Late and Loss", "Loss Only", "Healthy", "Healthy", "Healthy"]
    assert [r.requires_management_attention for r in got] == [1, 1, 1, 1, 0, 0, 1]
    assert got[5].profit_margin_pct is None and got[5].margin_band is None and got[1].margin_band == "Negative"
    assert (got[4].is_profitable_item, got[4].is_loss_item) == (0, 0)


def test_missing_date_is_no_weekend(spark):
    df = spark.sql("select cast(null as timestamp_ntz) as order_date, timestamp_ntz'2024-01-06 10:00:00' as shipping_date")
    row = features.add_calendar(df).first()
    assert (row.is_weekend_order, row.order_date_key, row.order_quarter, row.shipping_date_key) == (0, None, None, 20240106)


def test_totals_group_missing_keys_and_sum_nothing_to_zero(spark):
    rows = [(1, None, None, None, 1, None), (2, None, Decimal("2"), Decimal("1"), 1, None), (3, 7, None, None, None, 9)]
    df = spark.createDataFrame(
        rows, "order_item_id long, order_id long, sales decimal(18,4), order_profit_per_order decimal(18,4), order_item_quantity int, customer_id long"
    ).withColumn("order_date", F.lit(None).cast("timestamp_ntz"))
    totals = {r.order_id: r for r in features.order_totals(df).collect()}
    assert (totals[None].order_total_sales, totals[None].order_item_count) == (Decimal("2"), 2)
    assert (totals[7].order_total_sales, totals[7].order_total_quantity, totals[7].order_profit_margin_pct) == (0, 0, None)
    customers = {r.customer_id: r for r in features.customer_totals(df).collect()}
    assert (customers[None].customer_order_count, customers[9].customer_average_item_sales) == (0, None)


def test_tenure_counts_whole_days(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 23:00:00' a, timestamp_ntz'2024-01-03 22:00:00' b")
    assert df.select(dates.whole_days(F.col("a"), F.col("b")).alias("d")).first().d == 1


def test_untidy_text_is_squeezed_and_the_rest_kept(spark):
    words = ["a b", " a", "a ", "a  b", "a\tb", "a\n", "\x0b", " nan ", "None", "", " ", "a ", "a  ", "a ", None, "3.0", "3."]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    old = F.regexp_replace(F.regexp_replace("w", r"^\s+|\s+$", ""), r"\s+", " ")
    pairs = df.select(text.squeezed(F.col("w")).alias("now"), F.when(~old.isin("", "nan", "None"), old).alias("was")).collect()
    assert [r.now for r in pairs] == [r.was for r in pairs]
    plan = df.select(text.squeezed(F.col("w")))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan
