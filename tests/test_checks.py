"""Seeded defects: a sound table passes every check, and one broken row turns exactly its check to FAIL."""

import pytest
from pyspark.sql import functions as F

from freightlens.plans import profiling, quality, star_checks, validation


@pytest.fixture(scope="module")
def sound(warehouse, ws):
    """Ready items without the gaps of the generated tables: shipped after ordering, no empty column."""
    empty = ["customer_city", "customer_state", "customer_zipcode", "order_city", "order_state"]
    df = warehouse.ready.withColumns(
        {"shipping_date": F.expr("order_date + interval 1 day"), **{c: F.lit("Somewhere") for c in empty}}
    )
    return ws.write(df, ws.fresh("sound"))


@pytest.fixture(scope="module")
def victim(sound):
    return sound.agg(F.min("order_item_id")).first()[0]


def spoil(df, victim, **changes):
    hit = F.col("order_item_id") == victim
    return df.withColumns({c: F.when(hit, F.lit(v).cast(dict(df.dtypes)[c])).otherwise(F.col(c)) for c, v in changes.items()})


DQ = {
    "completeness_status": (quality.completeness, {"sales": None}),
    "date_quality_status": (quality.dates, {"shipping_date": "1990-01-01 00:00:00"}),
    "numeric_rule_status": (quality.numeric_rules, {"order_item_quantity": 0}),
    "discount_rate_status": (quality.discount_rates, {"order_item_discount_rate": "1.2"}),
    "geography_status": (quality.coordinates, {"latitude": "91"}),
    "shipping_feature_status": (quality.shipping_features, {"shipping_delay_days": 99}),
    "financial_feature_status": (quality.financial_features, {"profitability_status": "Break Even"}),
    "binary_field_status": (quality.binary_fields, {"is_weekend_order": 2}),
    "categorical_domain_status": (quality.domains, {"delivery_performance": "Lost"}),
}


@pytest.mark.parametrize("status", DQ)
def test_staging_check(status, sound, victim):
    check, defect = DQ[status]
    assert check(sound).first()[status] == "PASS"
    assert check(spoil(sound, victim, **defect)).first()[status] == "FAIL"
    assert check(sound.where("false")).first()[status] == "FAIL"


def test_margin_tolerance(sound, victim):
    margin = sound.where(F.col("order_item_id") == victim).first().profit_margin_pct
    off = spoil(sound, victim, profit_margin_pct=str(float(margin) + 0.03))
    assert quality.financial_features(off).first().financial_feature_status == "PASS"
    assert quality.financial_features(off, margin_tolerance=0.01).first().financial_feature_status == "FAIL"


def test_readiness_ladder(sound, victim):
    n = sound.count()
    label = lambda df, expected, minimum: quality.readiness(df, expected, minimum).first().final_data_readiness
    assert label(sound, n, n) == "READY"
    assert label(sound, n + 1, n) == "READY WITH WARNINGS"
    assert label(sound, n + 1, n + 1) == "NOT READY"
    assert label(spoil(sound, victim, sales=None), n, n) == "NOT READY"
    assert label(spoil(sound, victim, shipping_date="1990-01-01 00:00:00"), n, n) == "READY WITH WARNINGS"
    assert label(sound.where("false"), 0, 0) == "NOT READY"


def test_load_check_and_volume(sound):
    n = sound.count()
    assert quality.load_check(sound, n).first().staging_status == "READY"
    assert quality.load_check(sound, n + 1).first().load_status == "WARNING"
    assert quality.load_check(sound.where("false"), n).first().load_status == "FAILED"
    twice = sound.unionByName(sound.limit(1))
    assert quality.volume_and_uniqueness(sound, n).first().volume_and_uniqueness_status == "PASS"
    assert quality.volume_and_uniqueness(twice, n + 1).first().volume_and_uniqueness_status == "FAIL"


VAL = {
    "val_completeness": ({"sales": None}, {"sales has no missing values"}),
    "val_dates": ({"order_date": "1999-12-31 00:00:00", "shipping_date": "1999-12-01 00:00:00"}, {"Shipping date is not earlier than order date"}),
    "val_numeric_ranges": ({"order_item_quantity": 0}, {"Order-item quantity is greater than zero"}),
    "val_delivery_rules": ({"is_late_delivery": None}, {"is_late_delivery matches shipping delay", "is_late_delivery is binary"}),
    "val_financial_rules": ({"gross_sales_before_discount": "1"}, {"Gross sales equals sales plus discount"}),
    "val_aggregate_features": ({"order_total_sales": "1"}, {"order_total_sales is consistent within each order"}),
    "val_domains": ({"operational_risk_segment": "it's odd"}, {"operational_risk_segment contains only approved values"}),
    "val_text_limits": ({"product_name": "a\0b"}, {"Text columns contain no null characters"}),
}


def failing(df, group):
    rows = validation.report(df, validation.CHECKS[group](df)).where("status = 'FAIL'").collect()
    return {r.check_name: r for r in rows}


@pytest.mark.parametrize("group", VAL)
def test_validation_check(group, sound, victim):
    defect, names = VAL[group]
    assert set(failing(spoil(sound, victim, **defect), group)) - set(failing(sound, group)) == names


def test_validation_of_unexpected_values(sound, victim):
    found = failing(spoil(sound, victim, operational_risk_segment="odd"), "val_domains")
    row = found["operational_risk_segment contains only approved values"]
    assert (row.observed, row.affected_rows) == ("1", 1)
    listed = validation.unexpected_values(spoil(sound, victim, operational_risk_segment="odd")).collect()
    assert [tuple(r) for r in listed] == [("operational_risk_segment", "odd", 1)]


def test_validation_of_columns(spark, sound):
    named = sound.withColumn("Customer_email", F.lit("x")).withColumn("customer_street", F.lit("y")).drop("sales")
    assert set(failing(named, "val_required_columns")) == {"Required columns are available"}
    assert failing(named, "val_privacy")["Direct customer PII has been removed"].observed == "['customer_street']"
    rows = validation.report(named, validation.dataset_checks(named, 1)).where("status = 'FAIL'").collect()
    assert [r.check_name for r in rows] == ["Column names use snake_case"]


def test_validation_of_keys(sound):
    found = failing(sound.unionByName(sound.orderBy("order_item_id").limit(1)), "val_uniqueness")
    assert {n: r.affected_rows for n, r in found.items()} == {"No exact duplicate rows": 1, "order_item_id is unique": 2}


def test_order_totals_of_rows_without_order_never_match(sound, victim):
    found = failing(spoil(sound, victim, order_id=None), "val_aggregate_features")
    assert "order_item_count is consistent within each order" in found


def test_readiness_decisions(spark, sound):
    layout = "status string, severity string, weight int, weighted_pass int"
    good = ("PASS", "High", 4, 4)

    def decide(*rows):
        report = spark.createDataFrame(list(rows), layout)
        return {r.metric: r.value for r in validation.readiness(sound, report).collect()}

    assert decide(*[good] * 10)["decision"] == "GO"
    assert decide(*[good] * 30, ("FAIL", "Low", 2, 0))["readiness_status"] == "READY"
    assert decide(*[good] * 30, ("FAIL", "High", 4, 0))["decision"] == "CONDITIONAL GO"
    assert decide(*[good] * 3, ("FAIL", "High", 4, 0))["decision"] == "HOLD"
    assert decide(*[good] * 99, ("FAIL", "Critical", 5, 0))["decision"] == "NO-GO"


def test_clean_rules_count_missing_rates(sound, victim):
    broken = spoil(sound, victim, order_item_discount_rate=None, late_delivery_risk=None, sales=None)
    found = {r.rule: r.failed_rows for r in profiling.clean_rules(broken).where("status = 'REVIEW'").collect()}
    assert found == {"discount rate between 0 and 1": 1, "late_delivery_risk in {0,1}": 1}


def test_fact_status(warehouse):
    fact, n = warehouse.fact, warehouse.expected
    assert star_checks.load_status(fact, n).first().final_fact_readiness == "FACT LOAD COMPLETE"
    lost = spoil(fact, fact.agg(F.min("order_item_id")).first()[0], customer_key=0)
    status = star_checks.load_status(lost, n).first()
    assert (status.etl_status, status.rows_with_unknown_dimension_key) == ("WARNING", 1)
    assert star_checks.unknown_keys(lost).first().dimension_key_status == "REVIEW"
    assert star_checks.load_status(fact.where("false"), n).first().etl_status == "FAILED"
    assert star_checks.empty_before_load(fact.where("false")).first().fact_table_status == "READY FOR FACT LOAD"
    assert star_checks.empty_before_load(fact).first().fact_table_status == "REVIEW EXISTING FACT DATA"
    assert star_checks.reconcile(warehouse.batch, fact.where("order_item_id > 100")).first().reconciliation_status == "FAIL"
    star_checks.require_resolved(warehouse.batch, warehouse.dims)


def test_full_report_skips_absent_columns(warehouse):
    from freightlens.plans.validation import full_report

    whole = {r.check_name for r in full_report(warehouse.ready, 1).collect()}
    rows = full_report(warehouse.ready.drop("order_date", "sales", "latitude", "market"), 1).collect()
    names = {r.check_name for r in rows}
    assert names < whole
    assert next(r for r in rows if r.check_name == "Required columns are available").status == "FAIL"


@pytest.mark.parametrize("columns", [["sales", "latitude", "market"], ["sales"], ["market"], ["order_id"], ["order_date"]])
def test_checks_of_any_frame(spark, sound, columns):
    """Every check and report runs on a frame that lacks what it would look at, and leaves out what does not apply."""
    few = sound.select(*columns)
    for name, make in validation.CHECKS.items():
        rows = validation.report(few, make(few)).collect()
        assert all(r.status in ("PASS", "FAIL") for r in rows)
        assert bool(rows) or name in ("val_dates", "val_delivery_rules", "val_financial_rules", "val_aggregate_features", "val_domains", "val_numeric_ranges")
    report = validation.full_report(few, 1)
    names = [r.check_name for r in report.collect()]
    assert "No exact duplicate rows" in names and "order_item_id is unique" not in names
    assert validation.issue_samples(few, report).count() == report.where("status = 'FAIL'").count()
    assert validation.unexpected_values(few).count() == 0
    assert profiling.clean_rules(few).count() == (1 if columns[0] == "sales" else 0)
    score = profiling.clean_score(few).first()
    assert score.validity == 100.0


def test_raw_rules_of_any_frame(spark):
    for schema, rules in (("x int", 0), ("`Sales` double, x int", 1), ("`Order Item Id` long", 2), ("`Delivery Status` string", 0)):
        df = spark.createDataFrame([], schema)
        assert profiling.business_rules(df).count() == rules
        assert profiling.quality_score(df).count() == 4


def test_totals_that_are_there_are_checked(sound):
    few = sound.select("order_id", "sales", "order_total_sales")
    rows = validation.report(few, validation.aggregate_checks(few)).collect()
    assert [(r.check_name, r.status) for r in rows] == [("order_total_sales is consistent within each order", "PASS")]


def test_domain_report_lists_every_unexpected_value(sound):
    ids = [r[0] for r in sound.select("order_item_id").orderBy("order_item_id").limit(3).collect()]
    labels = F.when(F.col("order_item_id") == ids[0], "odd").when(F.col("order_item_id").isin(ids[1:]), "it's odd")
    spoilt = sound.withColumn("operational_risk_segment", F.coalesce(labels, "operational_risk_segment"))
    rows = {r.check_name: r for r in validation.report(spoilt, validation.domain_checks(spoilt, listed=True)).collect()}
    row = rows["operational_risk_segment contains only approved values"]
    assert (row.status, row.observed, row.affected_rows) == ("FAIL", "['it's odd', 'odd']", 3)
    assert rows["profitability_status contains only approved values"].observed == "[]"
