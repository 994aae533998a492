"""Steps that must not grow faster than their input."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freightlens.operators import joins, rules
from freightlens.plans import dims, facts, profiling, quality, staging, validation, views
from freightlens.schemas import STAGING_FIELDS
from freightlens.session import setting
from freightlens.sources import stores


def test_tasks_get_few_wide_items(spark, warehouse):
    """F31, F32: with the default sizes the rows that a task sorts grew with the table until they spilled."""
    warehouse.clean
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1000


def test_copies_are_looked_for_among_repeated_keys_only(spark, monkeypatch):
    """F29"""
    r = random.Random(3)
    rows = [(r.choice([None, 1, 2, 3, 4]), r.choice([None, "a", "b"])) for _ in range(40)] + [(k, "c") for k in range(10, 30)]
    df = spark.createDataFrame(rows, "`k.e` long, p string")
    count = lambda d: d.agg(F.count("*")).select(rules.exact_copies(d, "k.e").alias("c")).first().c
    assert count(df) == len(rows) - len(set(rows))
    monkeypatch.setattr(rules, "BROADCAST_GROUPS", 1)
    assert count(df) == len(rows) - len(set(rows))
    monkeypatch.setattr(rules, "fingerprints", lambda d: pytest.fail("all columns are read"))
    assert count(df.where("`k.e` >= 10")) == 0 and count(df.limit(0)) == 0


def test_totals_are_looked_at_apart(spark, warehouse):
    """F33"""
    groups = validation._by_join(warehouse.ready.columns)
    assert sorted(c for g in groups for c in g) == sorted(warehouse.ready.columns) and validation._by_join([]) == []
    for some in groups:
        joins = warehouse.ready.select(*some).agg(*[F.count(c) for c in some])._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
        assert joins <= 1
    checks = validation.completeness_checks(warehouse.ready)
    assert not checks[-1].aggregate
    odd = spark.createDataFrame([(1, None, None), (2, None, "a")], "order_item_id long, order_total_sales int, market string")
    assert validation.report(odd, validation.completeness_checks(odd)).collect()[-1].observed == "['order_total_sales']"


def test_profiles_expand_no_cells(spark, ws):
    """F30, F34"""
    rows = [(1, -0.0, "a", Decimal("1.50"), None), (1, 0.0, None, None, None), (None, float("nan"), "", Decimal("1.50"), None)]
    df = spark.createDataFrame(rows, "`k.e` int, d double, s string, m decimal(8,2), e string")
    got = {r.column: tuple(r)[1:] for r in profiling.schema_report(df).collect()}
    assert got["k.e"] == (2, 1, 33.33, 1, "1", "int") and got["d"] == (3, 0, 0.0, 3, "-0.0", "double") and got["s"] == (2, 1, 33.33, 2, "", "string")
    assert got["m"] == (2, 1, 33.33, 1, "1.50", "decimal(8,2)") and got["e"] == (0, 3, 100.0, 0, None, "string")
    assert not profiling.schema_report(df.limit(0)).count()
    plan = profiling.schema_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert sorted(validation.quality_profile(df).collect()) == sorted(validation.quality_profile(df, ws).collect())


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_checks_of_a_batch_write_no_staging(warehouse):
    """F8 to F12: the whole wide staging was written for checks that read a few columns of it."""
    assert _joins(quality.numeric_rules(warehouse.latest)) == _joins(quality.load_check(warehouse.latest, 1)) == 0
    assert "/staging/" not in "".join(warehouse.latest.inputFiles())
    assert warehouse.latest.columns == [c for c in STAGING_FIELDS if c != "staging_row_id"]


def test_customers_of_a_batch_are_found_in_their_own_columns(warehouse):
    """all columns of every staged item were written for them."""
    members = lambda rows: sorted(map(str, dims.customer_members(rows).collect()))
    early = warehouse.latest.where("order_year < 1996")
    assert members(warehouse.customer_rows(early)) == members(early) != members(warehouse.latest)


def test_wide_rows_of_a_load_move_once(spark, ws, warehouse, monkeypatch, tmp_path):
    """F3, F4, F14 to F16: they were shuffled for the order totals, the customers, the products and twice for the month."""
    monkeypatch.setattr(joins, "PART_ROWS", 20)
    rows = [(i, 10 * i, [None, "a", "b"][min(i % 7, 2)], None if i % 5 else i) for i in range(300)]
    stored = ws.write(spark.createDataFrame(rows, "k long, v long, m string, w long"), ws.fresh("rows"))
    table = stores.BatchTable(spark, str(tmp_path / "t"), {"k": "long", "v": "long", "w": "long", "b": "string", "m": "string"}, "b", "m")
    joined = joins.join_by_group(stored.select("k", "v", "m"), stored.select("k", "m", "w"), "k", "m")
    assert table.replace("one", joined, dealt=True) == 300
    assert sorted((r.k, r.v, r.m, r.w) for r in table.read().collect()) == sorted(rows, key=lambda r: r[0])
    with setting(spark, *joins.BY_GROUP):
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_part#") == 1 and "Exchange hashpartitioning(_part#" in plan and ", k#" not in plan.split("Exchange hashpartitioning(_part#")[1].split(")")[0]

    def same(a, b):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))

    same(
        staging.with_totals_by_month(warehouse.slotted, warehouse.customer_totals).drop("order_year_month"),
        staging.with_totals(warehouse.clean, warehouse.customer_totals),
    )
    same(facts.fact_by_month(warehouse.staging, warehouse.dims, warehouse.loaded_at), warehouse.fact)


def test_detail_view_moves_its_measures_once(warehouse, monkeypatch):
    """all columns were shuffled for the keys of customers and products and again for their attributes."""
    direct = views.order_item_detail(warehouse)
    monkeypatch.setattr(type(warehouse), "fits", lambda *_: False)
    apart = views.order_item_detail(warehouse)
    assert apart.columns == direct.columns and sorted(map(str, apart.collect())) == sorted(map(str, direct.collect()))
    joins_of = [p.split("\n")[0] for p in apart._jdf.queryExecution().optimizedPlan().toString().split("Join ")[1:]]
    assert sum("staging_row_id" in p and "_row" in p for p in joins_of) == 1
