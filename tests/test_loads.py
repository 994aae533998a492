"""Loads into tables that last: partitions, versions, gates and the log."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from freightlens.plans import dims, loads, views
from freightlens.sources.stores import BatchTable, VersionedTables

ONE, TWO, THREE = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
LAYOUT = {"id": "bigint", "batch": "string", "month": "int"}


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, ws):
    return BatchTable(spark, ws.path(ws.fresh("table")), LAYOUT, "batch", "month")


def rows_of(spark, *months):
    return spark.createDataFrame([(i, m) for i, m in enumerate(months)], "id long, month int")


def test_a_batch_replaces_its_own_partitions(spark, table):
    assert table.read().count() == 0 and table.partitions("a") == []
    assert table.replace("a", rows_of(spark, 1, 1, 2, None)) == 4
    first = files(table.path)
    assert table.replace("b", rows_of(spark, 1, 3)) == 2
    assert {f: t for f, t in files(table.path).items() if f in first} == first  # a's files as they were
    assert table.replace("a", rows_of(spark, 2, 2, 5)) == 3  # 1 and the rows without a month are gone
    assert sorted(table.partitions("a")) == [2, 5] and sorted(table.partitions("b")) == [1, 3]
    assert sorted((r.batch, r.month) for r in table.read().collect()) == [("a", 2), ("a", 2), ("a", 5), ("b", 1), ("b", 3)]
    assert table.replace("a", rows_of(spark)) == 0 and table.partitions("a") == []


def test_numbered_rows_of_a_batch(spark, ws):
    table = BatchTable(spark, ws.path(ws.fresh("table")), {**LAYOUT, "nr": "bigint"}, "batch", "month")
    table.replace("a", rows_of(spark, *[m % 7 for m in range(500)]).repartition(5), numbered="nr")
    assert table.read().select("nr").distinct().count() == 500


def test_batch_and_month_are_partition_filters(spark, table):
    table.replace("a", rows_of(spark, 1, 2, 3))
    table.replace("b", rows_of(spark, 1, 2, 3))
    some = table.of_batch("b").where("month between 2 and 3")
    scan = some._jdf.queryExecution().executedPlan().toString()
    wanted = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert "batch" in wanted and "month" in wanted and "PushedFilters: []" in scan
    assert len(some.inputFiles()) >= 2 and some.select(F.input_file_name().alias("f")).distinct().count() == 2


def test_versions_switch_together(spark, ws):
    store = VersionedTables(spark, ws.path(ws.fresh("store")))
    assert store.version() == 0 and store.tables() == {}
    one = {"x": lambda: spark.range(3), "y": lambda: spark.range(4)}
    assert store.publish(one, ONE) == 1

    def dies():
        raise RuntimeError("lost")

    def refuse(tables):
        assert tables["x"].count() == 5
        raise ValueError("not good")

    with pytest.raises(RuntimeError):
        store.publish({"x": lambda: spark.range(5), "y": dies}, TWO)
    with pytest.raises(ValueError):
        store.publish({"x": lambda: spark.range(5), "y": lambda: spark.range(6)}, TWO, refuse)
    again = VersionedTables(spark, store.path)  # as another session would
    assert again.version() == 1 and {n: t.count() for n, t in again.tables().items()} == {"x": 3, "y": 4}
    assert again.publish({"x": lambda: again.tables()["x"].union(spark.range(1)), "y": lambda: spark.range(1)}, TWO) == 2
    assert {n: t.count() for n, t in store.tables().items()} == {"x": 4, "y": 1} and store.tables(1)["x"].count() == 3
    store.publish(one, THREE)
    store.expire(keep=1)
    assert store.tables()["y"].count() == 4
    with pytest.raises(Exception):
        store.tables(1)["x"].count()


@pytest.fixture(scope="module")
def loaded(spark, ws, warehouse):
    """Two batches in one target: early orders, then all of them."""
    target = loads.Target(spark, ws.path(ws.fresh("target")))
    early = warehouse.items.where("order_date < timestamp_ntz'1996-01-01'")
    loads.run_load(target, early, "early", ONE)
    before = {n: {r[0]: r[1] for r in t.select(dims.DIMENSIONS[n].natural, dims.DIMENSIONS[n].key).collect()} for n, t in target.dimensions.tables().items()}
    kept = files(f"{target.path}/fact_order_item") | files(f"{target.path}/staging")
    loads.run_load(loads.Target(spark, target.path), warehouse.items, "all", TWO)
    return target, before, kept


def test_second_load_keeps_keys_and_files(loaded):
    target, before, kept = loaded
    after = target.dimensions.tables()
    for name, keys in before.items():
        d = dims.DIMENSIONS[name]
        now = {r[0]: r[1] for r in after[name].select(d.natural, d.key).collect()}
        assert keys.items() <= now.items() and len(set(now.values())) == len(now)
    files_now = files(f"{target.path}/fact_order_item") | files(f"{target.path}/staging")
    assert {f: t for f, t in files_now.items() if f in kept} == kept and len(files_now) > len(kept)
    assert {r.process_status for r in target.log.runs().collect()} == {"SUCCESS"}


def test_stored_warehouse_answers_like_one_load(loaded, warehouse):
    target, _, _ = loaded
    w = loads.open_warehouse(target)
    assert w.expected == warehouse.expected
    same = [c for c in warehouse.fact.columns if c not in ("staging_row_id", "loaded_at", "load_batch_id", "source_file_name", "customer_key", "product_key", "geography_key")]
    assert w.fact.select(*same).exceptAll(warehouse.fact.select(*same)).isEmpty()
    of = lambda x, view: sorted(map(str, view(x).collect()))
    for view in (views.executive_overview, views.monthly_sales_trend, views.market_performance):
        assert of(w, view) == of(warehouse, view)
    early = loads.open_warehouse(target, "DATACO_20240101_000000_000000", version=1)
    assert 0 < early.fact.count() < w.fact.count()


def test_a_loaded_batch_is_not_loaded_twice(spark, loaded, warehouse):
    target, _, _ = loaded
    rows = target.fact.read().count()
    with pytest.raises(loads.LoadStopped):
        loads.run_load(target, warehouse.items, "all", TWO)
    last = {r.process_name: r for r in target.log.runs().orderBy("started_at").collect()}["load_fact_order_item"]
    assert last.process_status == "FAILED" and "already holds" in last.error_message and target.fact.read().count() == rows
    loads.run_load(target, warehouse.items, "all", TWO, replace=True)
    assert target.fact.read().count() == rows


def test_defective_batches_stop(spark, ws, warehouse):
    target = loads.Target(spark, ws.path(ws.fresh("target")))
    with pytest.raises(ValueError):
        loads.run_load(target, warehouse.items.where("false"), "none", ONE)
    with pytest.raises(loads.LoadStopped):
        loads.run_load(target, warehouse.items.limit(50), "few", TWO, minimum_rows=1000, expected_rows=1000)
    log = sorted((r.source_file_name, r.process_name, r.process_status) for r in target.log.runs().collect())
    assert log == [
        ("few", "clean_order_items", "SUCCESS"), ("few", "load_staging_csv", "FAILED"), ("none", "clean_order_items", "FAILED"),
    ]
    assert target.dimensions.version() == 0 and target.fact.read().count() == 0 and target.latest_batch() is None
