"""Ranking, joins, deduplication, upsert and rules against brute force on small data, large-data paths included."""

import random
from datetime import datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from freightlens.functions import text
from freightlens.operators import cleaning, distinct, joins, ranking, rules
from freightlens.plans import dims, facts, staging


def frame(spark, n=500, seed=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice("abc"), rnd.randint(0, 40)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, grp string, v long").repartition(5)


def test_dense_index(spark, ws):
    rows, df = frame(spark)
    got = {r["id"]: r["p"] for r in ranking.dense_index(ws, df, [F.desc("v"), F.asc("id")], "p").collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}


@pytest.mark.parametrize("partition", [(), ("grp",)])
def test_row_number(spark, ws, partition):
    rows, df = frame(spark)
    order = [F.desc("v"), F.asc("id")]
    got = {r["id"]: r["n"] for r in ranking.row_number(ws, df, order, "n", partition).collect()}
    want = df.withColumn("n", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    assert got == {r["id"]: r["n"] for r in want.collect()} and len(got) == len(rows)


@pytest.mark.parametrize("dense", [False, True])
def test_rank(spark, ws, dense):
    """Ties, a value that a third of the rows share, and missing values, which come last."""
    rows, df = frame(spark)
    df = df.withColumn("v", F.when(F.col("id") % 3 == 0, 17).when(F.col("id") % 50 != 1, F.col("v")))
    got = {r["id"]: r["n"] for r in ranking.rank(ws, df, "v", "n", dense).collect()}
    want = df.withColumn("n", (F.dense_rank() if dense else F.rank()).over(Window.orderBy(F.desc("v"))))
    assert got == {r["id"]: r["n"] for r in want.collect()} and len(got) == len(rows)


def test_rank_of_nothing(spark, ws):
    assert ranking.rank(ws, spark.createDataFrame([], "id long, v long"), "v", "n").count() == 0


def test_ranks_put_no_rows_into_one_task(spark, ws):
    """Windows run per range partition, never over everything."""
    _, df = frame(spark)
    for made in (ranking.rank(ws, df, "v", "n"), ranking.row_number(ws, df, [F.asc("id")], "n"), ranking.ntile(ws, df, 4, [F.asc("id")], "n")):
        assert "SinglePartition" not in made._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [2, 4, 10, 13])
def test_ntile(spark, ws, n):
    _, df = frame(spark, n)
    order = [F.desc("v"), F.asc("id")]
    got = {r["id"]: r["n"] for r in ranking.ntile(ws, df, 4, order, "n").collect()}
    assert got == {r["id"]: r["n"] for r in df.withColumn("n", F.ntile(4).over(Window.orderBy(*order))).collect()}


def test_distinct_counts_by_bitmaps(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([1, 2, 3]), rnd.choice([None, *range(-200, 200), 2**40 + 1]), rnd.randrange(70)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, x long, y int").repartition(4)
    names = spark.createDataFrame([(1, "p"), (2, "p"), (3, None)], "id long, label string")
    attach = lambda part: part.join(names, part["k"] == names["id"]).drop("id")
    want = {r.g: (r.a, r.b) for r in df.groupBy("g").agg(F.count_distinct("x").alias("a"), F.count_distinct("y").alias("b")).collect()}
    groups = df.groupBy("g").agg(F.count("*").alias("n"))
    got = distinct.with_distinct_counts(groups, df, ["g"], {"a": "x", "b": "y"})
    assert {r.g: (r.a, r.b) for r in got.collect()} == want and "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    labelled = attach(df)
    want = {r.label: r.a for r in labelled.groupBy("label").agg(F.count_distinct("x").alias("a")).collect()}
    groups = labelled.groupBy("label").agg(F.count("*").alias("n"))
    got = distinct.with_distinct_counts(groups, df, ["label"], {"a": "x"}, by=["k"], attach=attach)
    assert {r.label: r.a for r in got.collect()} == want
    none = df.withColumn("x", F.lit(None).cast("long"))
    assert {r.a for r in distinct.with_distinct_counts(groups, attach(none), ["label"], {"a": "x"}).collect()} == {0}


@pytest.mark.parametrize("buckets", [3, 2**18])
def test_order_statistics(spark, monkeypatch, buckets):
    monkeypatch.setattr(ranking, "BUCKETS", buckets)
    rnd = random.Random(1)
    values = [rnd.randint(-10**6, 10**6) for _ in range(200)] + [77] * 100 + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "x long")
    found, sizes = ranking.order_statistics(df, {"x": lambda n: [1, 2, 150, 151, n]})
    ordered = sorted(v for v in values if v is not None)
    assert sizes == {"x": 300}
    for r in (1, 2, 150, 151, 300):
        assert found[("x", r)] == (ordered[r - 1], r - ordered.index(ordered[r - 1]))


def test_quantiles_interpolate_as_pandas_does(spark):
    values = [Decimal(v) / 100 for v in (1, 5, 5, 700, 1234, 99, -3)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x decimal(18,2)")
    df = df.withColumn("empty", F.lit(None).cast("int"))
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = ranking.quantiles(df, {"x": 2, "empty": 0}, probabilities)
    assert got["x"] == pytest.approx(pd.Series([float(v) for v in values]).quantile(probabilities).tolist())
    assert got["empty"] == [None] * 6


@pytest.mark.parametrize("n", [3, 7, 10, 11, 13])
def test_sales_tiers_as_qcut_of_first_ranks(spark, n):
    rnd = random.Random(n)
    sales = [Decimal(rnd.choice([1, 2, 3, 4, 5, 6])) for _ in range(n)]
    rows = [(i, s) for i, s in enumerate(sales)] + [(n, None)]
    df = spark.createDataFrame(rows, "order_item_id long, sales decimal(18,4)")
    from freightlens.functions.features import SALES_TIERS, add_sales_tier

    got = [r.sales_value_tier for r in add_sales_tier(df, staging.sales_tier_cuts(df)).orderBy("order_item_id").collect()]
    if len(set(sales)) < 4:
        assert got == [None] * (n + 1)
    else:
        ranks = pd.Series([float(s) for s in sales]).rank(method="first")
        assert got == pd.qcut(ranks, 4, labels=SALES_TIERS).astype(str).tolist() + [None]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False, None])
def test_lookup_join(spark, how, small):
    """Broadcast, and shuffled: a third of the rows share one key."""
    rows = [(i, 1 if i % 3 == 0 else (None if i % 7 == 0 else i % 20)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k long")
    lookup = spark.createDataFrame([(k, f"name{k}") for k in [None, *range(15)]], "key long, name string")
    for null_safe in (False, True):
        got = joins.lookup_join(df, lookup, [("k", "key")], ["name"], null_safe=null_safe, how=how, small=small)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (small is not False) and ("SortMergeJoin" in plan) == (small is False)
        assert got.columns == ["id", "k", "name"]
        known = lambda k: (k is None and null_safe) or (k is not None and k < 15)
        want = {(i, k, f"name{k}" if known(k) else None) for i, k in rows if known(k) or how == "left"}
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_bytes_decide_on_a_broadcast(spark):
    lookup = spark.createDataFrame([(k, "x" * 1000) for k in range(100)], "key long, name string")
    assert joins.small_enough(lookup) and not joins.small_enough(lookup, 100_000)
    assert joins.small_enough(lookup.select("key"), 10_000) and joins.small_enough(lookup.limit(0), 0)


def test_no_lookup_reads_the_rows_to_count_them(spark, warehouse, monkeypatch):
    """The plan of the fact load has no grouping of rows below its joins, broadcast or not."""
    monkeypatch.setattr(joins, "small_enough", lambda lookup: False)
    plan = facts.resolve_keys(warehouse.batch, warehouse.dims)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 7 and "Aggregate [_probe" not in plan and "_hot" not in plan


def test_keep_fullest_row(spark):
    rows = [(1, None, "a"), (1, "x", "b"), (1, "x", "a"), (2, None, None), (None, "n", None), (None, "n", "m")]
    df = spark.createDataFrame(rows, "order_item_id long, p string, q string")
    assert {tuple(r) for r in cleaning.keep_fullest_row(df).collect()} == {(1, "x", "a"), (2, None, None), (None, "n", "m")}


def test_keep_fullest_row_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "order_item_id long, p string")
    plan = cleaning.keep_fullest_row(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")  # printed root first: a limit below the exchange


def test_audit_log_holds_the_counts_of_the_load(spark, ws):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")]
    df = spark.createDataFrame([(*r, None) for r in rows], "order_item_id long, product_name string, order_region string")
    clean, counted = cleaning.clean_and_count(ws, df, ws.fresh("clean"))
    assert clean.count() == 2 and counted == {"read": 6, "keyless": 2, "kept": 2}
    log = {r.step: r for r in cleaning.audit_log(counted, df, 10).collect()}
    assert [r.rows_after for r in sorted(log.values(), key=lambda r: r.step_no)] == [6, 6, 6, 6, 6, 5, 3, 3, 2, 2, 2]
    assert log["remove_exact_duplicates"].note == "1 exact copies" and log["remove_missing_primary_key"].note == "2 rows had no key"
    assert (log["drop_all_missing_columns"].columns_after, log["drop_all_missing_columns"].note) == (2, "without order_region")


def test_cleaning_assertions(spark):
    from freightlens.plans import profiling

    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")]
    df = spark.createDataFrame(rows, "order_item_id long, p string")
    for bad in (df.where("false"), df, df.where("order_item_id is not null")):
        with pytest.raises(ValueError):
            profiling.require_clean(bad)
    profiling.require_clean(df.where("p in ('a', 'c')").distinct())


def test_rename_rejects_collisions(spark):
    with pytest.raises(ValueError):
        cleaning.rename_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int"))


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    assert cleaning.drop_empty_columns(df).columns == ["a", "c"]


def test_repeated_rows_and_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, None), (None, None)], "k int, v string")
    got = df.agg(F.count("*").alias("n")).select(rules.repeated_key_rows(df, "k").alias("r"), rules.exact_copies(df).alias("c")).first()
    assert (got.r, got.c) == (5, 2)


# ---- dimensions in two loads ---------------------------------------------------------------------


def test_upsert_keeps_keys(spark, ws):
    dim = dims.DIMENSIONS["dim_category"]
    layout = "category_id int, category_name string, department_id int, department_name string"
    first = spark.createDataFrame([(30, "c", 1, "x"), (10, "a", 1, "x")], layout)
    second = spark.createDataFrame([(10, "A", None, "y"), (5, "n", 2, "z"), (20, "m", 2, "z")], layout)
    one, two = datetime(2024, 1, 1), datetime(2024, 2, 1)
    base = ws.write(dims.upsert(ws, dim, dims.unknown_member(ws, dim, one), first, one), ws.fresh("d"))
    again = ws.write(dims.upsert(ws, dim, base, first, two), ws.fresh("d"))
    grown = dims.upsert(ws, dim, again, second, two)
    key = lambda df: {r.category_id: r.category_key for r in df.collect()}
    assert key(base) == key(again) == {None: 0, 10: 1, 30: 2}
    assert key(grown) == {None: 0, 10: 1, 30: 2, 5: 3, 20: 4}
    rows = {r.category_id: r for r in grown.collect()}
    assert (rows[10].category_name, rows[10].department_id, rows[30].category_name) == ("A", None, "c")
    assert rows[None].record_source == "System" and rows[5].record_source == "DataCo"
    assert rows[10].created_at == one and rows[10].updated_at == two and rows[5].created_at == two


def test_dates_are_only_inserted(spark, ws, at):
    dim = dims.DIMENSIONS["dim_date"]
    stamps = "order_date timestamp_ntz, shipping_date timestamp_ntz, customer_first_order_date timestamp_ntz, customer_last_order_date timestamp_ntz"
    day = datetime(2024, 1, 1, 10)
    rows = spark.createDataFrame([(day, datetime(2024, 1, 6), None, None), (day, None, None, None)], stamps)
    members = dims.date_members(rows)
    first = ws.write(dims.upsert(ws, dim, dims.unknown_member(ws, dim, at), members, at), ws.fresh("d"))
    got = {r.date_key: r for r in dims.upsert(ws, dim, first, members, datetime(2025, 1, 1)).collect()}
    assert sorted(got) == [0, 20240101, 20240106]
    assert (got[20240101].week_of_year, got[20240101].day_of_week, got[20240106].is_weekend, got[20240106].day_name) == (1, 1, 1, "Saturday")
    assert got[20240101].updated_at == at


def test_geography_keeps_zeros_and_unknowns(spark):
    rows = spark.sql(
        "select ' EU ' market, 'W' order_region, 'F' order_country, cast(null as string) order_state, 'P' order_city,"
        " cast(1.5 as decimal(10,7)) latitude, cast(null as decimal(10,7)) longitude"
    )
    import hashlib

    got = dims.geography_members(rows).first()
    assert got.geography_natural_key == hashlib.sha256(b"EU|W|F|Unknown|P|1.500000|Unknown").hexdigest()
    assert got.order_state == "Unknown" and got.longitude is None


def test_service_levels(spark):
    modes = ["Same Day", "FIRST class", "Second Class", "standard", "Drone"]
    df = spark.createDataFrame([(m,) for m in modes], "m string")
    got = [r[0] for r in df.select(dims.service_level(F.col("m"))).collect()]
    assert got == ["Same Day", "Expedited", "Standard Plus", "Standard", "Other"]


def test_rows_are_numbered_without_gaps(spark, ws, warehouse):
    ids = [r.staging_row_id for r in warehouse.staging.select("staging_row_id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_lookup_join_is_left_out_of_plans_that_do_not_use_it(spark):
    lookup = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    rows = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k long, n long")
    for null_safe, found in ((False, {10: "a", 20: None, 30: None}), (True, {10: "a", 20: None, 30: "n"})):
        for small in (True, False):
            joined = joins.lookup_join(rows, lookup, [("k", "k")], ["v"], null_safe=null_safe, small=small)
            assert {r.n: r.v for r in joined.collect()} == found
            assert "Join" not in joined.agg(F.sum("n"))._jdf.queryExecution().optimizedPlan().toString()


def test_copies_of_a_key_under_several_orders_are_cleaned_by_key(spark, ws):
    rows = [(1, 7, "a", None), (1, 8, "a", "x"), (1, None, "b", "x"), (2, 7, "c", None), (2, 7, "b", None), (None, 7, "d", None)]
    df = spark.createDataFrame(rows, "order_item_id long, order_id long, product_name string, market string")
    for some in (df, df.where("order_item_id = 2")):
        clean, counted = cleaning.clean_and_count(ws, some, ws.fresh("clean"))
        want = cleaning.clean_items(some)
        assert sorted(map(tuple, clean.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert counted["kept"] == want.count() and counted["read"] == some.count()


def test_fact_queries_do_not_shuffle_or_write_wide_rows(warehouse):
    """A query of one key and one measure joins nothing for the other columns; staging and fact are not stored for it."""
    plan = warehouse.fact.groupBy("category_key").agg(F.sum("sales"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "order_total_sales" not in plan and "customer_first_order_date" not in plan.split("Join LeftOuter")[1].split("Relation")[0]
    read = {f.rsplit("/", 2)[-2] for f in warehouse.fact.inputFiles()}
    assert not any(name.startswith("fact_order_item") for name in read)


def test_title_case_of_plain_and_other_words(spark):
    words = ["new  york", "O'NEILL", " sAN-josé", "", "a1b", "ÉVRY sud", None, "x\ty"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    slow = lambda w: "".join(c.upper() if not (i and w[i - 1].isalpha()) else c.lower() for i, c in enumerate(w))
    assert [r[0] for r in df.select(text.title_case(F.col("w"))).collect()] == [None if w is None else slow(w) for w in words]
