"""Mergeable sketches against exact figures, and percentiles of floating-point columns against pandas."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from freightlens.operators import ranking
from freightlens.plans import profiling, sketches

SCHEMA = "a int, b double, c smallint, d float, e decimal(12,3), t string, none double, day date"


def rows(n, seed):
    r = random.Random(seed)
    some = lambda v: None if r.random() < 0.1 else v
    return [
        (some(r.randrange(-500, 500)), some(r.choice([r.gauss(0, 1e6), r.gauss(0, 1e-6), 0.0, -0.0, float("nan")])), some(r.randrange(-9, 9)),
         some(float(np.float32(r.random()))), None, some(f"text {r.randrange(n)}"), None, None)
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def data(spark):
    return rows(6000, 1)


def test_merged_batches_equal_one_pass(spark, ws, data):
    store = sketches.SketchStore(spark, ws.path(ws.fresh("sketches")))
    parts = {"one": data[:1000], "two": data[1000:1001], "three": data[1001:], "empty": []}
    for name, part in parts.items():
        store.add(name, spark.createDataFrame(part, SCHEMA).repartition(3))
    store.add("two", spark.createDataFrame(parts["two"], SCHEMA))  # again: replaces its own
    whole = sketches.merged(sketches.column_sketches(spark.createDataFrame(data, SCHEMA).repartition(5)))
    of = lambda df: sorted(df.collect(), key=lambda r: r["column"])
    assert of(sketches.approximate_schema(store.read())) == of(sketches.approximate_schema(whole))
    exact = [c for c in sketches.approximate_numbers(whole).columns if not c.startswith("p")]
    left, right = (of(sketches.approximate_numbers(x).select(*exact)) for x in (store.read(), whole))
    assert [r["column"] for r in left] == [r["column"] for r in right]
    for a, b in zip(left, right):
        assert all(x == y or x == pytest.approx(y, rel=1e-9) for x, y in zip(a, b))
    assert {r["rows"] for r in store.read(["one"]).collect()} == {1000}
    assert not [c for c in store.read().columns if c == "batch"]


def test_estimates_are_within_their_bounds(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    sketch = sketches.merged(sketches.column_sketches(df))
    frame = pd.DataFrame(data, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    for r in sketches.approximate_schema(sketch).collect():
        values = frame[r["column"]].dropna()
        assert (r.non_null, r.null_count) == (len(values), len(frame) - len(values))
        assert abs(r.unique_estimate - values.nunique()) <= values.nunique() * sketches.DISTINCT_ERROR
    numbers = sketches.approximate_numbers(sketch)
    assert {r["column"] for r in numbers.collect()} == {"a", "b", "c", "d", "e", "none"}
    errors = {r["column"]: r.rank_error for r in sketches.rank_errors(df, numbers).collect()}
    assert set(errors) == {"a", "b", "c", "d"} and max(errors.values()) <= sketches.RANK_ERROR
    found = {r["column"]: r for r in numbers.collect()}
    assert found["none"].p50 is None and found["none"]["count"] == 0 and found["b"].missing == int(frame.b.isna().sum())
    assert math.isclose(found["a"].std, frame.a.std(), rel_tol=1e-4) and found["a"].negative_count == int((frame.a < 0).sum())


def test_empty_frame(spark):
    sketch = sketches.merged(sketches.column_sketches(spark.createDataFrame([], SCHEMA)))
    assert {(r.non_null, r.null_count, r.unique_estimate, r.null_pct) for r in sketches.approximate_schema(sketch).collect()} == {(0, 0, 0, 0.0)}
    assert all(r["count"] == 0 and r["mean"] is None for r in sketches.approximate_numbers(sketch).collect())


def test_exact_percentiles_of_every_numeric_kind(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    frame = pd.DataFrame(data, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    scales = profiling.numeric_columns(df)
    assert scales == {"a": 0, "b": None, "c": 0, "d": None, "e": 3, "none": None}
    found = ranking.quantiles(df, scales, profiling.PERCENTILES)
    for c in "abcd":
        assert found[c] == pytest.approx(frame[c].quantile(profiling.PERCENTILES).tolist(), rel=1e-12)
    assert found["none"] == [None] * len(profiling.PERCENTILES)
    report = {r["column"]: r for r in profiling.numeric_report(df).collect()}
    assert report["b"].missing == int(frame.b.isna().sum()) and report["c"]["p50"] == frame.c.median()
    fences = {r["column"]: r for r in profiling.outlier_report(df, ["a", "b", "c"]).collect()}
    q1, q3 = frame.b.quantile(0.25), frame.b.quantile(0.75)
    assert fences["b"].outlier_count == int(((frame.b < q1 - 1.5 * (q3 - q1)) | (frame.b > q3 + 1.5 * (q3 - q1))).sum())


def test_percentiles_of_extreme_values(spark):
    values = [float("-inf"), -1.7e308, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.7e308, float("inf")]
    df = spark.createDataFrame([(v, n) for v, n in zip(values, [-(2**63), -1, 0, 1, 2, 3, 4, 5, 2**63 - 1])], "x double, n long")
    ranks = [i / 8 for i in range(9)]
    found = ranking.quantiles(df, {"x": None, "n": 0}, ranks)
    assert found["x"] == values and found["n"] == [float(v) for v in (-(2**63), -1, 0, 1, 2, 3, 4, 5, 2**63 - 1)]


def test_correlations_of_gaps_and_constants(spark):
    from freightlens.plans import eda

    r = random.Random(5)
    rows_ = []
    for _ in range(4000):
        x = r.gauss(1e9, 1e-1)
        row = [x, x * 2 + r.gauss(0, 0.3), r.random(), 0.1, None, r.gauss(0, 1)]
        rows_.append(tuple(None if i in (1, 2, 5) and r.random() < 0.2 else v for i, v in enumerate(row)))
    names = list("abcdef")
    df = spark.createDataFrame(rows_, ", ".join(f"{c} double" for c in names)).repartition(7)
    frame = pd.DataFrame(rows_, columns=names).astype(float)
    got = {(x.column_a, x.column_b): x.correlation for x in eda.correlations(df, names).collect()}
    assert len(got) == 36
    for (a, b), value in got.items():
        if a in "de" or b in "de":
            assert value is None
        elif a == b:
            assert float(value) == 1.0
        else:
            some = frame[[a, b]].dropna()
            assert float(value) == pytest.approx(np.corrcoef(some[a] - some[a].mean(), some[b] - some[b].mean())[0, 1], abs=1e-5)
    none = eda.correlations(df.where("a < 0"), names).collect()
    assert len(none) == 36 and all(x.correlation is None for x in none)


def test_exact_copies_by_fingerprint(spark):
    from freightlens.operators import rules

    rows_ = [(1, None, "a"), (1, "a", None), (1, None, "a"), (None, None, None), (None, None, None), (2, "x", "y"), (2, "x", "y"), (2, "x", "y"), (3, "", None), (3, None, "")]
    df = spark.createDataFrame(rows_, "k int, v string, `w w` string")
    count = lambda d: d.agg(F.count("*").alias("n")).select(rules.exact_copies(d).alias("c")).first().c
    assert count(df) == 4 and count(df.where("k = 3")) == 0 and count(df.limit(0)) == 0
    wide = spark.range(50).select(*[F.when(F.col("id") % 7 != i % 7, F.col("id") % 25).alias(f"c{i}") for i in range(70)])
    assert count(wide) == 50 - wide.distinct().count()


def test_copies_are_looked_for_by_fingerprints_alone(spark, warehouse, monkeypatch):
    """Without copies the plan has no grouping of the rows; with more groups than are broadcast the count is the same."""
    from freightlens.operators import rules

    plan = lambda d: d.agg(F.count("*").alias("n")).withColumn("c", rules.exact_copies(d))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan(warehouse.clean) and "LeftSemi" not in plan(warehouse.clean)
    twice = warehouse.clean.unionByName(warehouse.clean.limit(3))
    assert "BroadcastHashJoin" in plan(twice)
    monkeypatch.setattr(rules, "BROADCAST_GROUPS", 1)
    assert twice.agg(F.count("*")).select(rules.exact_copies(twice).alias("c")).first().c == 3
