"""Approximate profile from mergeable sketches: one small row per column and batch, merged without another scan of the data.

A batch is scanned once. Per column the scan keeps exact counts, moments, ends and the smallest value as text, a HyperLogLog sketch of
its distinct values and, for numbers, a KLL sketch of its distribution. Sketches of any number of batches are merged and read
like one; a sketch has a bounded size, whatever the batch.

Errors: the number of distinct values is off by more than DISTINCT_ERROR of it in about one of a hundred columns or less; the rank of a percentile
is off by more than RANK_ERROR of the filled cells as rarely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freightlens.functions.numbers import percent, rounded
from freightlens.operators.ranking import PERCENTILE_KINDS
from freightlens.plans.profiling import PERCENTILES

REGISTERS = 14  # log2 of a HyperLogLog sketch's registers
KEPT = 800  # k of a KLL sketch
DISTINCT_ERROR = 3 * 1.04 / 2 ** (REGISTERS / 2)
RANK_ERROR = 0.01

SKETCH = (
    "column string, dtype string, place int, rows bigint, filled bigint, distinct binary, least string,"
    " values binary, number_count bigint, mean double, squares double, low double, high double, zeros bigint, negatives bigint"
)


def _cell(schema: StructType, name: str) -> tuple[Column, bool]:
    """A column as it is looked at, NaN being a missing number, and whether it is numeric."""
    kind = schema[name].dataType.typeName()
    cell = F.col(f"`{name}`")
    if kind in ("float", "double"):
        cell = F.when(~F.isnan(cell), cell)
    return cell, kind in PERCENTILE_KINDS


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row of SKETCH per column, from one scan and one aggregate without grouping."""
    columns = list(columns or df.columns)
    measures, rows = [F.count("*").alias("n")], []
    for i, name in enumerate(columns):
        cell, numeric = _cell(df.schema, name)
        text = cell.cast("string")
        measures += [
            F.count(cell).alias(f"f{i}"), F.hll_sketch_agg(text, F.lit(REGISTERS)).alias(f"d{i}"), F.min(text).alias(f"l{i}"),
        ]
        number: dict[str, Column] = {}
        if numeric:
            value = cell.cast("double")
            measures += [
                F.kll_sketch_agg_double(value, F.lit(KEPT)).alias(f"v{i}"), F.avg(value).alias(f"a{i}"),
                (F.var_pop(value) * F.count(value)).alias(f"s{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
                F.coalesce(F.sum((value == 0).cast("int")), F.lit(0)).alias(f"z{i}"), F.coalesce(F.sum((value < 0).cast("int")), F.lit(0)).alias(f"m{i}"),
            ]
            number = {
                "values": F.col(f"v{i}"), "number_count": F.col(f"f{i}"), "mean": F.col(f"a{i}"), "squares": F.col(f"s{i}"),
                "low": F.col(f"lo{i}"), "high": F.col(f"hi{i}"), "zeros": F.col(f"z{i}"), "negatives": F.col(f"m{i}"),
            }
        known = {
            "column": F.lit(name), "dtype": F.lit(df.schema[name].dataType.simpleString()), "place": F.lit(i), "rows": F.col("n"),
            "filled": F.col(f"f{i}"), "distinct": F.col(f"d{i}"), "least": F.col(f"l{i}"), **number,
        }
        layout = [field.split() for field in SKETCH.split(", ")]
        rows.append(F.struct(*[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in layout]))
    return df.agg(*measures).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merged(sketches: DataFrame) -> DataFrame:
    """Sketches of several batches as those of all their rows, a row per column; the input has a row per column and batch."""
    count = F.coalesce(F.col("number_count"), F.lit(0))
    whole = Window.partitionBy("column")
    centre = F.sum(F.col("mean") * count).over(whole) / F.nullif(F.sum(count).over(whole), F.lit(0))
    away = sketches.withColumn("centre", centre).withColumn("squares", F.col("squares") + count * (F.col("mean") - F.col("centre")) ** 2)
    return away.groupBy("column").agg(
        F.max("dtype").alias("dtype"), F.max("place").alias("place"), F.sum("rows").alias("rows"), F.sum("filled").alias("filled"),
        F.hll_union_agg("distinct").alias("distinct"), F.min("least").alias("least"), F.kll_merge_agg_double("values").alias("values"),
        F.sum("number_count").alias("number_count"), F.max("centre").alias("mean"), F.sum("squares").alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("zeros").alias("zeros"), F.sum("negatives").alias("negatives"),
    )


class SketchStore:
    """Sketches of every batch below one folder; a batch that comes again replaces its own."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def add(self, batch: str, df: DataFrame) -> None:
        rows = column_sketches(df).coalesce(1).withColumn("batch", F.lit(batch))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path)

    def read(self, batches: Sequence[str] | None = None) -> DataFrame:
        """Merged sketches of the batches named, or of all."""
        stored = self.spark.read.schema(f"{SKETCH}, batch string").parquet(self.path)
        return merged(stored.where(F.col("batch").isin(list(batches))) if batches is not None else stored)


def approximate_schema(sketch: DataFrame) -> DataFrame:
    """Type, filled and missing cells, estimated distinct values and the smallest value of every column."""
    missing = F.col("rows") - F.col("filled")
    return sketch.select(
        "column", "dtype", F.col("filled").alias("non_null"), missing.alias("null_count"),
        F.coalesce(rounded(percent(missing, F.col("rows")), 2).cast("double"), F.lit(0.0)).alias("null_pct"),
        # a union is estimated from its registers alone, so any way of merging the same values gives the same number
        F.hll_sketch_estimate(F.hll_union("distinct", "distinct")).alias("unique_estimate"), F.col("least").alias("sample_value"),
    )


def approximate_numbers(sketch: DataFrame, probabilities: Sequence[float] = PERCENTILES) -> DataFrame:
    """Count, moments and ends as they are, percentiles estimated, of the numeric columns; percentiles of a column without values are null."""
    numbers = sketch.where("number_count is not null")
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    found = F.when(F.col("number_count") > 0, F.kll_sketch_get_quantile_double("values", ranks))
    return numbers.select(
        "column", F.col("number_count").alias("count"), rounded(F.col("mean"), 4).cast("double").alias("mean"),
        rounded(F.sqrt(F.col("squares") / F.nullif(F.col("number_count") - 1, F.lit(0))), 4).cast("double").alias("std"),
        F.col("low").alias("min"), F.col("high").alias("max"), (F.col("rows") - F.col("number_count")).alias("missing"),
        F.col("zeros").alias("zero_count"), F.col("negatives").alias("negative_count"),
        *[F.get(found, F.lit(i)).alias(f"p{round(p * 100):02d}") for i, p in enumerate(probabilities)],
    )


def rank_errors(df: DataFrame, estimates: DataFrame, probabilities: Sequence[float] = PERCENTILES) -> DataFrame:
    """(column, rank_error): the largest share of the filled cells by which an estimated percentile misses its rank, counted exactly.

    `estimates` has a row per numeric column of df, as from approximate_numbers.
    """
    names = [f"p{round(p * 100):02d}" for p in probabilities]
    columns = [r["column"] for r in estimates.select("column").collect()]  # a row per column
    cells = [F.struct(F.lit(c).alias("column"), _cell(df.schema, c)[0].cast("double").alias("v")) for c in columns]
    values = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where("v is not null")
    at = F.broadcast(estimates.select(F.col("column").alias("of"), *names))
    counted = values.join(at, F.col("column") == F.col("of")).groupBy("column").agg(
        F.count("*").alias("n"),
        *[F.sum((F.col("v") < F.col(q)).cast("int")).alias(f"below_{q}") for q in names],
        *[F.sum((F.col("v") <= F.col(q)).cast("int")).alias(f"upto_{q}") for q in names],
    )
    # the value at a rank holds all ranks from the values below it to those up to it
    off = [F.greatest(F.col(f"below_{q}") / F.col("n") - p, p - F.col(f"upto_{q}") / F.col("n"), F.lit(0.0)) for q, p in zip(names, probabilities)]
    return counted.select("column", F.greatest(*off).alias("rank_error"))
