"""Exact global positions, ranks and order statistics that do not put all rows into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from freightlens.operators.joins import lookup_join
from freightlens.session import Workspace

# The kinds of columns that have percentiles.
PERCENTILE_KINDS = ("byte", "short", "integer", "long", "decimal", "float", "double")

# Histogram width per refinement pass: two passes settle a range of 2**36 values.
BUCKETS = 2**18


def dense_index(ws: Workspace, df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """0-based position of every row in the order given, for any number of rows.

    Rows are range-partitioned and sorted, and written with their (partition, offset) slot. The
    written table fixes the slots; adding up the partition sizes turns them into positions.
    """
    tasks = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
    slotted = (
        df.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    table = ws.write(slotted, ws.fresh("ordered"))
    part = F.shiftright("_slot", 33)
    sizes = sorted(table.groupBy(part.alias("p")).count().collect())  # one row per range partition
    starts, seen = [], 0
    for row in sizes:
        starts.append((row["p"], seen))
        seen += row["count"]
    starts = ws.spark.createDataFrame(starts, "_part long, _start long")
    return (
        table.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_slot") - F.shiftleft(F.col("_part"), 33))
        .drop("_slot", "_part", "_start")
    )


def _same(df: DataFrame, other: DataFrame, keys: Sequence[str], named: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(other[g]) for k, g in zip(keys, named)])


def row_number(ws: Workspace, df: DataFrame, order: Sequence[Column], name: str, partition: Sequence[str] = ()) -> DataFrame:
    """1-based row number, in each partition if any are named. A partition may span many tasks."""
    placed = dense_index(ws, df, [*[F.col(c) for c in partition], *order], "_pos")
    if not partition:
        return placed.withColumn(name, (F.col("_pos") + 1).cast("int")).drop("_pos")
    named = [f"_g{i}" for i in range(len(partition))]
    first = placed.groupBy(*[F.col(k).alias(g) for k, g in zip(partition, named)]).agg(F.min("_pos").alias("_first"))
    numbered = placed.join(first, _same(placed, first, partition, named))
    return numbered.withColumn(name, (F.col("_pos") - F.col("_first") + 1).cast("int")).drop("_pos", "_first", *named)


def rank(ws: Workspace, df: DataFrame, value: str, name: str, dense: bool = False) -> DataFrame:
    """RANK or DENSE_RANK by `value`, largest first, from prefix counts over the distinct values.

    Rows with one value are only counted, and get their rank back by a lookup, so a value that many rows share is no task's burden.
    """
    tasks = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    order = F.desc("_value")
    table = ws.write(counts.repartitionByRange(tasks, order).withColumn("_part", F.spark_partition_id()), ws.fresh("ranked"))
    weight = F.lit(1) if dense else F.col("_n")
    starts, seen = [], 0
    for row in sorted(table.groupBy("_part").agg(F.sum(weight).alias("n")).collect()):  # one row per range partition
        starts.append((row["_part"], seen))
        seen += row["n"]
    starts = F.broadcast(ws.spark.createDataFrame(starts, "_part int, _start long"))
    before = F.coalesce(F.sum(weight).over(Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = table.withColumn("_before", before).join(starts, "_part")
    ranks = ws.write(ranks.select("_value", (F.col("_start") + F.col("_before") + 1).cast("int").alias(name)), ws.fresh("ranks"))
    return lookup_join(df, ranks, [(value, "_value")], [name], null_safe=True)


def ntile(ws: Workspace, df: DataFrame, tiles: int, order: Sequence[Column], name: str) -> DataFrame:
    placed = dense_index(ws, df, order, "_pos")
    n = placed.count()
    size, longer = divmod(n, tiles)  # the first `longer` tiles hold one row more
    edge = longer * (size + 1)
    tile = F.when(F.col("_pos") < edge, F.floor(F.col("_pos") / (size + 1))).otherwise(
        longer + F.floor((F.col("_pos") - edge) / max(size, 1))
    )
    return placed.withColumn(name, (tile + 1).cast("int")).drop("_pos")


Ranks = Callable[[int], Sequence[int]]


def order_statistics(df: DataFrame, wanted: dict[str, Ranks]) -> tuple[dict[tuple[str, int], tuple[int, int]], dict[str, int]]:
    """Exact values at 1-based ranks of long columns, nulls left out.

    `wanted` maps a column to a function from its number of values to the ranks asked for. Returns
    {(column, rank): (value, rank among the rows that hold that value)} and the numbers of values.

    Every pass counts rows into at most BUCKETS buckets per open bracket, combined in the scanning
    tasks, and keeps the buckets that contain a rank. So neither rows nor distinct values are ever
    brought together, and one row per rank returns to the driver. Buckets begin at multiples of their width, so that no
    difference of two values is taken, which might not fit a long.
    """
    columns = list(wanted)
    ends = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    sizes = {c: ends[f"n{i}"] for i, c in enumerate(columns)}
    brackets = {
        (c, r): (ends[f"lo{i}"], ends[f"hi{i}"], r) for i, c in enumerate(columns) if sizes[c] for r in wanted[c](sizes[c])
    }
    while True:
        open_now = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in brackets.items() if lo < hi})
        if not open_now:
            return {key: (lo, inside) for key, (lo, _, inside) in brackets.items()}, sizes
        steps = [1 << ((hi - lo) // BUCKETS).bit_length() for _, lo, hi in open_now]  # powers of two, whose multiples reach the least long
        hits = [
            F.when(
                F.col(c).between(lo, hi),
                F.struct(F.lit(i).alias("b"), F.expr(f"(`{c}` - pmod(`{c}`, {step}L)) div {step}L").alias("k")),
            )
            for i, ((c, lo, hi), step) in enumerate(zip(open_now, steps))
        ]
        counts = df.select(F.explode(F.array_compact(F.array(*hits))).alias("h")).groupBy("h.b", "h.k").agg(F.count("*").alias("n"))
        up_to = F.sum("n").over(Window.partitionBy("b").orderBy("k"))  # at most BUCKETS + 1 rows per bracket
        ranks = [sorted(v[2] for (c, _), v in brackets.items() if (c, *v[:2]) == b) for b in open_now]
        asked = F.element_at(F.array(*[F.array(*[F.lit(r).cast("long") for r in rs]) for rs in ranks]), F.col("b") + 1)
        found = (
            counts.withColumn("seen", up_to)
            .withColumn("r", F.explode(asked))
            .where("r > seen - n and r <= seen")
            .select("b", "k", "r", F.expr("r - (seen - n)").alias("inside"))
            .collect()
        )
        at = {(row["b"], row["r"]): (row["k"], row["inside"]) for row in found}
        for key, (lo, hi, inside) in brackets.items():
            if lo < hi:
                b = open_now.index((key[0], lo, hi))
                bucket, inside = at[(b, inside)]
                brackets[key] = (max(lo, bucket * steps[b]), min(hi, (bucket + 1) * steps[b] - 1), inside)


def _ordered_bits(value: Column) -> Column:
    """Doubles as longs of the same order: the bits of a positive number, those of a negative one counted down from zero. NaN becomes NULL."""

    def ordered(values: pd.Series) -> pd.Series:
        numbers = values.to_numpy(np.float64, na_value=np.nan)
        bits = np.abs(numbers).view(np.int64)
        return pd.Series(np.where(numbers < 0, -bits, bits)).astype("Int64").mask(np.isnan(numbers))

    return F.pandas_udf(ordered, LongType())(value)  # a function of its own, so that executors need not have this module


def _from_ordered_bits(bits: int) -> float:
    value = float(np.int64(abs(bits)).view(np.float64))
    return -value if bits < 0 else value


def quantiles(df: DataFrame, columns: dict[str, int | None], probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles. `columns` gives each column's number of decimals, None for floats and doubles."""

    def neighbours(n: int) -> list[int]:
        places = [(n - 1) * p for p in probabilities]
        return sorted({rank for x in places for rank in (int(x) + 1, min(int(x) + 2, n))})

    def whole(column: str, scale: int | None) -> Column:
        cell = F.col(f"`{column}`")
        return _ordered_bits(cell.cast("double")) if scale is None else (cell * F.lit(10**scale)).cast("long")

    scaled = df.select(*[whole(c, s).alias(f"q{i}") for i, (c, s) in enumerate(columns.items())])
    found, sizes = order_statistics(scaled, {c: neighbours for c in scaled.columns})
    result: dict[str, list[float | None]] = {}
    for c, (name, scale) in zip(scaled.columns, columns.items()):
        n, values = sizes[c], []
        for p in probabilities:
            if not n:
                values.append(None)
                continue
            x = (n - 1) * p
            ends = [found[(c, rank)][0] for rank in (int(x) + 1, min(int(x) + 2, n))]
            low, high = [_from_ordered_bits(v) if scale is None else v / 10**scale for v in ends]
            values.append(low if low == high or x == int(x) else low + (high - low) * (x - int(x)))
        result[name] = values
    return result
