"""Declared data rules evaluated together in one pass and returned as report rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.numbers import failures, percent, rounded


@dataclass
class Rule:
    """Either a row condition that marks a failing row, or a way to count failing rows. `needs` names the columns it looks at."""

    name: str
    severity: str
    fails: Column | None = None
    count: Callable[[], Column] | None = None
    needs: tuple[str, ...] = ()

    def applies(self, df: DataFrame) -> bool:
        return set(self.needs) <= set(df.columns)


def repeated_key_rows(df: DataFrame, key: str) -> Column:
    """Rows whose key occurs more than once (all copies counted; NULL is a key like any other)."""
    sizes = df.groupBy(F.col(f"`{key}`").alias("k")).agg(F.count("*").alias("n"))
    return sizes.where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()


def fingerprints(df: DataFrame) -> list[Column]:
    """128 bits of a row, equal for equal rows: two hashes over the values and over which cells are NULL, as hashes pass over NULL."""
    gaps = [
        reduce(lambda a, b: a + b, [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << k)).otherwise(0).cast("long") for k, c in enumerate(df.columns[i : i + 32])])
        for i in range(0, len(df.columns), 32)
    ]
    cells = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(F.lit(seed), *gaps, *cells) for seed in (1, 2)]


# Groups of copies that are sent to every task rather than have the rows come to them; two longs each.
BROADCAST_GROUPS = 100_000


def exact_copies(df: DataFrame, key: str | None = None) -> Column:
    """Rows beyond the first of each set of identical rows, found right away.

    Only fingerprints are shuffled. In a table without copies that is all; otherwise the rows whose fingerprint occurs again are read a second
    time and compared in all their columns, so that the count is exact. As copies share their `key`, if one is named, where no key occurs
    again the other columns are not read, and where few do, only their rows are looked at.
    """
    if key is not None:
        again = df.groupBy(F.col(f"`{key}`").alias("_k")).agg(F.count("*").alias("n")).where("n > 1").select("_k")
        keys = again.limit(BROADCAST_GROUPS + 1).count()
        if keys == 0:
            return F.lit(0).cast("bigint")
        if keys <= BROADCAST_GROUPS:
            df = df.join(F.broadcast(again), F.col(f"`{key}`").eqNullSafe(F.col("_k")), "left_semi")
    first, second = fingerprints(df)
    prints = df.select(first.alias("_f"), second.alias("_g"))
    repeated = prints.groupBy("_f", "_g").agg(F.count("*").alias("n")).where("n > 1").select("_f", "_g")
    groups = repeated.limit(BROADCAST_GROUPS + 1).count()
    if groups == 0:
        return F.lit(0).cast("bigint")
    marked = df.withColumns({"_f": first, "_g": second})
    marked = marked.join(F.broadcast(repeated) if groups <= BROADCAST_GROUPS else repeated, ["_f", "_g"], "left_semi")
    counts = marked.groupBy("_f", "_g", *[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()


def rule_report(df: DataFrame, rules: Sequence[Rule], name: str = "rule") -> DataFrame:
    """(rule, severity, failed_rows, failed_pct, status) with PASS or REVIEW per rule that applies; no rows if none does."""
    rules = [r for r in rules if r.applies(df)]
    if not rules:
        return df.sparkSession.createDataFrame([], f"`{name}` string, severity string, failed_rows bigint, failed_pct double, status string")
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.coalesce(failures(r.fails), F.lit(0)).alias(f"r{i}") for i, r in enumerate(rules) if r.count is None],
    )
    rows = []
    for i, r in enumerate(rules):
        failed = F.col(f"r{i}") if r.count is None else r.count()
        rows.append(F.struct(F.lit(r.name).alias(name), F.lit(r.severity).alias("severity"), failed.cast("bigint").alias("failed_rows")))
    report = counted.select("_rows", F.explode(F.array(*rows)).alias("r")).select("_rows", "r.*")
    return report.select(
        name,
        "severity",
        "failed_rows",
        rounded(percent(F.col("failed_rows"), F.col("_rows")), 4).cast("double").alias("failed_pct"),
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("REVIEW").alias("status"),
    )


def null_cells(df: DataFrame) -> Column:
    """Number of NULL cells over all columns."""
    filled = [F.count(F.col(f"`{c}`")) for c in df.columns]
    return F.count("*") * len(filled) - sum(filled[1:], filled[0])


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text, n): every distinct value of every column with its row count, in one scan and shuffle.

    Values combine in the scanning tasks, so a value that fills a column costs no more than a rare one.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.column", "c.value").agg(F.count("*").alias("n"))


# Kinds whose values are equal just where their texts are; others, such as doubles, are told apart as text.
PLAIN_KINDS = ("boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "string")


def column_figures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, non_null, null_count, unique_count, sample_value): of every column its cells, its distinct values and the smallest as text.

    Each column is read and grouped by itself in its own type. No row is expanded into cells, and a value is turned into text once, not once per row.
    """
    kinds = dict(df.dtypes)

    def figures(column: str) -> DataFrame:
        kind = kinds[column]
        value = F.col(f"`{column}`") if kind in PLAIN_KINDS or kind.startswith("decimal") else F.col(f"`{column}`").cast("string")
        values = df.select(value.alias("value")).groupBy("value").agg(F.count("*").alias("n"))
        filled = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
        return values.agg(
            F.coalesce(filled, F.lit(0)).alias("non_null"),
            F.coalesce(F.sum("n") - filled, F.lit(0)).alias("null_count"),
            F.count("value").alias("unique_count"),
            F.min(F.col("value").cast("string")).alias("sample_value"),
        ).select(F.lit(column).alias("column"), "*")

    return reduce(DataFrame.unionByName, [figures(c) for c in columns])
