"""Exact distinct counts of dense integer keys as bitmaps that merge.

A bitmap is cut into words of 64 keys: (group, word number, 64 bits). Words combine by OR in the scanning tasks and again after a dimension's
attribute has taken the place of its key, so neither rows nor single keys are shuffled and no row is expanded for the sake
of several counts. A word costs the same with one key in it as with 64; keys given out in order fill their words.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys..., word, bits) of the non-null values of an integer column, negative ones included."""
    value = F.col(column).cast("bigint")
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")
    return rows.where(value.isNotNull()).groupBy(*keys, F.shiftright(value, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def counted(bitmap: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys..., name): distinct values per group of a bitmap, whose rows may hold a word of a group several times."""
    whole = bitmap.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
    return whole.groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("bigint")).alias(name))


def with_distinct_counts(
    groups: DataFrame, rows: DataFrame, keys: Sequence[str], counts: Mapping[str, str],
    by: Sequence[str] | None = None, attach: Callable[[DataFrame], DataFrame] = lambda bitmap: bitmap,
) -> DataFrame:
    """groups, a row per value of `keys`, with the distinct values of each column in `counts` (name to column), 0 where there are none.

    If `keys` are attributes, rows are first grouped `by` the surrogate keys that `attach` turns into them.
    """
    for name, column in counts.items():
        found = counted(attach(words(rows, by or keys, column)), keys, name)
        found = found.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [groups[k].eqNullSafe(found[f"_{k}"]) for k in keys])
        groups = groups.join(found, same, "left").drop(*[f"_{k}" for k in keys])
    return groups.fillna(0, list(counts))
