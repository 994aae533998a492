"""Joins that attach a table with unique keys to a much larger one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup whose columns taken hold at most this many bytes is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 64 << 20
# Bytes of a cell by kind; text is measured.
CELL_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "bigint": 8, "double": 8, "timestamp_ntz": 8}


# Rows that one task has of a large group, where rows are dealt out by group.
PART_ROWS = 100_000

# Holds while a plan with join_by_group runs, or else Spark deals the rows out by key.
BY_GROUP = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def join_by_group(rows: DataFrame, narrow: DataFrame, key: str, group: str) -> DataFrame:
    """The columns of `narrow` joined to stored `rows` that have the same `key`, of which every row has its own, while the rows move to tasks by `group`.

    Both hold `key` and `group`. A large group goes to several tasks, as many as its rows need, and a small one to one task. So however many
    lookups `narrow` comes from, the wide rows are shuffled once, and what is written by group needs no further move.
    """
    found = rows.groupBy(group).agg((1 + F.floor(F.count("*") / PART_ROWS)).alias("parts")).where("parts > 1").collect()  # a row per large group
    parts = F.lit(1)
    for r in found:
        parts = F.when(F.col(group).eqNullSafe(F.lit(r[group])), r["parts"]).otherwise(parts)
    part = F.xxhash64(group, F.pmod(F.xxhash64(key), parts))
    dealt = rows.withColumn("_part", part).repartition("_part")
    beside = narrow.withColumn("_its_part", part).drop(group).withColumnRenamed(key, "_its_key").repartition("_its_part")
    matching = (F.col("_part") == F.col("_its_part")) & (F.col(key) == F.col("_its_key"))
    return dealt.join(beside.hint("merge"), matching).drop("_part", "_its_part", "_its_key")


def small_enough(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored lookup's cells fit the limit: one aggregate over the columns that are taken, texts by their length."""
    texts = [c for c, t in lookup.dtypes if t == "string"]
    fixed = 16 + sum(8 + CELL_BYTES.get(t, 16) for c, t in lookup.dtypes if t != "string")
    long = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).alias(f"t{i}") for i, c in enumerate(texts)]
    found = lookup.agg(F.count("*").alias("n"), *long).first()
    return found["n"] * (fixed + 16 * len(texts)) + sum(found[f"t{i}"] for i in range(len(texts))) <= limit


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str | Column, str]],
    take: Sequence[str],
    null_safe: bool = False,
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join `rows` to a stored `lookup` whose `on` keys are unique, adding the `take` columns.

    The bytes of the columns used decide between a broadcast and a shuffle, unless `small` says so from an earlier look. `rows` is read once, whatever the plan: in the shuffled case
    a key that very many rows share is split at run time, as a sort-merge join's skewed partitions are, and its one
    lookup row goes to every part.

    As the keys are stated to be unique by dropDuplicates, Spark leaves a left join out of every plan that uses none of the `take` columns.
    """
    probes = [f"_probe{i}" for i in range(len(on))]
    keys = [f"_key{i}" for i in range(len(on))]
    rows_in = rows.columns
    rows = rows.withColumns({p: F.col(left) if isinstance(left, str) else left for p, (left, _) in zip(probes, on)})
    lookup = lookup.select(*[F.col(right).alias(k) for k, (_, right) in zip(keys, on)], *take)
    small = small_enough(lookup) if small is None else small
    if null_safe:  # NULL as a key of its own, in columns that hold no NULL
        for p, k in zip(probes, keys):
            blank = F.lit("" if dict(lookup.dtypes)[k] == "string" else 0).cast(dict(lookup.dtypes)[k])
            rows = rows.withColumns({f"{p}n": F.col(p).isNull(), p: F.coalesce(p, blank)})
            lookup = lookup.withColumns({f"{k}n": F.col(k).isNull(), k: F.coalesce(k, blank)})
        probes, keys = [*probes, *[f"{p}n" for p in probes]], [*keys, *[f"{k}n" for k in keys]]
    matching = reduce(lambda a, b: a & b, [F.col(p) == F.col(k) for p, k in zip(probes, keys)])
    if how == "left":
        lookup = lookup.dropDuplicates(keys)
    lookup = F.broadcast(lookup) if small else lookup.hint("merge")
    return rows.join(lookup, matching, how).select(*rows_in, *take)
