"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from freightlens.session import Workspace, observed


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); component is the smallest node reached.

    Every round points the neighbours of a node to the smallest one, first the larger neighbours, then the smaller; a
    forest of stars is left after O(log nodes) rounds. A node of very many edges costs one pre-aggregated minimum and
    a join that Spark can split. Each round is written to the shared folder. No edges: no rows.
    """
    name = ws.fresh("edges")
    current, before = _written(ws, edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        larger = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = larger.groupBy("a").agg(F.min("b").alias("m"))
        to_least = larger.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, name = name, ws.fresh("edges")
        current, after = _written(ws, to_least.unionByName(smallest.withColumnRenamed("m", "b")).where("a <> b").distinct(), name)
        ws.drop(old)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _written(ws: Workspace, edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The stored edges and their number and two sums of hashes, which the writing tasks count along: no job reads the edges for it."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64("b", "a")).alias("mixed")
    stored = ws.write(edges.observe(seen, F.count("*").alias("rows"), *hashes), name)
    found = observed(seen, rows=0, total=None, mixed=None)
    return stored, (found["rows"], found["total"], found["mixed"])
