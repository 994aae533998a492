"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

A document's expected copies are its source's target over its source's size. Within a source documents are ordered by size, then
by a hash, and the expected copies summed up; with one random offset per source, a document is taken once for each
integer its stretch of the sum crosses. Documents of like size share the copies evenly, so the words taken stay within
a few of the longest documents' sizes of the target. Sums are integers of UNIT parts of a copy, hence exact and the same in every run.

The sum within a source is taken in two levels: sums of the (size, hash) cells, each small, and places within a cell. So
a source with most of the rows, or with many documents of one size, is dealt over many tasks.

Null texts have size 0; a null source is a source of its own, last in the order. Rows that repeat a doc_id are documents
of their own; equal rows may swap copies among themselves. Documents: doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.llm.common import steps, table
from freightlens.session import Workspace

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
SHARE = 1.5  # words taken over words there are
MOST = 2  # copies
UNIT = 1 << 24
CELLS = 64  # of one size within a source
SEED = "mix"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target): weight times a common level, at most `most` sizes, `share` of all sizes in sum.

    Sharing the excess anew until nothing is above its limit ends at that level. Sources in the order of limit over weight:
    one is at its limit if the level that the sources from it on would have without it lies above. A row per source.
    """
    everyone = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(everyone) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("level", level).withColumn("full", F.col("weight") * F.col("level") >= F.col("limit"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)  # the first one's; later ones fall
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * common).alias("target"))


def sampled(docs: DataFrame, sizes: DataFrame, seed: str = SEED) -> DataFrame:
    """docs (doc_id, source, size) with `copies`, by systematic sampling towards sizes' targets (source, source_size, target)."""
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.coalesce("source", F.lit("")))), 1, 6), 16, 10).cast("long")
    rates = sizes.select(F.col("source").alias("of"), "source_size", "target", expected.alias("rate"), offset.alias("offset"))
    cell = F.pmod(F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 4), 16, 10).cast("long"), F.lit(CELLS))
    docs = docs.withColumn("cell", cell)
    key = ["source", "size", "cell"]
    counts = docs.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("size", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("source").alias("of"), F.col("size").alias("s"), F.col("cell").alias("c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    ).join(rates.withColumnRenamed("of", "its"), F.col("of").eqNullSafe(F.col("its")))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id")) - 1
    placed = docs.withColumn("place", place).join(
        starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("s")) & (F.col("cell") == F.col("c"))
    )
    copies = F.expr(f"((start + place + 1) * rate + offset) div {UNIT} - ((start + place) * rate + offset) div {UNIT}")
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixed_sources(ws: Workspace, docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per row of docs."""
    sized = ws.write(docs.select("doc_id", "source", words_in(F.col("text")).alias("size")), ws.fresh("sized"))
    sizes = ws.write(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), ws.fresh("targets"))
    return sampled(sized, sizes).withColumn("taken", F.col("copies") * F.col("size"))


def op10_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_sources(steps(spark), table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) AS nr FROM sized GROUP BY source
), limits AS (
    SELECT *, CAST([5, 2, 1][(nr - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS top FROM sources
), levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(top) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM limits
    WINDOW before AS (ORDER BY top / weight, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
        CASE WHEN weight * level >= top THEN top ELSE weight * max(CASE WHEN weight * level < top THEN level END) OVER () END AS target
    FROM levels
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 16777216) AS BIGINT) ELSE 0 END AS rate,
        CAST('0x' || substr(md5('mix|' || coalesce(source, '')), 1, 6) AS BIGINT) AS start
    FROM targets
), placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY source ORDER BY size, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 4) AS BIGINT) % 64, doc_id NULLS FIRST
    ) - 1 AS place FROM sized
)
SELECT doc_id, size, source_size, target, (((place + 1) * rate + start) // 16777216 - (place * rate + start) // 16777216) * size AS taken
FROM placed JOIN rates ON placed.source IS NOT DISTINCT FROM rates.source
"""
