"""The training corpus pipeline: toxic documents go, one of each near-duplicate group stays, contaminated ones go, sources are mixed,
and the mix is written as token files. A stage's result is written as Parquet and read as the next stage's documents.

Documents that repeat a doc_id are kept or dropped together, but of rows equal in doc_id and text the second stage keeps one.
Null and empty texts pass the filters. The mix holds a document once per copy; the token files hold every copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.llm.common import steps, table, unique_name
from freightlens.llm.dart_minhash import near_duplicate_classes
from freightlens.llm.latent_decontamination import contaminated
from freightlens.llm.mixing import mixed_sources, words_in
from freightlens.llm.token_files import read_shards, write_shards
from freightlens.llm.toxicity import THRESHOLD, toxicity
from freightlens.operators.joins import small_enough


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is not among ids; the texts are shuffled only if the ids are too many to broadcast."""
    key = unique_name(docs, "gone_id")
    gone = steps(docs.sparkSession).write(ids.select(F.col("doc_id").alias(key)).distinct(), "gone")
    return docs.join(F.broadcast(gone) if small_enough(gone) else gone, F.col("doc_id") == F.col(key), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity(steps(spark), docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return _without(docs, scored.where(F.col("score") >= THRESHOLD))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(steps(spark), docs)
    return _without(docs, classes.where("doc_id <> class_id")).dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = contaminated(steps(spark), docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return _without(docs, judged.where("contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixed_sources(steps(spark), docs)
    doc_id, source, size, copies, rows, words, nr, copy = (
        unique_name(docs, f"mix_{stem}") for stem in ("doc_id", "source", "size", "copies", "rows", "words", "nr", "copy")
    )
    key = [F.col(k).alias(name) for k, name in (("doc_id", doc_id), ("source", source), ("size", size))]
    taken = mixed.groupBy(*key).agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    sized = docs.withColumn(words, words_in(F.col("text")))
    number = F.row_number().over(Window.partitionBy("doc_id", "source", words).orderBy(F.xxhash64("text")))  # rows of one doc_id
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(words) == F.col(size))
    joined = sized.withColumn(nr, number).join(taken, same)
    share = F.expr(f"{copies} div {rows} + if({nr} <= {copies} % {rows}, 1, 0)")
    repeated = joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), share.cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ws = steps(spark)
    return read_shards(write_shards(ws, docs, ws.path("tokens"))).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]
ORACLE_SQL = None  # learned scores, signatures and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = steps(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.write(stage(spark, docs, sf_dir), name)
    return docs
