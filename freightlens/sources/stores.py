"""Tables that outlive a session: partitioned by batch, or versioned and switched together."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freightlens.operators.joins import BY_GROUP
from freightlens.schemas import fields
from freightlens.session import observed, setting


def stored(spark: SparkSession, path: str, layout: Mapping[str, str]) -> DataFrame:
    """The Parquet table at `path` with exactly the layout's columns; without rows if there is none yet."""
    schema = ", ".join(f"`{c}` {t}" for c, t in layout.items())
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder. Through the JVM's file system, as the path may be in any store; in classic mode only."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


class BatchTable:
    """A table partitioned by load batch and by month.

    A load replaces the partitions of its batch and leaves the files of other batches as they are, so it can run again after a
    failure. Readers of a batch or of some months read their folders only. One load at a time may write.
    """

    def __init__(self, spark: SparkSession, path: str, layout: Mapping[str, str], batch: str, month: str):
        self.spark, self.path, self.batch, self.month = spark, path, batch, month
        self.layout = {**{c: t for c, t in layout.items() if c not in (batch, month)}, batch: layout[batch], month: layout[month]}

    def read(self) -> DataFrame:
        return stored(self.spark, self.path, self.layout)

    def of_batch(self, batch: str) -> DataFrame:
        return self.read().where(F.col(self.batch) == batch)

    def partitions(self, batch: str) -> list[str | int | None]:
        """The batch's months; a row per month."""
        return [r[0] for r in self.of_batch(batch).select(self.month).distinct().collect()]

    def replace(
        self, batch: str, rows: DataFrame, numbered: str | None = None, finish: Callable[[DataFrame], DataFrame] = lambda df: df, dealt: bool = False
    ) -> int:
        """Write a batch's rows in place of those it has; their number. `numbered` names a long column to hold the place a row is written at.

        Rows go to tasks by partition, large partitions to several, so that a month is neither one huge file nor many tiny ones. `finish` adds
        what follows from a row alone after that, so that it is not moved. Rows that are `dealt` out by month already stay where they are.
        """
        before, seen = self.partitions(batch), Observation(f"batch {batch}")
        placed = finish(rows if dealt else rows.hint("rebalance", self.month)).withColumn(self.batch, F.lit(batch))
        if numbered:
            placed = placed.withColumn(numbered, F.monotonically_increasing_id())
        placed = placed.select(*[F.col(c).cast(t).alias(c) for c, t in self.layout.items()])
        month = F.col(self.month)
        placed = placed.observe(seen, F.count("*").alias("rows"), F.count(month).alias("dated"), F.collect_set(month).alias("months"))
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.batch, self.month)
        with setting(self.spark, *BY_GROUP):
            writer.option("compression", "zstd").parquet(self.path)
        found = observed(seen, rows=0, dated=0, months=[])
        written = {*found["months"], *([None] if found["dated"] < found["rows"] else [])}
        for gone in set(before) - written:  # months that the batch no longer has
            name = "__HIVE_DEFAULT_PARTITION__" if gone is None else gone
            remove(self.spark, f"{self.path}/{self.batch}={batch}/{self.month}={name}")
        return found["rows"]


MANIFEST = "version bigint, table_name string, folder string, published_at timestamp_ntz"


class VersionedTables:
    """Tables that change together. Every version lies in folders of its own; a manifest, added to last and in one file, says which are current.

    A load that dies before that leaves the version before it current and readable, and the next load starts from it. One
    load at a time may publish.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def manifest(self) -> DataFrame:
        return stored(self.spark, f"{self.path}/manifest", fields(MANIFEST))

    def version(self) -> int:
        """Number of the current version, 0 before the first."""
        return self.manifest().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """The current version's tables by name, or an earlier one's."""
        number = self.version() if version is None else version
        rows = self.manifest().where(F.col("version") == number).select("table_name", "folder").collect()  # a row per table
        return {r["table_name"]: self.spark.read.parquet(f"{self.path}/{r['folder']}") for r in rows}

    def publish(
        self, plans: Mapping[str, Callable[[], DataFrame]], at: datetime, check: Callable[[dict[str, DataFrame]], None] = lambda tables: None
    ) -> int:
        """Write all tables side by side as a new version, then make it the current one, unless `check` raises on what was written."""
        number, tag = self.version() + 1, uuid.uuid4().hex[:8]
        folders = {name: f"{name}/v{number:06d}-{tag}" for name in plans}

        def write(name: str) -> None:
            plans[name]().write.mode("errorifexists").option("compression", "zstd").parquet(f"{self.path}/{folders[name]}")

        with ThreadPoolExecutor(max(1, len(plans))) as pool:
            for done in [pool.submit(write, name) for name in plans]:
                done.result()
        check({name: self.spark.read.parquet(f"{self.path}/{folder}") for name, folder in folders.items()})
        rows = [(number, name, folder, at) for name, folder in folders.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return number

    def expire(self, keep: int = 2) -> None:
        """Delete the folders of all but the `keep` newest versions; their manifest rows stay as history."""
        last = self.version() - keep
        for r in self.manifest().where(F.col("version") <= last).select("folder").distinct().collect():
            remove(self.spark, f"{self.path}/{r['folder']}")
