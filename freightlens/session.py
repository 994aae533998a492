"""Session defaults and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


# The JVM does not compile methods above 8000 bytes of bytecode. Plans over the wide item rows generate longer
# ones; with this limit Spark splits them instead of running them interpreted.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")


def get_session(app_name: str = "freightlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(*HUGE_METHOD)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a machine-local one is accepted in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="freightlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs inside, then as before."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Workspace:
    """Parquet tables of one run, below the shared folder. Each table is written once and then read back."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        spark.conf.set(*HUGE_METHOD)
        self.root = root or "/".join(
            [shared_folder(spark), "freightlens", spark.sparkContext.applicationId, uuid.uuid4().hex[:12]]
        )

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def fresh(self, stem: str) -> str:
        return f"{stem}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def observed(observation: Observation, **absent) -> dict:
    """The metrics of a finished job, or `absent` where the optimiser found the plan to be empty and left them out."""
    try:
        return observation.get
    except Py4JJavaError:
        return absent
