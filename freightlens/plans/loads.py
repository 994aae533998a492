"""A load into tables that last: cleaned, staged by batch, dimensions versioned, fact by batch, every step gated and logged.

Below the target's folder lie `staging` and `fact_order_item`, partitioned by load batch and order month, the dimensions as versions with a
manifest, and `etl_run_log`. A step's gate raises before the step after it begins; what has been written by then is the batch's
own partitions, which the next attempt replaces, while the dimensions stay at the version before.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.operators import cleaning
from freightlens.plans import dims, facts, profiling, quality, staging, star_checks
from freightlens.plans.warehouse import Warehouse
from freightlens.schemas import FACT_FIELDS, READY_FIELDS
from freightlens.sources.sinks import RunLog, fact_message, staging_message
from freightlens.sources.stores import BatchTable, VersionedTables

MONTH = "order_month_key"  # of the fact: yyyyMM of the order date, 0 if unknown


class LoadStopped(ValueError):
    """A gate found that a load must not go on."""


class Target:
    """The tables of a warehouse below one folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.staging = BatchTable(spark, f"{self.path}/staging", {**staging.LAYOUT, "_slot": "bigint"}, "load_batch_id", "order_year_month")
        self.fact = BatchTable(spark, f"{self.path}/fact_order_item", {**FACT_FIELDS, MONTH: "int"}, "load_batch_id", MONTH)
        self.dimensions = VersionedTables(spark, f"{self.path}/dimensions")
        self.log = RunLog(spark, f"{self.path}/etl_run_log")

    def latest_batch(self) -> str | None:
        """Tag of the batch loaded last into the fact. Tags sort by time; the folders hold them, so no column is read."""
        return self.fact.read().agg(F.max("load_batch_id")).first()[0]


def _staged(target: Target, tag: str) -> DataFrame:
    return staging.number_rows(target.staging.of_batch(tag))


def run_load(
    target: Target,
    items: DataFrame,
    source_file_name: str,
    loaded_at: datetime | None = None,
    expected_rows: int | None = None,
    minimum_rows: int = 1,
    replace: bool = False,
    clock: Callable[[], datetime] | None = None,
) -> str:
    """Load typed items as one batch and return its tag.

    `expected_rows` is compared with what arrives; by default it is the number of distinct item ids of the source. A batch that differs ends in
    WARNING and goes on; one that is NOT READY (below `minimum_rows`, with copies of an item or without a required id) stops
    before the dimensions. A batch that the fact holds already is only loaded again with `replace`.
    """
    spark = target.spark
    clock = clock or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))
    w = Warehouse(spark, items, source_file_name, loaded_at or clock(), expected_rows)
    tag = staging.batch_tag(w.loaded_at)

    with target.log.step("clean_order_items", source_file_name, clock) as step:
        step.read, step.inserted = w.cleaning_counts["read"], w.cleaning_counts["kept"]
        step.rejected = step.read - step.inserted
        profiling.require_clean(w.clean)

    with target.log.step("load_staging_csv", source_file_name, clock) as step:
        cuts = staging.sales_tier_cuts(w.clean)
        items = staging.with_totals_by_month(w.slotted, w.customer_totals)
        whole = lambda df: staging.staged(staging.finished(df, cuts), w.loaded_at, source_file_name)
        step.read = w.cleaning_counts["kept"]
        step.inserted = target.staging.replace(tag, items, numbered="_slot", finish=whole, dealt=True)
        step.rejected = step.read - step.inserted
        batch = target.staging.of_batch(tag)
        check = quality.load_check(batch, w.expected).first()
        step.status = check["load_status"]
        step.message = None if step.status == "SUCCESS" else staging_message(check)
        verdict = quality.readiness(batch, w.expected, minimum_rows).first()
        if verdict["final_data_readiness"] == "NOT READY":
            raise LoadStopped(f"staged batch is not ready: {_faults(verdict.asDict())}")

    with target.log.step("load_dimensions", source_file_name, clock) as step:
        rows = target.staging.of_batch(tag).select(*READY_FIELDS)
        current = target.dimensions.tables()
        plans = {n: lambda n=n: dims.next_version(w.workspace, n, rows, w.loaded_at, current.get(n)) for n in dims.DIMENSIONS}
        step.read = check["total_rows"]
        target.dimensions.publish(plans, w.loaded_at, check=lambda tables: star_checks.require_resolved(rows, tables))
        tables = target.dimensions.tables()
        step.inserted = sum(t.where(F.col("created_at") == F.lit(w.loaded_at.isoformat(sep=" ")).cast("timestamp_ntz")).count() for t in tables.values())

    with target.log.step("load_fact_order_item", source_file_name, clock) as step:
        held = star_checks.empty_before_load(target.fact.of_batch(tag)).first()
        if held["fact_rows"] and not replace:
            raise LoadStopped(f"the fact already holds {held['fact_rows']} rows of batch {tag}")
        built = facts.fact_by_month(_staged(target, tag), tables, w.loaded_at)
        step.read = check["total_rows"]
        step.inserted = target.fact.replace(tag, built.withColumn(MONTH, F.expr("order_date_key div 100").cast("int")), dealt=True)
        step.rejected = step.read - step.inserted
        found = star_checks.load_status(target.fact.of_batch(tag), w.expected).first()
        step.status = found["etl_status"]
        step.message = None if step.status == "SUCCESS" else fact_message(found)
        if step.status == "FAILED":
            raise LoadStopped(step.message)
    return tag


def _faults(verdict: dict) -> str:
    return "; ".join(f"{k}={v}" for k, v in verdict.items() if k != "final_data_readiness")


def open_warehouse(target: Target, batch: str | None = None, version: int | None = None) -> Warehouse:
    """The stored tables of a batch, the last one by default, for views and checks. Dimensions are the current ones or an earlier version."""
    tag = batch or target.latest_batch()
    stored = target.staging.of_batch(tag)
    w = Warehouse(target.spark)
    w.__dict__.update(  # where cached_property looks first
        stored=stored, dims=target.dimensions.tables(version), fact=target.fact.of_batch(tag).drop(MONTH),
        expected=stored.agg(F.count_distinct(cleaning.KEY)).first()[0],
    )
    return w
