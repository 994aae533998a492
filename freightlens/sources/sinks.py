"""Output: CSV folders with read-back, report folders, and the run log."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from freightlens.schemas import READY_HEADERS, RUN_LOG, conform, fields
from freightlens.session import Workspace
from freightlens.sources.csv import STAGED_NAMES, inspect

PIPELINE = "supply_chain_pipeline"
MESSAGE_LIMIT = 1000
FILE_ROWS = 500_000


def as_text(df: DataFrame, digits: int = 4) -> DataFrame:
    """Time stamps as `yyyy-MM-dd HH:mm:ss`, fractions rounded, everything else unchanged."""
    columns = []
    for name, kind in df.dtypes:
        column: Column = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal") or kind in ("float", "double"):
            column = F.round(column, digits)
        columns.append(column.alias(name))
    return df.select(*columns)


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> str:
    """Text comes back as it was: blanks are kept, an empty text is written in quotes and NULL without.

    Items take a tenth of the room as gzip. Such a file has one reader, so that it holds FILE_ROWS at most.
    """
    writer = df.write.mode("errorifexists").option("header", True).option("escape", '"').option("emptyValue", '""').option("nullValue", "")
    writer = writer.option("compression", compression).option("maxRecordsPerFile", FILE_ROWS)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def export(df: DataFrame, path: str) -> str:
    return write_csv(as_text(df), path)


def export_ready(ready: DataFrame, path: str) -> str:
    """The 85-column analytics-ready file."""
    named = ready.select(
        *[
            F.col(STAGED_NAMES.get(h, h)).alias(h) if STAGED_NAMES.get(h, h) in ready.columns else F.lit(None).cast("string").alias(h)
            for h in READY_HEADERS
        ]
    )
    return export(named, path)


def count_exported(ws: Workspace, path: str) -> int:
    """Records, not lines, of an exported folder."""
    _, multi_line = inspect(ws.spark, path)
    reader = ws.spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    return reader.csv(path).count()


def read_back(ws: Workspace, path: str, expected: int) -> DataFrame:
    exported = count_exported(ws, path)
    rows = [(expected, exported, exported == expected)]
    return ws.spark.createDataFrame(rows, "expected_rows bigint, exported_rows bigint, complete boolean")


def require_complete(ws: Workspace, path: str, expected: int) -> None:
    exported = count_exported(ws, path)
    if exported != expected:
        raise ValueError(f"export is truncated: {exported} of {expected} rows")


def write_reports(reports: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV folder per report, as plain text."""
    return {name: write_csv(as_text(df), f"{folder}/{name}", "none") for name, df in reports.items()}


@dataclass
class Outcome:
    """What a step has done so far."""

    status: str = "SUCCESS"
    read: int = 0
    inserted: int = 0
    rejected: int = 0
    message: str | None = None


class RunLog:
    """Append-only audit log. A run appends a STARTED row and later a final one; the newest row counts."""

    def __init__(self, spark: SparkSession, path: str, pipeline: str = PIPELINE):
        self.spark, self.path, self.pipeline = spark, path, pipeline

    def _append(self, **values) -> None:
        row = self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        log = conform(row, {**fields(RUN_LOG), "event_no": "int"})
        log.coalesce(1).write.mode("append").parquet(self.path)

    def start(self, process: str, source_file: str, at: datetime) -> dict:
        run = {
            "etl_run_id": uuid.uuid4().hex, "pipeline_name": self.pipeline, "process_name": process,
            "source_file_name": source_file, "started_at": at.isoformat(sep=" "),
        }
        self._append(**run, process_status="STARTED", event_no=0)
        return run

    def finish(
        self, run: dict, status: str, read: int, inserted: int, rejected: int, at: datetime, message: str | None = None
    ) -> None:
        if status not in ("SUCCESS", "WARNING", "FAILED"):
            raise ValueError(f"not a final status: {status}")
        self._append(
            **run, process_status=status, rows_read=read, rows_inserted=inserted, rows_rejected=rejected,
            completed_at=at.isoformat(sep=" "), error_message=message, event_no=1,
        )

    @contextmanager
    def step(self, process: str, source_file: str, clock: Callable[[], datetime]) -> Iterator[Outcome]:
        """Log a step as STARTED, run it, and log the outcome it filled in; FAILED, with the reason, if it raises."""
        run, outcome = self.start(process, source_file, clock()), Outcome()
        try:
            yield outcome
        except Exception as error:
            reason = str(error).strip().split("\n")[0][:MESSAGE_LIMIT]
            self.finish(run, "FAILED", outcome.read, outcome.inserted, outcome.rejected, clock(), reason)
            raise
        self.finish(run, outcome.status, outcome.read, outcome.inserted, outcome.rejected, clock(), outcome.message)

    def runs(self) -> DataFrame:
        """Current state of every run."""
        schema = ", ".join(f"{c} {t}" for c, t in {**fields(RUN_LOG), "event_no": "int"}.items())
        events = self.spark.read.schema(schema).parquet(self.path)
        latest = F.max_by(F.struct(*fields(RUN_LOG)), "event_no").alias("run")
        return events.groupBy(F.col("etl_run_id").alias("_id")).agg(latest).select("run.*")


def staging_message(found: Row) -> str:
    return (
        f"Rows={found['total_rows']}; duplicates={found['duplicate_rows']}; "
        f"valid_order_dates={found['valid_order_dates']}; valid_shipping_dates={found['valid_shipping_dates']}"
    )


def fact_message(found: Row) -> str:
    return (
        f"fact_rows={found['fact_rows']}; unique_order_items={found['unique_order_item_ids']}; "
        f"duplicate_rows={found['duplicate_rows']}; rows_with_unknown_dimension_key={found['rows_with_unknown_dimension_key']}"
    )
