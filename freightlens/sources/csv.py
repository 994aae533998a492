"""CSV input: raw and derived files as text columns, and the typed staging load with its rejects."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions import features
from freightlens.functions.dates import parse_datetime
from freightlens.functions.text import blank_to_null
from freightlens.operators.cleaning import typed
from freightlens.plans.staging import number_rows, store
from freightlens.schemas import READY_FIELDS, READY_HEADERS
from freightlens.session import Workspace

# Spark's names for the accepted encodings. ISO-8859-1 decodes any bytes; cp1252 is read as it and then corrected.
CHARSETS = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1", "cp1252": "ISO-8859-1"}
STAGED_NAMES = {"days_for_shipping": "days_for_shipping_real", "days_for_shipment": "days_for_shipment_scheduled"}
# Customer dates come in two layouts only, without the bare date.
STAMPS_ONLY = ("customer_first_order_date", "customer_last_order_date")


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    for path in paths:
        try:
            spark.read.text(path)
            return path
        except AnalysisException:
            continue
    raise FileNotFoundError(f"none of these exist: {list(paths)}")


def inspect(spark: SparkSession, path: str) -> tuple[bool, bool]:
    """Whether the file is valid UTF-8, and whether a quoted field may run over a line end.

    One distributed scan of the lines. It lets files without multi-line fields be split across tasks.
    """
    lines = spark.read.text(path)
    quotes = F.length(F.regexp_replace("value", '[^"]', ""))
    found = lines.agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(quotes % 2 == 1).alias("open")).first()
    return found["utf8"] is not False, bool(found["open"])


def _as_cp1252(df: DataFrame) -> DataFrame:
    """Text decoded as ISO-8859-1 as it reads in cp1252: the bytes 0x80 to 0x9F are letters and signs there, but for five that stay controls."""
    signs = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    signs = {latin: sign for latin, sign in signs.items() if sign}
    table = str.maketrans(signs)
    names = [c.translate(table) for c in df.columns]
    return df.select(*[F.translate(F.col(f"`{c}`"), "".join(signs), "".join(signs.values())).alias(n) for c, n in zip(df.columns, names)])


def read_text_csv(spark: SparkSession, path: str, encodings: Sequence[str] = ("latin-1",)) -> DataFrame:
    """All columns as text, decoded with the first encoding that fits."""
    valid_utf8, multi_line = inspect(spark, path)
    encoding = next((e for e in encodings if e != "utf-8" or valid_utf8), "latin-1")
    df = (
        spark.read.option("header", True)
        .option("encoding", CHARSETS[encoding])
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return _as_cp1252(df) if encoding == "cp1252" else df


def read_raw_csv(spark: SparkSession, path: str, encodings: Sequence[str] = ("latin-1", "utf-8", "cp1252")) -> DataFrame:
    """The first encoding decides as long as it is latin-1 or cp1252, which decode any file."""
    return read_text_csv(spark, path, encodings)


def read_derived_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return read_text_csv(spark, first_existing(spark, paths), ("utf-8", "latin-1"))


# ---- staging load --------------------------------------------------------------------------------


def read_ready_csv(spark: SparkSession, path: str) -> DataFrame:
    """The 85 columns by position as trimmed text, blanks as NULL, plus the line of a malformed record."""
    _, multi_line = inspect(spark, path)
    schema = ", ".join(f"`{h}` string" for h in [*READY_HEADERS, "_malformed"])
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_malformed")
        .option("columnPruning", False)  # a pruned parse would not see surplus fields
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    trimmed = {h: blank_to_null(F.regexp_replace(h, r"\r$", "")) for h in READY_HEADERS}
    return lines.withColumns(trimmed).withColumnsRenamed(STAGED_NAMES)


def _converted(column: str) -> Column:
    kind = READY_FIELDS[column]
    if kind == "timestamp_ntz":
        return parse_datetime(F.col(column), date_only=column not in STAMPS_ONLY)
    return typed(F.col(column), kind)


def stored_columns(lines: DataFrame) -> list[str]:
    """Columns of the file that staging keeps; the order ZIP code is read and dropped."""
    return [c for c in lines.columns if c in READY_FIELDS]


def convert(lines: DataFrame) -> DataFrame:
    """Text to staging types; the delivery features the file lacks are derived. What does not convert is NULL."""
    items = lines.select(*[_converted(c).alias(c) for c in stored_columns(lines)])
    late = F.col("_late")
    derived = items.withColumnRenamed("is_late_delivery", "_late")
    for step in (
        features.add_delay, features.add_delivery_performance, features.add_delivery_flags,
        features.add_efficiency_ratio, features.add_delay_severity, features.add_speed_segment,
    ):
        derived = derived.transform(step)
    return derived.withColumn("is_late_delivery", late).drop("_late")


def rejected_cells(lines: DataFrame) -> DataFrame:
    """Every cell that holds text but does not convert, and every malformed line: (order_item_id, column, value)."""
    bad = [
        F.when(F.col(c).isNotNull() & _converted(c).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
        for c in stored_columns(lines)
        if READY_FIELDS[c] != "string"
    ]
    malformed = F.when(
        F.col("_malformed").isNotNull(), F.struct(F.lit("_malformed").alias("column"), F.col("_malformed").alias("value"))
    )
    cells = F.array_compact(F.array(*bad, malformed))
    return lines.select("order_item_id", F.explode(cells).alias("c")).select("order_item_id", "c.*")


def load_staging(ws: Workspace, path: str, loaded_at: datetime, source_file_name: str) -> DataFrame:
    """Full refresh of staging from an analytics-ready file."""
    return number_rows(store(ws, convert(read_ready_csv(ws.spark, path)), loaded_at, source_file_name))
