"""Cleaning steps on raw order items. Each is DataFrame in, DataFrame out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from freightlens.functions.dates import parse_datetime
from freightlens.functions.numbers import percent, rounded
from freightlens.functions.text import snake_case, squeezed, title_case
from freightlens.operators.rules import exact_copies
from freightlens.schemas import CLEAN_FIELDS, conform
from freightlens.session import Workspace, observed

KEY = "order_item_id"
GROUP = "order_id"  # items of an order lie together where the source is joined by order
SLOT = "_slot"  # place a row is written at: task in the upper bits, position below

# Fixed values.
RENAMED = {
    "type": "payment_type",
    "benefit_per_order": "order_profit",
    "days_for_shipping": "days_for_shipping_real",
    "days_for_shipment": "days_for_shipment_scheduled",
}
PERSONAL_OR_UNUSED = [
    "customer_email", "customer_fname", "customer_lname", "customer_password",
    "customer_street", "product_description", "product_image",
]
FILLED_WITH_UNKNOWN = [
    "delivery_status", "category_name", "customer_city", "customer_country",
    "customer_segment", "customer_state", "department_name", "market",
    "order_city", "order_country", "order_region", "order_state",
    "order_status", "product_name", "shipping_mode", "payment_type",
]
CRITICAL = [
    "order_item_id", "order_id", "customer_id", "product_card_id",
    "order_date", "sales", "order_item_quantity", "order_item_product_price",
]
DELIVERY_LABELS = {
    "Advance shipping": "Advance Shipping",
    "Late delivery": "Late Delivery",
    "Shipping canceled": "Shipping Canceled",
    "Shipping on time": "Shipping On Time",
}
TITLE_CASED = [
    "customer_city", "customer_country", "customer_state", "order_city", "order_country", "order_state",
]
ROUNDED = [
    "order_profit", "sales_per_customer", "order_item_discount", "order_item_discount_rate",
    "order_item_product_price", "order_item_profit_ratio", "sales", "order_item_total",
    "order_profit_per_order", "product_price", "profit_margin_pct", "gross_sales_before_discount",
]


def clean_name(raw: str) -> str:
    name = snake_case(raw)
    return RENAMED.get(name, name)


def rename_columns(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names collide after cleaning: {repeated}")
    return df.toDF(*names)


def column_mapping(df: DataFrame) -> DataFrame:
    rows = [(c, clean_name(c)) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "raw_column string, clean_column string")


def drop_personal(df: DataFrame) -> DataFrame:
    return df.drop(*PERSONAL_OR_UNUSED)


def normalise_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: squeezed(F.col(c)) for c, t in df.dtypes if t == "string"})


def typed(text: Column, target: str) -> Column:
    """Text to the target type, NULL where it does not parse. '3.0' is an integer, '3.5' is not."""
    if target == "timestamp_ntz":
        return parse_datetime(text)
    if target in ("int", "bigint"):
        return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.0*$", "")).otherwise(text).try_cast(target)
    if target.startswith("decimal"):
        return text.try_cast(target)
    return text


def cast_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: typed(F.col(c), CLEAN_FIELDS[c]) for c, t in df.dtypes if t == "string" and CLEAN_FIELDS.get(c, t) != t}
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def filled_cells(df: DataFrame) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in df.columns])


def keep_fullest_row(df: DataFrame, key: str = KEY, within: Sequence[str] = ()) -> DataFrame:
    """One row per key, in each group of the `within` columns if any: the one with most filled cells, the smallest row on a tie.

    Filtering on row number 1 lets Spark keep a single candidate per key in every task before the
    shuffle, so a key with very many copies does not travel to one task.
    """
    best_first = Window.partitionBy(*within, key).orderBy(F.desc("_filled"), *[F.asc_nulls_first(c) for c in df.columns])
    return (
        df.withColumn("_filled", filled_cells(df))
        .withColumn("_place", F.row_number().over(best_first))
        .where("_place = 1")
        .drop("_filled", "_place")
    )


def empty_columns(df: DataFrame) -> list[str]:
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if filled[c] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    return df.drop(*empty_columns(df))


def require_key(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def fill_unknown(df: DataFrame) -> DataFrame:
    return df.fillna("Unknown", [c for c in FILLED_WITH_UNKNOWN if c in df.columns])


def standardise_labels(df: DataFrame) -> DataFrame:
    return df.replace(DELIVERY_LABELS, subset=["delivery_status"]) if "delivery_status" in df.columns else df


def title_case_places(df: DataFrame) -> DataFrame:
    return df.withColumns({c: title_case(F.col(c)) for c in TITLE_CASED if c in df.columns})


def round_amounts(df: DataFrame, digits: int = 4) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.round(c, digits).cast(kinds[c]) for c in ROUNDED if c in df.columns})


def polish(df: DataFrame) -> DataFrame:
    """The steps that follow deduplication and need no shuffle."""
    return df.transform(fill_unknown).transform(standardise_labels).transform(title_case_places).transform(round_amounts)


def parse_raw(raw: DataFrame) -> DataFrame:
    """The steps that precede deduplication."""
    return raw.transform(rename_columns).transform(drop_personal).transform(normalise_text).transform(cast_types)


def clean_items(items: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Typed items to the cleaned layout. The key filter comes first as it commutes with keeping one row
    per key; exact copies share their key, so the per-key step removes them as well."""
    single = keep_fullest_row(require_key(items), within=within)
    return conform(single.transform(polish), CLEAN_FIELDS)


def clean_raw(raw: DataFrame) -> DataFrame:
    return clean_items(drop_empty_columns(parse_raw(raw)))


def critical_missing(df: DataFrame) -> DataFrame:
    present = [c for c in CRITICAL if c in df.columns]
    counts = df.agg(F.count("*").alias("n"), *[(F.count("*") - F.count(c)).alias(c) for c in present])
    return counts.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_count")) for c in present])).alias("r"), "n"
    ).select("r.*", rounded(percent(F.col("r.missing_count"), F.col("n")), 4).cast("double").alias("missing_pct"))


def clean_and_count(ws: Workspace, items: DataFrame, name: str) -> tuple[DataFrame, dict[str, int]]:
    """Write the cleaned items, each with the SLOT it is written at; rows read, rows without a key and rows kept are counted by the very job that writes them.

    Copies of a key are looked for within their order first, where the source has them together, so that the wide rows are not
    shuffled for it. If the ids written, which alone are shuffled, show a key under several orders, all is done again by key.
    """
    if GROUP in items.columns:
        clean, counted = _write_clean(ws, items, name, (GROUP,))
        if clean.groupBy(KEY).count().where("count > 1").isEmpty():
            return clean, counted
        ws.drop(name)
    return _write_clean(ws, items, f"{name}_by_key", ())


def _write_clean(ws: Workspace, items: DataFrame, name: str, within: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    before, after = Observation(f"{name} in"), Observation(f"{name} out")
    key = F.col(KEY)
    seen = items.observe(before, F.count("*").alias("read"), (F.count("*") - F.count(key)).alias("keyless"))
    clean = clean_items(seen, within).observe(after, F.count("*").alias("kept"))
    clean = ws.write(clean.withColumn(SLOT, F.monotonically_increasing_id()), name)
    return clean, {**observed(before, read=0, keyless=0), **observed(after, kept=0)}


def audit_log(counted: dict[str, int], parsed: DataFrame, raw_columns: int) -> DataFrame:
    """Rows and columns before and after every cleaning step, with a note.

    `counted` comes from the cleaning that ran (clean_and_count); the job drops exact copies with the other rows of their key, so their
    number alone is looked up, by fingerprints, in the stored rows before deduplication.
    """
    spark, kept = parsed.sparkSession, len(parsed.columns)
    empty = empty_columns(parsed)
    full = kept - len(empty)
    single = counted["kept"] + (counted["keyless"] > 0)  # rows without a key are one key until they go
    counts = spark.range(1).select(
        F.lit(counted["read"]).alias("read"), (F.lit(counted["read"]) - exact_copies(parsed)).alias("distinct"),
        F.lit(single).alias("single"), F.lit(counted["kept"]).alias("keyed"),
    )
    copies = F.concat((F.col("read") - F.col("distinct")).cast("string"), F.lit(" exact copies"))
    steps = [
        ("load_raw_data", "read", "read", raw_columns, raw_columns, "rows as read"),
        ("standardize_column_names", "read", "read", raw_columns, raw_columns, "names in snake case"),
        ("drop_pii_and_unused_columns", "read", "read", raw_columns, kept, f"without {', '.join(PERSONAL_OR_UNUSED)}"),
        ("normalize_text", "read", "read", kept, kept, "white space collapsed, blanks set to NULL"),
        ("standardize_data_types", "read", "read", kept, kept, "dates and numbers parsed"),
        ("remove_exact_duplicates", "read", "distinct", kept, kept, copies),
        ("deduplicate_order_item_id", "distinct", "single", kept, kept, "the fullest row of each key"),
        ("drop_all_missing_columns", "single", "single", kept, full, f"without {', '.join(empty) or 'any'}"),
        ("remove_missing_primary_key", "single", "keyed", full, full, f"{counted['keyless']} rows had no key"),
        ("handle_missing_values", "keyed", "keyed", full, full, "Unknown filled into the text dimensions"),
        ("standardize_categories", "keyed", "keyed", full, full, "one spelling per label"),
    ]
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(step).alias("step"),
                F.col(before).cast("bigint").alias("rows_before"),
                F.col(after).cast("bigint").alias("rows_after"),
                (F.col(before) - F.col(after)).cast("bigint").alias("rows_removed"),
                F.lit(cols_before).alias("columns_before"),
                F.lit(cols_after).alias("columns_after"),
                (note if isinstance(note, Column) else F.lit(note)).alias("note"),
            )
            for i, (step, before, after, cols_before, cols_after, note) in enumerate(steps, 1)
        ]
    )
    return counts.select(F.explode(entries).alias("e")).select("e.*")


def reconciliation(raw: DataFrame, clean: DataFrame) -> DataFrame:
    raw_rows = raw.agg(F.count("*").alias("n")).scalar()
    counts = clean.agg(F.count("*").alias("clean_rows")).select(raw_rows.alias("raw_rows"), "clean_rows")
    removed = F.col("raw_rows") - F.col("clean_rows")
    kept = rounded(percent(F.col("clean_rows"), F.col("raw_rows")), 4)
    metrics = {
        "raw_rows": F.col("raw_rows"),
        "clean_rows": F.col("clean_rows"),
        "rows_removed": removed,
        "retention_rate_pct": kept,
        "raw_columns": F.lit(len(raw.columns)),
        "clean_columns": F.lit(len(clean.columns)),
    }
    return metric_rows(counts, metrics)


def metric_rows(one_row: DataFrame, metrics: dict[str, Column], name: str = "metric", value: str = "value") -> DataFrame:
    """A one-row frame turned into (name, value) rows; values become doubles."""
    pairs = [F.struct(F.lit(k).alias(name), v.cast("double").alias(value)) for k, v in metrics.items()]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")
