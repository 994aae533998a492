"""Every query by name, as a function of (session, folder of the input tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions import dates, features
from freightlens.operators import cleaning
from freightlens.plans import (
    dims, eda, feature_reports, loads, profiling, quality, questions, sketches, staging, star_checks, validation, views,
)
from freightlens.plans.warehouse import Warehouse
from freightlens.schemas import CLEAN_FIELDS, conform
from freightlens.sources import csv, sinks
from freightlens.sources.tables import order_items, raw_order_items

Query = Callable[[SparkSession, str], DataFrame]

# A fixed load time keeps batch tags and time stamps reproducible.
LOADED_AT = datetime(2024, 1, 1)

_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """One load per application and input folder; its tables are written on first use and shared by all queries."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(
            spark, order_items(spark, folder), loaded_at=LOADED_AT, raw=raw_order_items(spark, folder)
        )
    return _warehouses[key]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as bigint, dates and time stamps as text, for comparison across engines."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(name))
    return df.select(*columns)


def _over_warehouse(plan: Callable[[Warehouse], DataFrame], drop: tuple[str, ...] = ()) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(plan(warehouse(spark, folder)).drop(*drop))

    query.__doc__ = plan.__doc__
    return query


QUERIES: dict[str, Query] = {}


def _add(name: str, plan: Callable[[Warehouse], DataFrame], drop: tuple[str, ...] = ()) -> None:
    QUERIES[name] = _over_warehouse(plan, drop)


for _name, _plan in views.VIEWS.items():
    _add("vw_order_item_detail" if _name == "vw_tableau_order_item_detail" else _name, _plan)
_add("vw_row_counts", views.view_row_counts)
_add("vw_samples", views.view_samples)
_add("idx_category_perf", views.category_mean_margin)
for _name, _plan in questions.QUESTIONS.items():
    # row numbers follow the order in which tasks wrote the rows
    _add(_name, _plan, drop=("staging_row_id",) if _name == "a1_q01" else ())

_STAGED = {
    "dq_01_latest_batch": quality.batch_overview,
    "dq_03_completeness": quality.completeness,
    "dq_05_dates": quality.dates,
    "dq_06_numeric_rules": quality.numeric_rules,
    "dq_07_discount_rate": quality.discount_rates,
    "dq_08_geo_range": quality.coordinates,
    "dq_09_shipping_features": quality.shipping_features,
    "dq_10_financial_features": quality.financial_features,
    "dq_11_binary_fields": quality.binary_fields,
    "dq_12_domains": quality.domains,
    "dq_14_reconciliation": quality.business_summary,
}
for _name, _check in _STAGED.items():
    _add(_name, lambda w, check=_check: check(w.latest))
_add("dq_13_problem_rows", lambda w: quality.problem_rows(staging.latest_batch(w.staging)), drop=("staging_row_id",))
_add("dq_02_volume_unique", lambda w: quality.volume_and_uniqueness(w.latest, w.expected))
# before one row per key is kept, so that there is something to find
_add("dq_04_duplicate_keys", lambda w: quality.duplicate_keys(w.items))
_add("dq_15_readiness", lambda w: quality.readiness(w.latest, w.expected, w.expected))
_add("dq_load_check", lambda w: quality.load_check(w.latest, w.expected))


def _profile(plan: Callable[[DataFrame], DataFrame]) -> Query:
    """Over the raw columns with their numbers typed."""
    return _over_warehouse(lambda w: plan(w.raw))


QUERIES |= {
    "prof_overview": _profile(profiling.overview),
    "prof_schema": _profile(profiling.schema_report),
    "prof_missing": _profile(profiling.missing_report),
    "prof_keys": _profile(profiling.key_report),
    "prof_numeric": _profile(profiling.numeric_report),
    "prof_histogram": _profile(profiling.histogram),
    "prof_categorical": _profile(profiling.categorical_report),
    "prof_value_counts": _profile(profiling.value_counts),
    "prof_dates": _profile(profiling.date_report),
    "prof_outliers_iqr": _profile(lambda df: profiling.outlier_report(df, profiling.RAW_OUTLIER_COLUMNS)),
    "prof_business_rules": _profile(profiling.business_rules),
    "prof_quality_score": _profile(profiling.quality_score),
}


def _sketched_in_two_batches(w: Warehouse) -> DataFrame:
    """Stored sketches of the quickly and the slowly shipped rows, merged."""
    store = sketches.SketchStore(w.spark, w.workspace.path(w.workspace.fresh("sketches")))
    quick = F.coalesce(F.col("Days for shipping (real)") <= 3, F.lit(False))
    store.add("quick", w.raw.where(quick))
    store.add("slow", w.raw.where(~quick))
    return store.read()


def _approximate_schema(w: Warehouse) -> DataFrame:
    """The exact figures, and whether the estimated distinct values are within the stated bound of the exact ones."""
    exact = profiling.schema_report(w.raw).select(F.col("column").alias("of"), "unique_count")
    found = sketches.approximate_schema(_sketched_in_two_batches(w)).join(exact, F.col("column") == F.col("of"))
    near = F.abs(F.col("unique_estimate") - F.col("unique_count")) <= F.col("unique_count") * sketches.DISTINCT_ERROR
    return found.withColumn("within_bound", near).drop("of", "unique_count", "unique_estimate")


def _approximate_numbers(w: Warehouse) -> DataFrame:
    """The exact figures, and whether all estimated percentiles are within the stated bound of their ranks."""
    found = sketches.approximate_numbers(_sketched_in_two_batches(w))
    errors = sketches.rank_errors(w.raw, found).select(F.col("column").alias("of"), "rank_error")
    kept = [c for c in found.columns if not c.startswith("p")]
    near = F.coalesce(F.col("rank_error"), F.lit(0.0)) <= sketches.RANK_ERROR
    return found.join(F.broadcast(errors), F.col("column") == F.col("of"), "left").select(*kept, near.alias("within_bound"))


_add("prof_schema_approx", _approximate_schema)
_add("prof_numeric_approx", _approximate_numbers)
_add("clean_rules", lambda w: profiling.clean_rules(w.clean))
_add("clean_score", lambda w: profiling.clean_score(cleaning.drop_empty_columns(w.clean)))

_EXPLORED = {
    "eda_top": lambda df: eda.top(df, "product_name"),
    "eda_kpis": eda.kpis,
    "eda_monthly": eda.monthly,
    "eda_market_tables": eda.market_tables,
    "eda_product_tables": eda.product_tables,
    "eda_loss_tables": eda.loss_tables,
    "eda_customer_tables": eda.customer_tables,
    "eda_shipping": eda.shipping_modes,
    "eda_delivery_status": eda.delivery_statuses,
    "eda_late_pivot": eda.late_pivot,
    "eda_sample": eda.sample,
    "eda_correlation": eda.correlations,
    "eda_geo_tables": eda.geo_tables,
    "eda_geo_points": eda.geo_points,
    "eda_risk_summary": eda.risk_summary,
    "eda_priority_category": eda.priority_categories,
    "eda_insights": eda.insights,
    "eda_outliers": lambda df: profiling.outlier_report(df, eda.OUTLIER_COLUMNS, of_all_rows=True),
}
for _name, _table in _EXPLORED.items():
    _add(_name, lambda w, table=_table: table(w.ready))



def _odd_labels(w: Warehouse) -> DataFrame:
    """Ready items whose labels are spoilt where the payment was returned."""
    returned = F.col("payment_type") == "R"
    return w.ready.withColumns(
        {
            "delivery_performance": F.when(returned, F.concat(F.lit("odd "), "market")).otherwise(F.col("delivery_performance")),
            "profitability_status": F.when(returned & (F.col("market") == "ASIA"), "odd").otherwise(F.col("profitability_status")),
        }
    )


for _name, _make in validation.CHECKS.items():
    _add(_name, lambda w, make=_make: validation.report(w.ready, make(w.ready)))
_add("val_domains", lambda w: validation.report(w.ready, validation.domain_checks(w.ready, listed=True)))
_add("val_framework", lambda w: w.validation)
_add("val_readiness", lambda w: validation.readiness(w.ready, w.validation))
_add("val_failed_summary", lambda w: validation.failed_checks(w.validation))
_add("val_issue_samples", lambda w: validation.issue_samples(w.ready, w.validation))
_add("val_missing_columns", lambda w: validation.full_report(w.ready.select("order_id", "sales", "latitude", "market", "delivery_performance")))
_add("val_unexpected_values", lambda w: validation.unexpected_values(_odd_labels(w)))
_add("val_quality_profile", lambda w: validation.quality_profile(w.ready, w.workspace))

STAMPS = ("created_at", "updated_at")


def _customers_in_two_loads(w: Warehouse) -> DataFrame:
    """Customers with an order before 1996 load first, all customers second; keys given out first stay."""
    first = dims.load_dimension(w.workspace, "dim_customer", w.customer_rows(w.latest.where("order_year < 1996")), w.loaded_at)
    return dims.load_dimension(w.workspace, "dim_customer", w.customer_rows(w.latest), w.loaded_at, current=first)


for _name in dims.DIMENSIONS:
    _add(f"{_name}_load", lambda w, name=_name: w.dims[name], drop=STAMPS)
_add("dim_upsert", _customers_in_two_loads, drop=STAMPS)
_add("dim_unknown_member", star_checks.unknown_members)
_add("dim_row_counts", star_checks.row_counts)
_add("dim_key_uniqueness", star_checks.key_uniqueness)
_add("dim_resolution", star_checks.resolution)
_add("fact_load", lambda w: w.fact, drop=("staging_row_id",))
_add("fact_load_status", lambda w: star_checks.load_status(w.fact, w.expected))
_add("fact_grain_check", lambda w: star_checks.grain_check(w.fact, w.expected))
_add("fact_unknown_keys", lambda w: star_checks.unknown_keys(w.fact))
_add("fact_orphans", star_checks.orphans)
_add("fact_reconcile", lambda w: star_checks.reconcile(w.latest, w.fact))
_add("fact_summary", lambda w: star_checks.summary(w.fact))
_add("fact_star_sample", star_checks.star_sample)
_add("fact_constraints", star_checks.constraints)


# ---- cleaning steps ------------------------------------------------------------------------------


def _column_names(w: Warehouse) -> DataFrame:
    """Raw and clean name of every column with its filled cells."""
    renamed = cleaning.rename_columns(w.raw_text)
    filled = cleaning.metric_rows(
        renamed.agg(*[F.count(c).alias(c) for c in renamed.columns]), {c: F.col(c) for c in renamed.columns}, "clean", "filled"
    )
    return cleaning.column_mapping(w.raw_text).join(filled, F.col("clean_column") == F.col("clean")).drop("clean")


def _untidy_text(w: Warehouse) -> DataFrame:
    """Raw items whose text holds padding, whitespace runs, blanks and spelled-out missing values."""
    return w.raw_text.select(
        F.col("Order Item Id").alias("order_item_id"),
        F.concat(F.lit("  "), F.replace("Product Name", F.lit(" "), F.lit("  \t ")), F.lit("\n")).alias("product_name"),
        F.lit("   ").alias("order_city"),
        F.lit("nan").alias("order_state"),
        F.concat(F.lit(" None"), F.lit(" ")).alias("customer_state"),
        F.col("Market").alias("market"),
    )


def _three_layouts(w: Warehouse) -> DataFrame:
    """Order dates written in the three accepted layouts and two others, parsed back."""
    d = F.col("order_date")
    texts = {
        "slash": F.date_format(d, "M/d/yyyy H:mm"),
        "stamp": F.date_format(d, "yyyy-MM-dd HH:mm:ss"),
        "day": F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd")),
        "no_such_month": F.date_format(d, "'13'/d/yyyy H:mm"),
        "other": F.date_format(d, "dd.MM.yyyy"),
    }
    return w.items.select("order_item_id", "product_card_id", *[dates.parse_datetime(t).alias(n) for n, t in texts.items()])


def _with_copies(w: Warehouse) -> DataFrame:
    """Cleaned rows, those of returned payments a second time, without exact copies again."""
    ids = w.clean.select("order_item_id", "order_id", "product_card_id", "payment_type", "sales", "order_date")
    return cleaning.drop_exact_duplicates(ids.unionByName(ids.where("payment_type = 'R'")))


def _some_keys_missing(w: Warehouse) -> DataFrame:
    """Items whose key is blanked where the payment was returned, reduced to the ones with a key."""
    keyed = w.items.withColumn("order_item_id", F.when(F.col("payment_type") != "R", F.col("order_item_id")))
    return cleaning.require_key(keyed).select("order_item_id", "order_id", "product_card_id", "payment_type")


PLACES = ["customer_city", "customer_country", "customer_state", "order_city", "order_country", "order_state"]
SHORT = ["order_item_id", "product_card_id"]


def _unknowns(w: Warehouse) -> DataFrame:
    return cleaning.fill_unknown(conform(w.items, CLEAN_FIELDS)).select(*SHORT, *cleaning.FILLED_WITH_UNKNOWN)


def _labels(w: Warehouse) -> DataFrame:
    raw = w.raw_text.select(
        F.col("Order Item Id").alias("order_item_id"), F.col("Delivery Status").alias("delivery_status"), F.col("Shipping Mode").alias("shipping_mode")
    )
    return cleaning.standardise_labels(raw)


def _places(w: Warehouse) -> DataFrame:
    """Place names with the marks that start a new capital."""
    named = w.items.select(
        "order_item_id", "product_card_id",
        F.concat(F.lower("order_country"), F.lit(" o'"), F.lower("market"), F.lit("-"), F.upper("product_name")).alias("order_country"),
        F.lit("Unknown").alias("order_city"),
    )
    return cleaning.title_case_places(named)


def _rounded(w: Warehouse) -> DataFrame:
    thirds = {c: (F.col(c) / 3).cast("decimal(24,10)") for c in ("sales", "order_profit", "product_price")}
    return cleaning.round_amounts(w.items.select(*SHORT, *thirds).withColumns(thirds))


_add("clean_column_names", _column_names)
_add("clean_drop_pii", lambda w: cleaning.drop_personal(cleaning.rename_columns(w.raw_text)))
_add("clean_text", lambda w: cleaning.normalise_text(_untidy_text(w)))
_add("clean_types", lambda w: conform(cleaning.parse_raw(w.raw_text), CLEAN_FIELDS))  # read once, so not landed
_add("clean_parse_dates_3fmt", _three_layouts)
_add("clean_exact_dedup", _with_copies)
_add("clean_key_dedup", lambda w: cleaning.keep_fullest_row(w.items))
_add("clean_drop_all_null_cols", lambda w: cleaning.drop_empty_columns(conform(w.items, CLEAN_FIELDS)))
_add("clean_require_key", _some_keys_missing)
_add("clean_fill_unknown", _unknowns)
_add("clean_labels", _labels)
_add("clean_title_case", _places)
_add("clean_round", _rounded)
_add("clean_audit_log", lambda w: cleaning.audit_log(w.cleaning_counts, w.parsed, len(w.raw_text.columns)))
_add("clean_reconciliation", lambda w: cleaning.reconciliation(w.raw_text, cleaning.drop_empty_columns(w.clean)))
_add("clean_critical_missing", lambda w: cleaning.critical_missing(w.clean))


# ---- features ------------------------------------------------------------------------------------

ITEM = "order_item_id"


def _feature(name: str, *columns: str, after: tuple = ()) -> None:
    """One feature step over the cleaned items; `after` lists the steps it builds on."""
    step = getattr(features, name)

    def plan(w: Warehouse) -> DataFrame:
        df = w.clean
        for earlier in (*after, step):
            df = df.transform(earlier)
        return df.select(ITEM, *columns)

    _add(_FEATURE_NAMES[name], plan)


_FEATURE_NAMES = {
    "add_calendar": "feat_calendar", "add_delay": "feat_delay", "add_delivery_performance": "feat_delivery_performance",
    "add_delivery_flags": "feat_ontime_late_flags", "add_efficiency_ratio": "feat_efficiency_ratio",
    "add_delay_severity": "feat_delay_severity", "add_speed_segment": "feat_speed_segment",
    "add_gross_and_discount": "feat_gross_discount", "add_discount_rate_pct": "feat_discount_rate_pct",
    "add_margin": "feat_margin", "add_profitability": "feat_profitability", "add_margin_band": "feat_margin_band",
    "add_discount_band": "feat_discount_band", "add_attention_flag": "feat_attention_flag", "add_risk_segment": "feat_risk_segment",
}
_feature(
    "add_calendar", "order_year", "order_quarter_number", "order_quarter", "order_month", "order_month_name", "order_year_month",
    "order_week", "order_day", "order_day_name", "is_weekend_order", "order_date_key", "shipping_year_month", "shipping_date_key",
)
_feature("add_delay", "shipping_delay_days", "absolute_schedule_variance_days")
_feature("add_delivery_performance", "delivery_performance", after=(features.add_delay,))
_feature("add_delivery_flags", "is_on_time_delivery", "is_late_delivery", after=(features.add_delay,))
_feature("add_efficiency_ratio", "shipping_efficiency_ratio")
_feature("add_delay_severity", "delivery_delay_severity", after=(features.add_delay,))
_feature("add_speed_segment", "shipping_speed_segment")
_feature("add_gross_and_discount", "gross_sales_before_discount", "discount_pct_calculated")
_feature("add_discount_rate_pct", "discount_rate_pct")
_feature("add_margin", "profit_margin_pct")
_feature("add_profitability", "profitability_status", "is_profitable_item", "is_loss_item")
_feature("add_margin_band", "margin_band")
_feature("add_discount_band", "discount_band", after=(features.add_discount_rate_pct,))
_flags = (features.add_delay, features.add_delivery_flags, features.add_profitability)
_feature("add_attention_flag", "requires_management_attention", after=_flags)
_feature("add_risk_segment", "operational_risk_segment", after=_flags)


def _grouped(w: Warehouse, *columns: str) -> DataFrame:
    slim = w.clean.select(ITEM, "order_id", "customer_id")
    return staging.attach_totals(slim, w.order_totals, w.customer_totals).select(ITEM, *columns)


_add("feat_sales_tier", lambda w: features.add_sales_tier(w.clean.select(ITEM, "sales"), staging.sales_tier_cuts(w.clean)))
_add("feat_order_totals", lambda w: _grouped(w, "order_id", *staging.ORDER_FEATURES))
_add("feat_customer_lifetime", lambda w: _grouped(w, "customer_id", *staging.CUSTOMER_FEATURES))
_add("feat_frequency_segment", lambda w: _grouped(w, "customer_order_count", "customer_frequency_segment"))
_add("feat_dictionary", lambda w: feature_reports.dictionary(w.ready))
_add("feat_validation", lambda w: feature_reports.validation(w.clean, w.ready))
_add("feat_summary", lambda w: feature_reports.summary(w.clean, w.ready))


# ---- sources and sinks ---------------------------------------------------------------------------


def _raw_file(w: Warehouse) -> DataFrame:
    """The raw items written as a CSV file and read again."""
    path = sinks.write_csv(w.raw_text, w.workspace.path(w.workspace.fresh("raw_csv")))
    return csv.read_raw_csv(w.spark, path)


def _ready_file(w: Warehouse) -> str:
    return sinks.export_ready(w.ready, w.workspace.path(w.workspace.fresh("ready_csv")))


def _exported(w: Warehouse) -> DataFrame:
    """The ready items written as CSV and read back, each column in the kind it was written from."""
    shown = sinks.as_text(w.ready)
    path = sinks.export(w.ready, w.workspace.path(w.workspace.fresh("export")))
    read = csv.read_text_csv(w.spark, path, ("utf-8",))
    return read.select(*[F.col(c).cast(t).alias(c) for c, t in shown.dtypes])


def _derived_file(w: Warehouse) -> DataFrame:
    """The analytics-ready file found as the second of two candidate paths."""
    path = _ready_file(w)
    return csv.read_derived_csv(w.spark, [f"{path}-not-there", path])


def _loaded_from_file(w: Warehouse) -> DataFrame:
    return csv.load_staging(w.workspace, _ready_file(w), w.loaded_at, w.source_file_name)


def _rejects(w: Warehouse) -> DataFrame:
    """Cells that do not convert, after dates of returned and sales of pending items were spoilt in the file."""
    spoilt = sinks.as_text(w.ready.withColumnsRenamed({v: k for k, v in csv.STAGED_NAMES.items()})).withColumns(
        {
            "order_date": F.when(F.col("payment_type") == "R", "13/41/2018 22:56").otherwise(F.col("order_date")),
            "sales": F.when(F.col("order_status") == "P", "n/a").otherwise(F.col("sales").cast("string")),
        }
    )
    columns = [F.col(h) if h in spoilt.columns else F.lit(None).cast("string").alias(h) for h in csv.READY_HEADERS]
    path = sinks.write_csv(spoilt.select(*columns), w.workspace.path(w.workspace.fresh("spoilt_csv")))
    return csv.rejected_cells(csv.read_ready_csv(w.spark, path))


def _read_back(w: Warehouse) -> DataFrame:
    return sinks.read_back(w.workspace, _ready_file(w), w.ready.count())


def _reports(w: Warehouse) -> DataFrame:
    """Three report folders written, and the rows found in each."""
    reports = {
        "missing_value_report": profiling.missing_report(profiling.type_numbers(w.raw_text)),  # read once, so not landed
        "cleaning_validation_report": profiling.clean_rules(w.clean),
        "monthly_trend": eda.monthly(w.ready),
    }
    written = sinks.write_reports(reports, w.workspace.path(w.workspace.fresh("reports")))
    rows = [(name, sinks.count_exported(w.workspace, path)) for name, path in written.items()]
    return w.spark.createDataFrame(rows, "report string, row_count bigint")


EARLIER = datetime(2023, 1, 1)
_targets: dict[tuple[str, int], loads.Target] = {}


def _two_loads(w: Warehouse) -> loads.Target:
    """Tables that last after two loads: the items ordered before 1996, then all, a row more being expected of the second."""
    key = (w.spark.sparkContext.applicationId, id(w))
    if key not in _targets:
        target = loads.Target(w.spark, w.workspace.path(w.workspace.fresh("target")))
        early = w.items.where("order_date < timestamp_ntz'1996-01-01'")
        loads.run_load(target, early, "early_items", EARLIER, clock=lambda: EARLIER)
        loads.run_load(target, w.items, w.source_file_name, w.loaded_at, expected_rows=w.expected + 1, clock=lambda: w.loaded_at)
        _targets[key] = target
    return _targets[key]


def _run_log(w: Warehouse) -> DataFrame:
    return _two_loads(w).log.runs().drop("etl_run_id")


def _failed_run_log(w: Warehouse) -> DataFrame:
    """Items of returned payments without a customer: the load stops before the dimensions."""
    target = loads.Target(w.spark, w.workspace.path(w.workspace.fresh("target")))
    defective = w.items.withColumn("customer_id", F.when(F.col("payment_type") != "R", F.col("customer_id")))
    try:
        loads.run_load(target, defective, w.source_file_name, w.loaded_at, clock=lambda: w.loaded_at)
    except loads.LoadStopped:
        pass  # what the log is to show
    return target.log.runs().drop("etl_run_id").withColumn("dimension_versions", F.lit(target.dimensions.version()))


def _fact_partitions(w: Warehouse) -> DataFrame:
    """Rows and sales of every stored batch and month."""
    table = _two_loads(w).fact
    return table.read().groupBy(table.batch, table.month).agg(F.count("*").alias("fact_rows"), F.sum("sales").alias("sales"))


def _fact_of_latest_batch(w: Warehouse) -> DataFrame:
    """Monthly sales of 1997 in the batch loaded last, read from its folders of those months."""
    target = _two_loads(w)
    months = target.fact.of_batch(target.latest_batch()).where(F.col(loads.MONTH).between(199701, 199712))
    return months.groupBy(loads.MONTH).agg(F.count("*").alias("fact_rows"), F.sum("sales").alias("sales"))


def _dimension_versions(w: Warehouse) -> DataFrame:
    """Business members of every table and version, and how many of the first version's keep their key in this one."""
    store, parts = _two_loads(w).dimensions, []
    first = store.tables(1)
    for version in (1, 2):
        for name, table in store.tables(version).items():
            d = dims.DIMENSIONS[name]
            members = table.where(F.col(d.key) != 0).select(d.natural, d.key)
            kept = first[name].where(F.col(d.key) != 0).select(d.natural, d.key).join(members, [d.natural, d.key], "left_semi")
            parts.append(members.agg(F.count("*").alias("members")).select(
                F.lit(version).alias("version"), F.lit(name).alias("table_name"), "members", kept.agg(F.count("*")).scalar().alias("kept_keys")
            ))
    return reduce(DataFrame.unionByName, parts)


def _batch_tags(w: Warehouse) -> DataFrame:
    return w.stored.groupBy("loaded_at").agg(F.max("load_batch_id").alias("load_batch_id"), F.count("*").alias("rows"))


def _two_batches(w: Warehouse) -> DataFrame:
    """An older batch of the orders before 1998 below the current one; only the newer one is left."""
    older = w.stored.where("order_year < 1998").withColumns(
        {"load_batch_id": F.lit("DATACO_20230101_000000_000000"), "loaded_at": F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")}
    )
    newest = staging.latest_batch(w.stored.unionByName(older))
    return newest.groupBy("load_batch_id", "loaded_at").agg(F.count("*").alias("rows"))


_add("src_csv_raw", _raw_file)
_add("src_csv_clean", _derived_file)
_add("src_staging_load", _loaded_from_file, drop=("staging_row_id",))
_add("src_reject_rows", _rejects)
_add("sink_csv", _exported)
_add("sink_readback", _read_back)
_add("sink_reports", _reports)
_add("etl_run_log", _run_log)
_add("etl_run_log_failed", _failed_run_log)
_add("fact_partitions", _fact_partitions)
_add("fact_latest_batch", _fact_of_latest_batch)
_add("dim_versions", _dimension_versions)
_add("load_batch_id", _batch_tags)
_add("latest_batch", _two_batches)
_add("dq_load_sample", lambda w: quality.load_sample(staging.latest_batch(w.staging)))
