"""The six dimensions: members taken from staging, upserted under stable surrogate keys."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.functions.dates import date_key, day_name, month_name, year_month
from freightlens.functions.numbers import flag, mean, rounded
from freightlens.operators.ranking import row_number
from freightlens.schemas import conform, fields
from freightlens.session import Workspace

# Fixed values.
RECORD_SOURCE = "DataCo"
SYSTEM_SOURCE = "System"
AUDIT = "record_source string, created_at timestamp_ntz, updated_at timestamp_ntz"


@dataclass(frozen=True)
class Dimension:
    name: str
    key: str
    natural: str
    attributes: str  # layout, natural key first
    unknown: dict[str, str | int]  # the member at key 0; attributes not named are NULL

    @property
    def columns(self) -> list[str]:
        return list(fields(self.attributes))


DIMENSIONS = {
    d.name: d
    for d in [
        Dimension(
            "dim_customer", "customer_key", "customer_id",
            "customer_id bigint, customer_segment string, customer_city string, customer_state string,"
            " customer_country string, customer_zipcode string, customer_order_count int,"
            " customer_lifetime_sales decimal(20,4), customer_average_item_sales decimal(18,4),"
            " customer_lifetime_profit decimal(20,4), customer_first_order_date timestamp_ntz,"
            " customer_last_order_date timestamp_ntz, customer_tenure_days int, customer_frequency_segment string",
            {c: "Unknown" for c in (
                "customer_segment", "customer_city", "customer_state", "customer_country", "customer_zipcode",
                "customer_frequency_segment")},
        ),
        Dimension(
            "dim_category", "category_key", "category_id",
            "category_id int, category_name string, department_id int, department_name string",
            {"category_name": "Unknown", "department_name": "Unknown"},
        ),
        Dimension(
            "dim_product", "product_key", "product_card_id",
            "product_card_id bigint, product_name string, product_price decimal(18,4), product_status int,"
            " product_category_id int, category_name string, department_name string",
            {"product_name": "Unknown", "category_name": "Unknown", "department_name": "Unknown"},
        ),
        Dimension(
            "dim_date", "date_key", "full_date",
            "full_date date, calendar_year int, calendar_quarter int, quarter_name string, calendar_month int,"
            " month_name string, calendar_year_month string, week_of_year int, day_of_month int, day_of_week int,"
            " day_name string, is_weekend int",
            {"quarter_name": "NA", "month_name": "Unknown", "calendar_year_month": "0000-00", "day_name": "Unknown",
             "is_weekend": 0},
        ),
        Dimension(
            "dim_shipping_mode", "shipping_mode_key", "shipping_mode",
            "shipping_mode string, service_level_group string, default_scheduled_days decimal(10,2)",
            {"shipping_mode": "Unknown", "service_level_group": "Unknown"},
        ),
        Dimension(
            "dim_geography", "geography_key", "geography_natural_key",
            "geography_natural_key string, market string, order_region string, order_country string,"
            " order_state string, order_city string, latitude decimal(10,6), longitude decimal(10,6)",
            {"geography_natural_key": "0" * 64, "market": "Unknown", "order_region": "Unknown",
             "order_country": "Unknown", "order_state": "Unknown", "order_city": "Unknown"},
        ),
    ]
}


# Columns of a customer's member that cleaned items hold; the others are totals.
CUSTOMER_COLUMNS = ["customer_id", "customer_segment", "customer_city", "customer_state", "customer_country", "customer_zipcode"]


# ---- members found in staging -------------------------------------------------------------------


def _highest_per_key(staging: DataFrame, dim: Dimension, lowest: tuple[str, ...] = ()) -> DataFrame:
    """MAX of every attribute per natural key, MIN for the ones named.

    Distinct combinations come first: they hash and combine in the scanning tasks, where text maxima would sort
    every row, and leave about one row per member.
    """
    values = [(F.min if c in lowest else F.max)(c).alias(c) for c in dim.columns if c != dim.natural]
    combinations = staging.where(F.col(dim.natural).isNotNull()).select(*dim.columns).distinct()
    return combinations.groupBy(dim.natural).agg(*values)


def customer_members(staging: DataFrame) -> DataFrame:
    return _highest_per_key(staging, DIMENSIONS["dim_customer"], lowest=("customer_first_order_date",))


def category_members(staging: DataFrame) -> DataFrame:
    return _highest_per_key(staging, DIMENSIONS["dim_category"])


def product_members(staging: DataFrame) -> DataFrame:
    return _highest_per_key(staging, DIMENSIONS["dim_product"])


STAMPS = ["order_date", "shipping_date", "customer_first_order_date", "customer_last_order_date"]


def stamps(df: DataFrame) -> DataFrame:
    """The time stamps whose days are members; those the frame lacks are NULL."""
    return conform(df, {c: "timestamp_ntz" for c in STAMPS})


def date_members(staging: DataFrame) -> DataFrame:
    found = staging.select(*[F.to_date(c).alias(c) for c in STAMPS]).distinct()
    days = found.select(F.explode(F.array(*STAMPS)).alias("full_date")).where("full_date is not null").distinct()
    d = F.col("full_date")
    return days.select(
        "full_date",
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("calendar_month"),
        month_name(d).alias("month_name"),
        year_month(d).alias("calendar_year_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        day_name(d).alias("day_name"),
        flag(F.weekday(d) >= 5).alias("is_weekend"),
    )


def service_level(mode: Column) -> Column:
    name = F.lower(mode)
    return (
        F.when(name.contains("same day"), "Same Day")
        .when(name.contains("first class"), "Expedited")
        .when(name.contains("second class"), "Standard Plus")
        .when(name.contains("standard"), "Standard")
        .otherwise("Other")
    )


def shipping_mode_members(staging: DataFrame) -> DataFrame:
    modes = staging.where("shipping_mode is not null").groupBy("shipping_mode")
    scheduled = rounded(mean("days_for_shipment_scheduled"), 2).cast("decimal(10,2)")
    return modes.agg(scheduled.alias("default_scheduled_days")).select(
        "shipping_mode", service_level(F.col("shipping_mode")).alias("service_level_group"), "default_scheduled_days"
    )


def _place(column: str) -> Column:
    return F.coalesce(F.trim(column), F.lit("Unknown"))


PLACES = ["market", "order_region", "order_country", "order_state", "order_city"]


def geography_hash() -> Column:
    """SHA-256 over the trimmed place names and the coordinates at six decimals, zeros kept."""
    coordinates = [F.coalesce(F.round(c, 6).cast("string"), F.lit("Unknown")) for c in ("latitude", "longitude")]
    return F.sha2(F.concat_ws("|", *[_place(c) for c in PLACES], *coordinates), 256)


def geography_members(staging: DataFrame) -> DataFrame:
    raw = staging.select(*PLACES, "latitude", "longitude").distinct()  # hash places, not rows
    return raw.select(
        geography_hash().alias("geography_natural_key"),
        *[_place(c).alias(c) for c in PLACES],
        *[F.round(c, 6).cast("decimal(10,6)").alias(c) for c in ("latitude", "longitude")],
    ).distinct()


MEMBERS = {
    "dim_customer": customer_members,
    "dim_category": category_members,
    "dim_product": product_members,
    "dim_date": date_members,
    "dim_shipping_mode": shipping_mode_members,
    "dim_geography": geography_members,
}


# ---- load ---------------------------------------------------------------------------------------


def _stamp(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def unknown_member(ws: Workspace, dim: Dimension, at: datetime) -> DataFrame:
    """The row at key 0."""
    key_type = "int" if dim.name == "dim_date" else "bigint"
    columns = [F.lit(0).cast(key_type).alias(dim.key)]
    columns += [F.lit(dim.unknown.get(c)).cast(t).alias(c) for c, t in fields(dim.attributes).items()]
    columns += [F.lit(SYSTEM_SOURCE).alias("record_source"), _stamp(at).alias("created_at"), _stamp(at).alias("updated_at")]
    return ws.spark.range(1).select(*columns)


def upsert(ws: Workspace, dim: Dimension, current: DataFrame, members: DataFrame, at: datetime) -> DataFrame:
    """Current rows with the attributes of matching members, plus new members under new keys.

    Keys already given out stay; the member at key 0 is never touched. New keys continue after the
    highest key in the order of the natural key. Dates are only inserted.
    """
    attributes = [c for c in dim.columns if c != dim.natural]
    incoming = members.withColumn("_seen", F.lit(True))
    matched = F.col("s._seen").isNotNull() & (F.col(f"d.{dim.key}") > 0)
    if dim.name == "dim_date":
        matched = F.lit(False)
    kept = (
        current.alias("d")
        .join(incoming.alias("s"), F.col(f"d.{dim.natural}") == F.col(f"s.{dim.natural}"), "left")
        .select(
            f"d.{dim.key}",
            f"d.{dim.natural}",
            *[F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in attributes],
            F.when(matched, F.lit(RECORD_SOURCE)).otherwise(F.col("d.record_source")).alias("record_source"),
            "d.created_at",
            F.when(matched, _stamp(at)).otherwise(F.col("d.updated_at")).alias("updated_at"),
        )
    )
    new = members.join(current.select(dim.natural), dim.natural, "left_anti")
    if dim.name == "dim_date":
        keyed = new.withColumn(dim.key, date_key(F.col("full_date")))
    else:
        top = current.agg(F.max(dim.key).alias("k")).first()["k"] or 0
        keyed = row_number(ws, new, [F.asc(dim.natural)], dim.key)
        keyed = keyed.withColumn(dim.key, F.col(dim.key).cast("bigint") + top)
    added = keyed.withColumns({"record_source": F.lit(RECORD_SOURCE), "created_at": _stamp(at), "updated_at": _stamp(at)})
    return kept.unionByName(added.select(*kept.columns))


def next_version(ws: Workspace, name: str, staging: DataFrame, at: datetime, current: DataFrame | None = None) -> DataFrame:
    """One dimension with the staged members; `current` is the previous version, if any. Members are found once and stored."""
    dim = DIMENSIONS[name]
    if current is None:
        current = unknown_member(ws, dim, at)
    return upsert(ws, dim, current, ws.write(MEMBERS[name](staging), ws.fresh(f"{name}_members")), at)


def load_dimension(ws: Workspace, name: str, staging: DataFrame, at: datetime, current: DataFrame | None = None) -> DataFrame:
    """Load one dimension into a new folder of the workspace."""
    return ws.write(next_version(ws, name, staging, at, current), ws.fresh(name))


def load_dimensions(
    ws: Workspace, staging: dict[str, DataFrame], at: datetime, current: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """All six, each from staged rows that hold its columns, submitted side by side as they do not depend on each other."""
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        loads = {n: pool.submit(load_dimension, ws, n, staging[n], at, (current or {}).get(n)) for n in DIMENSIONS}
        return {n: load.result() for n, load in loads.items()}
