"""Timestamp parsing. DATETIME values are time-zone free, so they are TIMESTAMP_NTZ here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three accepted layouts.
SLASH_LAYOUT = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}) ([0-9]{1,2}):([0-9]{2})$"
STAMP_LAYOUT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
DATE_LAYOUT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def parse_datetime(text: Column, date_only: bool = True) -> Column:
    """`M/d/yyyy H:mm`, `yyyy-MM-dd HH:mm:ss` or (optionally) `yyyy-MM-dd`; anything else is NULL."""
    text = F.trim(text)
    layouts = [SLASH_LAYOUT, STAMP_LAYOUT, DATE_LAYOUT] if date_only else [SLASH_LAYOUT, STAMP_LAYOUT]
    iso = F.regexp_replace(text, SLASH_LAYOUT, "$3-$1-$2 $4:$5:00")
    return F.when(text.rlike("|".join(layouts)), iso.try_cast("timestamp_ntz"))


# Fixed values.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def date_key(stamp: Column) -> Column:
    """yyyyMMdd as a number."""
    return F.year(stamp) * 10_000 + F.month(stamp) * 100 + F.dayofmonth(stamp)


def year_month(stamp: Column) -> Column:
    return F.substring(F.to_date(stamp).cast("string"), 1, 7)


def month_name(stamp: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(stamp))


def day_name(stamp: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAYS]), F.weekday(stamp) + 1)


def whole_days(first: Column, last: Column) -> Column:
    """Whole 24-hour days from first to last."""
    return F.timestamp_diff("DAY", first, last).cast("int")
