"""Column expressions: lenient parsing, guarded arithmetic, ordered picks.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen, and none raises on bad input whether ANSI mode is on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text forms of hours, timestamps and dates.
HOUR_FORMAT = "yyyy-MM-dd'T'HH"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_FORMAT = "yyyy-MM-dd"


def parse_timestamp(column: Column, data_type: T.DataType) -> Column:
    """UTC timestamp, null where it cannot be read."""
    if isinstance(data_type, T.TimestampType):
        return column
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    return F.try_to_timestamp(column.cast("string"))


def parse_date(column: Column, data_type: T.DataType) -> Column:
    """Calendar date, null where it cannot be read."""
    if isinstance(data_type, T.DateType):
        return column
    return parse_timestamp(column, data_type).cast("date")


def finite_or_null(column: Column) -> Column:
    """P10: NaN and infinities become null (``abs(NaN) < inf`` is false)."""
    return F.when(F.abs(column) < F.lit(float("inf")), column)


def parse_number(column: Column, data_type: T.DataType) -> Column:
    """P5: finite double, null where it cannot be read.

    Spark's cast accepts a trailing type letter (``'12d'``, ``'12f'``), which
    is not a number in the feed.
    """
    if isinstance(data_type, T.NullType):
        return column.cast("double")
    if isinstance(data_type, T.StringType):
        suffix = F.lower(F.substring(F.trim(column), -1, 1))
        column = F.when(~suffix.isin("d", "f"), column)
    return finite_or_null(column.try_cast("double"))


def calendar_date(period: Column) -> Column:
    """UTC date of a timestamp (the session runs in UTC)."""
    return F.to_date(period)


def difference(left: Column | str, right: Column | str) -> Column:
    """Signed difference, null when either side is null."""
    return F.col(left) - F.col(right) if isinstance(left, str) else left - right


def positive_base_pct(error: Column, base: Column) -> Column:
    """Percentage of a strictly positive base, otherwise null."""
    return finite_or_null(F.when(base > 0, error / base * 100))


def absolute_pct(error: Column, base: Column) -> Column:
    """Unsigned error as a share of a non-zero base, otherwise null."""
    return F.when(base != 0, F.abs(error) / F.abs(base))


def first_non_null(value: Column, order: Column | None = None) -> Column:
    """The non-null value that comes first in ``order``.

    With no order the smallest value is taken, which is the same thing where a
    group holds one value and is at least repeatable where it holds more.
    """
    if order is None:
        return F.min(value)
    return F.min_by(value, F.when(value.isNotNull(), order))


def weighted_mean(value: Column, weight: Column) -> Column:
    """A5, A10: mean over rows with a value and a positive weight."""
    usable = value.isNotNull() & (weight > 0)
    return F.try_divide(
        F.sum(F.when(usable, value * weight)), F.sum(F.when(usable, weight))
    )


def hours(count: int | Column) -> Column:
    """An interval of whole hours."""
    number = F.lit(count) if isinstance(count, int) else count
    return F.make_dt_interval(F.lit(0), number.cast("int"))


def format_period(period: Column) -> Column:
    """Hour text; minutes and seconds are dropped."""
    return F.date_format(period, HOUR_FORMAT)
