"""Rounding, means and ages with engine-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round2(column: Column) -> Column:
    """Round to two decimals: the hundredfold as a double to the nearest whole number, halves away from zero.

    What is a tie is decided on the hundredfold double, so 1.005 (which lies below) becomes 1.0.
    """
    return F.round(column.cast("double") * F.lit(100.0), 0) / F.lit(100.0)


def mean_of(column: Column, data_type: T.DataType, window=None) -> Column:
    """Mean as DOUBLE.

    Narrow decimals are summed exactly as long integers, so the result does not depend on how
    rows were split over tasks; the widening to eight digits leaves room for 10**14 percentages
    before the sum overflows. Other types use Spark's own ``avg``.
    """
    def over(aggregate: Column) -> Column:
        return aggregate if window is None else aggregate.over(window)

    if isinstance(data_type, T.DecimalType) and data_type.precision <= 8:
        scale = F.lit(10**data_type.scale)
        total = over(F.sum(column.cast(T.DecimalType(8, data_type.scale))))
        return (total * scale).cast("bigint").cast("double") / (over(F.count(column)) * scale)
    return over(F.avg(column.cast("double")))


def _micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def hours_between(later: Column, earlier: Column) -> Column:
    """Elapsed hours as an unrounded double."""
    return _micros_between(later, earlier).cast("double") / F.lit(3.6e9)


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Elapsed days, floored; negative when ``earlier`` lies in the future."""
    return F.floor(_micros_between(later, earlier) / F.lit(86_400_000_000)).cast("bigint")


def instant_text(column: Column) -> Column:
    """Timestamp as text with six fraction digits, or none when the fraction is zero."""
    return F.when(
        column == F.date_trunc("second", column), F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
