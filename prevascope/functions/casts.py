"""Typing of landed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT, BLANK_NULL, LENIENT = "strict", "blank_null", "lenient"


def _typed(column: Column, target: str, mode: str) -> Column:
    if mode == STRICT:
        return column.cast(target)
    filled = F.nullif(F.trim(column.cast("string")), F.lit(""))
    if mode == LENIENT:
        return filled.try_cast(target)
    if mode == BLANK_NULL:
        return filled.cast(target)
    raise ValueError(f"unknown cast mode {mode!r}")


def text_to_int(column: Column, mode: str = BLANK_NULL) -> Column:
    """Text to INTEGER, rounding fractions half up (``'12.5'`` becomes 13).

    ``blank_null`` turns blanks into null and raises on other unreadable text, ``strict`` raises
    on blanks too, ``lenient`` turns everything unreadable into null.
    """
    whole = _typed(column, "decimal(18,0)", mode)
    return whole.try_cast("int") if mode == LENIENT else whole.cast("int")


def text_to_measure(column: Column, mode: str = BLANK_NULL) -> Column:
    """Text to DECIMAL(5,2); modes as in :func:`text_to_int`."""
    return _typed(column, "decimal(5,2)", mode)


def to_instant(column: Column) -> Column:
    """Epoch seconds, epoch milliseconds (told apart by magnitude) or ISO text to TIMESTAMP."""
    text = column.cast("string")
    epoch = text.try_cast("bigint")
    return (
        F.when(epoch.isNull(), text.try_cast("timestamp"))
        .when(F.abs(epoch) >= F.lit(10**11), F.timestamp_millis(epoch))
        .otherwise(F.timestamp_seconds(epoch))
    )


def is_missing(column: Column) -> Column:
    """Null or empty text."""
    return column.isNull() | (column.cast("string") == "")
