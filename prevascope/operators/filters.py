"""Row selection: groups, years, pages, most recent rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from prevascope.config import BROADCAST_GROUPS, NARROW_TOP_ABOVE, PAGE_SIZE, RECENT_ROWS, SHALLOW_PAGE_END
from prevascope.operators.numbering import numbered_by_sort


def state_filter(df: DataFrame, states: Sequence[str] | None, column: str = "state_code") -> DataFrame:
    """Keep the given groups; ``None`` or an empty list keeps all."""
    return df.where(F.col(column).isin(list(states))) if states else df


def year_filter(df: DataFrame, year: int | None, column: str = "year") -> DataFrame:
    """Keep one year; no-op without a year or when the table has no such column."""
    if year is None or column not in df.columns:
        return df
    return df.where(F.col(column).cast("int") == year)


def page_of_table(
    df: DataFrame,
    keys: Sequence[str],
    offset: int,
    limit: int = PAGE_SIZE,
    shallow_end: int = SHALLOW_PAGE_END,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in key order, in that order.

    A page near the start is a bounded top-k. A deep one would make every task keep all rows
    before the page, so the keys alone are numbered by a distributed sort and the page's rows are
    then fetched by key. Rows that share all keys may stand for each other, but never add to the page.
    """
    order = [F.col(k).asc_nulls_last() for k in keys]
    if offset + limit <= shallow_end:
        return df.orderBy(*order).offset(offset).limit(limit)
    return _rows_at(df, list(keys), order, offset + 1, offset + limit)


def _rows_at(df: DataFrame, names: list[str], order: Sequence[Column], first: int, last: int) -> DataFrame:
    """Rows number ``first`` to ``last`` in the order of the named columns."""
    places = numbered_by_sort(df.select(*names), [], order, "_row").where(F.col("_row").between(first, last))
    wanted = places.groupBy(*[F.col(n).alias(f"_{i}") for i, n in enumerate(names)]).agg(F.count(F.lit(1)).alias("_rows"))
    if last - first < BROADCAST_GROUPS:
        wanted = F.broadcast(wanted)
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_{i}")) for i, n in enumerate(names)])
    found = df.withColumn("_task", F.spark_partition_id()).join(wanted, same)
    # rows that share all keys, however many: first no more of each task than are wanted, then of all tasks
    for group in ([*names, "_task"], names):
        twin = F.row_number().over(Window.partitionBy(*group).orderBy(F.lit(0)))
        found = found.withColumn("_twin", twin).where(F.col("_twin") <= F.col("_rows"))
    return found.select(*df.columns).orderBy(*order)


def recent_rows(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    limit: int = RECENT_ROWS,
    narrow_above: int = NARROW_TOP_ABOVE,
) -> DataFrame:
    """The ``limit`` rows with the latest ``ts`` (nulls last), ties broken by ``keys``, in that order.

    ``ts`` is compared in its own type. Every task of a top-k sends ``limit`` rows to the last one; above
    ``narrow_above`` rows the columns of the order are numbered by a distributed sort instead, which one
    value shared by all rows does not hurt, and the rows wanted are fetched by them. Instants are first
    narrowed to the hour of the ``limit``-th row, from counts per hour.
    """
    order = [F.col(ts).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]]
    if limit <= narrow_above:
        return df.orderBy(*order).limit(limit)
    if isinstance(df.schema[ts].dataType, TimestampType):
        start = _start_of_last_rows(df, ts, limit)
        df = df if start is None else df.where(F.col(ts) >= F.timestamp_micros(F.lit(start)))
    return _rows_at(df, list(dict.fromkeys([ts, *keys])), order, 1, limit)


def _start_of_last_rows(df: DataFrame, ts: str, limit: int) -> int | None:
    """Start (epoch microseconds) of the hour of the ``limit``-th latest row, None with fewer rows.

    Hours since the epoch, whatever the session's time zone. One job that reads only ``ts``; the running
    count covers one row per hour of the time range.
    """
    hour = 3_600_000_000
    per_hour = (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.floor(F.unix_micros(F.col(ts)) / F.lit(hour)).alias("_hour"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    upto = F.sum("_rows").over(Window.orderBy(F.col("_hour").desc()))
    found = (
        per_hour.select("_hour", upto.alias("_upto"))
        .where(F.col("_upto") >= limit)
        .agg(F.max("_hour"))
        .first()[0]
    )
    return None if found is None else found * hour
