"""Report queries: totals, top groups, latest values, series."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.config import (
    CASES_CANDIDATES,
    DEATHS_CANDIDATES,
    GROUP_CANDIDATES,
    POPULATION_CANDIDATES,
    RATE_CANDIDATES,
    SAMPLE_ROWS,
    TOP_GROUPS,
)
from prevascope.functions.numeric import round2
from prevascope.functions.schema import first_column
from prevascope.operators.filters import recent_rows

log = logging.getLogger(__name__)

RESET, SKIP = "reset", "skip"


def first_available(candidates: Iterable[Callable[[], DataFrame]]) -> DataFrame | None:
    """The first candidate that can be read and has rows; None when there is none.

    Checking for rows reads until the first one is found; a candidate that fails then is logged and passed over.
    """
    for candidate in candidates:
        try:
            df = candidate()
            if not df.isEmpty():
                return df
        except PySparkException as error:
            log.warning("candidate skipped: %s", error.getCondition() or type(error).__name__)
    return None


def first_table(spark: SparkSession, names: Sequence[str]) -> DataFrame | None:
    """The first of the named tables that exists and has rows."""
    return first_available([lambda n=n: spark.table(n) for n in names])


def metric_totals(df: DataFrame, column: str, on_bad: str = RESET) -> DataFrame:
    """``total`` and ``mean`` of a metric read as double; the total of no values is 0 and NaN counts as no value.

    Text that is no number voids the figures (``reset``: total 0, mean null) or is left out
    (``skip``).
    """
    read = F.col(column).try_cast("double")
    value = F.when(~F.isnan(read), read)
    kept = F.lit(True) if on_bad == SKIP else F.count(F.col(column)) == F.count(read)
    return df.agg(
        F.coalesce(F.when(kept, round2(F.sum(value))), F.lit(0.0)).alias("total"),
        F.when(kept, round2(F.avg(value))).alias("mean"),
    )


def top_groups_by_metric(df: DataFrame, group: str, metric: str, limit: int = TOP_GROUPS) -> DataFrame:
    """Groups with the largest sum of ``metric``; rows without a group are left out.

    A group whose values are all null sums to 0, and NaN counts as no value. Ties are broken by group.
    """
    kind = df.schema[metric].dataType.typeName()
    value = F.col(metric).try_cast("double") if kind == "string" else F.col(metric)
    total = F.sum(F.when(~F.isnan(value), value) if kind in ("string", "float", "double") else value)
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.coalesce(total, F.lit(0)).alias(metric))
        .orderBy(F.col(metric).desc(), F.col(group).asc())
        .limit(limit)
    )


def top_groups_by_count(df: DataFrame, group: str, limit: int = TOP_GROUPS) -> DataFrame:
    """Groups with the most rows."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(group).asc())
        .limit(limit)
    )


def top_groups(df: DataFrame, limit: int = TOP_GROUPS) -> DataFrame | None:
    """Top groups by the first of cases, population and row count that the table offers."""
    group = first_column(df, GROUP_CANDIDATES)
    if group is None:
        return None
    metric = first_column(df, CASES_CANDIDATES) or first_column(df, POPULATION_CANDIDATES)
    return top_groups_by_metric(df, group, metric, limit) if metric else top_groups_by_count(df, group, limit)


def report_source(
    candidates: Iterable[Callable[[], DataFrame]], ts: str, keys: Sequence[str], limit: int | None = None
) -> DataFrame | None:
    """The first candidate with rows, cut to its ``limit`` most recent rows if a limit is given."""
    df = first_available(candidates)
    return df if df is None or limit is None else recent_rows(df, ts, keys, limit)


def report_top_groups(
    candidates: Iterable[Callable[[], DataFrame]], ts: str, keys: Sequence[str], limit: int | None = None, groups: int = TOP_GROUPS
) -> DataFrame | None:
    """The whole chain: first table with rows, its most recent rows, first matching columns, top groups."""
    df = report_source(candidates, ts, keys, limit)
    return None if df is None else top_groups(df, groups)


def headline_figures(df: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """``metric, column_name, figure``: total cases, total deaths and mean rate.

    A metric without a matching column has nulls.
    """
    spark = df.sparkSession
    wanted = [
        ("total_cases", df, CASES_CANDIDATES, "total"),
        ("total_deaths", df, DEATHS_CANDIDATES, "total"),
        ("mean_rate", rates, RATE_CANDIDATES, "mean"),
    ]
    parts = []
    for metric, table, candidates, figure in wanted:
        column = first_column(table, candidates) if table is not None else None
        source = spark.range(1).select(F.lit(None).cast("double").alias(figure)) if column is None else metric_totals(
            table, column
        )
        parts.append(
            source.select(
                F.lit(metric).alias("metric"), F.lit(column).cast("string").alias("column_name"), F.col(figure).alias("figure")
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def latest_value(df: DataFrame, ts: str, value: str, key: str, group: str | None = None) -> DataFrame:
    """Latest ``ts`` and the value on it, overall or per group; ``key`` breaks ties.

    Tasks keep one candidate per group before the shuffle.
    """
    newest = F.max(F.when(F.col(ts).isNotNull(), F.struct(ts, key, value))).alias("_newest")
    grouped = df.groupBy(group) if group else df.groupBy()
    return grouped.agg(newest).select(
        *([group] if group else []),
        F.col(f"_newest.{ts}").alias("latest_ts"),
        F.col(f"_newest.{value}").alias("latest_value"),
    )


def series_by_date(df: DataFrame, ts: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Date and value of every row, oldest first.

    Unique ``keys`` break ties, so that a sort can split a date that very many rows share.
    """
    order = [F.col(c).asc_nulls_last() for c in [ts, *keys]]
    return df.select(ts, value, *keys).orderBy(*order).select(ts, value)


def sample_rows(df: DataFrame, keys: Sequence[str], limit: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(limit)
