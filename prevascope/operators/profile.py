"""Group medians and the group profile."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prevascope.config import DEFAULT_CONFIG, PrevalenceConfig
from prevascope.functions.numeric import mean_of, round2
from prevascope.operators.bracketed import middle_values
from prevascope.operators.groups import GroupShape, attach_group_values
from prevascope.session import materialise

EXACT, BRACKETED, APPROX = "exact", "bracketed", "approx"


def group_medians(
    df: DataFrame,
    key: str,
    names: Mapping[str, str],
    method: str = EXACT,
    truncate: bool = True,
) -> DataFrame:
    """Median of each measure per group, nulls ignored; ``names`` maps measure to output column.

    The median of a decimal keeps the scale of its measure, cutting the half unit that appears
    between two middle values; ``truncate=False`` returns the DOUBLE midpoint instead.

    Rows are first counted per (group, value), which combines before the shuffle, so that not even
    a value shared by most rows weighs on one task. The median is read from the running counts:
    measures of at most six digits take so few values that a group's counts fit one task, those
    of other types are sorted over many. ``bracketed`` gives the same without sorting or moving
    values, by a few more scans (see :mod:`~prevascope.operators.bracketed`). ``approx`` uses
    ``percentile_approx`` and returns one of the values.
    """
    if method == APPROX:
        return df.groupBy(key).agg(
            *[F.percentile_approx(F.col(c), 0.5, 10_000).alias(out) for c, out in names.items()]
        )
    if method not in (EXACT, BRACKETED):
        raise ValueError(f"unknown method {method!r}")

    columns = list(names)
    stacked = df.select(key, *columns).unpivot([key], columns, "_measure", "_value").where(
        F.col("_value").isNotNull()
    )
    middle = middle_values(stacked, key) if method == BRACKETED else None
    if middle is None:
        middle = _middle_by_counts(stacked, key)
    return middle.groupBy(key).agg(
        *[
            _midpoint(
                F.min(F.when(F.col("_measure") == c, F.col("_low"))).cast(df.schema[c].dataType),
                F.min(F.when(F.col("_measure") == c, F.col("_high"))).cast(df.schema[c].dataType),
                df.schema[c].dataType,
                truncate,
            ).alias(out)
            for c, out in names.items()
        ]
    )


def _middle_by_counts(stacked: DataFrame, key: str) -> DataFrame:
    """The values from the lower and the upper middle one on, from running counts."""
    value_type = stacked.schema["_value"].dataType
    counts = stacked.groupBy(key, "_measure", "_value").agg(F.count(F.lit(1)).alias("_rows"))
    running = _running_counts if _few_values(value_type) else _running_counts_by_sort
    # The lower middle value is the first with half of the rows at or below it, the upper one the
    # first with more than half.
    return running(counts, key).select(
        key,
        "_measure",
        F.when(F.col("_upto") * 2 >= F.col("_all"), F.col("_value")).alias("_low"),
        F.when(F.col("_upto") * 2 > F.col("_all"), F.col("_value")).alias("_high"),
    )


def _few_values(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.DecimalType):
        return data_type.precision <= 6
    return isinstance(data_type, (T.ByteType, T.ShortType))


def _running_counts(counts: DataFrame, key: str) -> DataFrame:
    """Rows at or below each value (``_upto``) and in all (``_all``), one task per group.

    A group has no more counts than its measures have values. They are gathered by group once,
    for the windows here and for the aggregate of the caller.
    """
    group = Window.partitionBy(key, "_measure")
    return counts.repartition(key).select(
        key,
        "_measure",
        "_value",
        F.sum("_rows").over(group.orderBy("_value")).alias("_upto"),
        F.sum("_rows").over(group).alias("_all"),
    )


def _running_counts_by_sort(counts: DataFrame, key: str) -> DataFrame:
    """As :func:`_running_counts`, with each group spread over many tasks.

    The counts are range-partitioned on group and value, which no two of them share, and written
    once. Running counts start inside each part of a group; the totals of the parts before it,
    one row per group and part, are added by a join.
    """
    group = ["_measure", key]
    placed = materialise(
        counts.orderBy(*[F.col(c).asc_nulls_last() for c in group], "_value").withColumn(
            "_part", F.spark_partition_id()
        ),
        "counts",
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*group, "_part").agg(F.sum("_rows").alias("_rows"))
    # Written too: its true size then decides between a broadcast and a shuffle join.
    parts = materialise(
        parts.select(
            *[F.col(c).alias(f"_p_{c}") for c in [*group, "_part"]],
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(whole).alias("_all"),
        ),
        "parts",
    )
    inside = F.sum("_rows").over(Window.partitionBy(*group, "_part").orderBy("_value"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in [*group, "_part"]])
    return (
        placed.withColumn("_inside", inside)
        .join(parts, same)
        .select(key, "_measure", "_value", (F.col("_before") + F.col("_inside")).alias("_upto"), "_all")
    )


def _midpoint(low: Column, high: Column, data_type: T.DataType, truncate: bool) -> Column:
    if isinstance(data_type, T.DecimalType) and truncate:
        scale = F.lit(10**data_type.scale)
        units = F.floor((low + high) * scale / F.lit(2))
        return (units / scale).cast(data_type)
    return (low.cast("double") + high.cast("double")) / F.lit(2.0)


def _median_name(short: str) -> str:
    return f"median_{short}"


def with_group_medians(
    df: DataFrame, cfg: PrevalenceConfig = DEFAULT_CONFIG, shape: GroupShape | None = None
) -> DataFrame:
    """Every row with the medians of its group for the watched measures."""
    shape = shape or GroupShape.of(df, cfg.group_cols)
    names = {m.column: _median_name(m.short) for m in cfg.watched}
    return attach_group_values(
        df, group_medians(df, cfg.group_key, names), cfg.group_key, shape, cfg.broadcast_groups
    )


def _counts_at_or_above_median(cfg: PrevalenceConfig) -> list[Column]:
    return [
        F.sum(F.when(F.col(m.column) >= F.col(_median_name(m.short)), 1).otherwise(0))
        .cast("bigint")
        .alias(f"{cfg.entity_plural}_high_{m.short}")
        for m in cfg.watched
    ]


def count_at_or_above_median(
    df: DataFrame, cfg: PrevalenceConfig = DEFAULT_CONFIG, shape: GroupShape | None = None
) -> DataFrame:
    """Per group: rows whose measure is at or above the median of the group key; null counts as no."""
    return (
        with_group_medians(df, cfg, shape).groupBy(*cfg.group_cols).agg(*_counts_at_or_above_median(cfg))
    )


def entity_counts(df: DataFrame, cfg: PrevalenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Distinct entities per group; repeated keys are dropped in each task before they move."""
    return df.groupBy(*cfg.group_cols).agg(
        F.count_distinct(F.col(cfg.entity_key)).alias(f"num_{cfg.entity_plural}")
    )


def _means_and_ranges(staged: DataFrame, cfg: PrevalenceConfig) -> list[Column]:
    types = {f.name: f.dataType for f in staged.schema.fields}
    aggregates = [round2(mean_of(F.col(c), types[c])).alias(f"avg_{c}") for c in cfg.averaged]
    for m in cfg.ranked:
        low, high = F.min(m.column), F.max(m.column)
        aggregates += [
            low.alias(f"min_pct_{m.bound}"),
            high.alias(f"max_pct_{m.bound}"),
            (high - low).alias(f"{m.short}_disparity_range"),
        ]
    return aggregates


def group_context(staged: DataFrame, cfg: PrevalenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """The means and ranges of the group profile alone, from one scan and a small shuffle."""
    return staged.groupBy(*cfg.group_cols).agg(*_means_and_ranges(staged, cfg))


def group_profile(
    staged: DataFrame,
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    shape: GroupShape | None = None,
    entity_unique: bool = False,
    entity_totals: DataFrame | None = None,
) -> DataFrame:
    """One row per group: entities, population, means, ranges, counts at or above the median.

    The distinct count runs apart from the other aggregates. Together they would shuffle one
    wide partial row per entity; apart, only (group, entity) pairs move. ``entity_unique`` states
    that no entity key repeats (as after dedupe), which makes it a plain count that moves nothing.
    ``entity_totals`` are counts kept elsewhere, as by :class:`~prevascope.operators.distinct_index.DistinctIndex`
    over the group columns: no entity of ``staged`` is counted then.
    """
    number = f"num_{cfg.entity_plural}"
    aggregates = [
        F.sum(cfg.population).alias(f"{cfg.group_noun}_total_population"),
        *_means_and_ranges(staged, cfg),
        *_counts_at_or_above_median(cfg),
    ]
    if entity_unique:
        aggregates.insert(0, F.count(cfg.entity_key).alias(number))
    stats = with_group_medians(staged, cfg, shape).groupBy(*cfg.group_cols).agg(*aggregates)
    if entity_unique:
        return stats
    totals = entity_counts(staged, cfg) if entity_totals is None else entity_totals
    counted = totals.select(*[F.col(c).alias(f"_{c}") for c in cfg.group_cols], number)
    same_group = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cfg.group_cols])
    others = [c for c in stats.columns if c not in cfg.group_cols]
    return stats.join(counted, same_group).select(*cfg.group_cols, number, *others)
