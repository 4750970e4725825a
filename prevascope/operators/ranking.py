"""Group means, deviations from them, and ranks within a group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prevascope.config import DEFAULT_CONFIG, PrevalenceConfig
from prevascope.functions.numeric import mean_of, round2
from prevascope.operators.groups import GroupShape, attach_group_values
from prevascope.operators.numbering import numbered_by_sort
from prevascope.session import materialise

AUTO, WINDOW, SORTED = "auto", "window", "sorted"


def _choose(method: str, df: DataFrame, cfg: PrevalenceConfig, shape: GroupShape | None) -> str:
    """Resolve ``auto``: groups that each fit one task are handled by a window, others by sorting."""
    if method == AUTO:
        shape = shape or GroupShape.of(df, cfg.group_cols)
        return WINDOW if shape.largest <= cfg.rows_per_task else SORTED
    if method not in (WINDOW, SORTED):
        raise ValueError(f"unknown method {method!r}")
    return method


def _rank_order(column: str, entity_key: str) -> list[Column]:
    """Highest value first, nulls last, ties by entity key."""
    return [F.col(column).desc_nulls_last(), F.col(entity_key).asc_nulls_last()]


def group_means(df: DataFrame, key: str, names: Mapping[str, str]) -> DataFrame:
    """Mean of each measure per group; ``names`` maps measure to output column."""
    return df.groupBy(key).agg(
        *[mean_of(F.col(c), df.schema[c].dataType).alias(out) for c, out in names.items()]
    )


def with_group_means(
    df: DataFrame,
    names: Mapping[str, str],
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    shape: GroupShape | None = None,
) -> DataFrame:
    """Every row with the means of its group: counts combine before the shuffle, rows stay put."""
    shape = shape or GroupShape.of(df, cfg.group_cols)
    means = group_means(df, cfg.group_key, names)
    return attach_group_values(df, means, cfg.group_key, shape, cfg.broadcast_groups)


def group_deviation(
    df: DataFrame, cfg: PrevalenceConfig = DEFAULT_CONFIG, shape: GroupShape | None = None
) -> DataFrame:
    """Add each ranked measure's group mean and the rounded deviation from it."""
    names = {m.column: _mean_name(m.short, cfg) for m in cfg.ranked}
    return with_group_means(df, names, cfg, shape).withColumns(_deviations(cfg))


def _mean_name(short: str, cfg: PrevalenceConfig) -> str:
    return f"{cfg.group_noun}_avg_{short}"


def _deviations(cfg: PrevalenceConfig) -> dict[str, Column]:
    return {
        f"{m.short}_deviation_from_{cfg.group_noun}_avg": round2(
            F.col(m.column) - F.col(_mean_name(m.short, cfg))
        )
        for m in cfg.ranked
    }


def rank_in_group(
    df: DataFrame,
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    method: str = AUTO,
    shape: GroupShape | None = None,
) -> DataFrame:
    """Add ``<measure>_rank`` for every ranked measure; 1 is the highest value of the group.

    ``window`` ranks with one shuffle on the group key. ``sorted`` spreads each group over many
    tasks (see :func:`numbered_by_sort`): the measures are stacked so that one sort ranks them
    all, and the ranks return to their rows by a generated row id. ``auto`` picks by the size of
    the largest group.
    """
    if _choose(method, df, cfg, shape) == WINDOW:
        return df.withColumns(_window_ranks(cfg))

    # The ids are generated once and stored, so both readers below see the same ones.
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    codes = [str(i) for i, _ in enumerate(cfg.ranked)]
    ids = [cfg.group_key, cfg.entity_key, "_row"]
    stacked = (
        rows.select(*ids, *[F.col(m.column).alias(code) for code, m in zip(codes, cfg.ranked)])
        .unpivot(ids, codes, "_measure", "_value")
        .withColumn("_measure", F.col("_measure").cast("tinyint"))
    )
    order = [*_rank_order("_value", cfg.entity_key), F.col("_row").asc()]
    ranked = numbered_by_sort(
        stacked, ["_measure", cfg.group_key], order, "_rank", keep=["_row", "_measure"]
    )
    per_row = ranked.groupBy("_row").agg(
        *[
            F.max(F.when(F.col("_measure") == int(code), F.col("_rank"))).alias(f"{m.short}_rank")
            for code, m in zip(codes, cfg.ranked)
        ]
    )
    return rows.join(per_row, "_row").drop("_row")


def _window_ranks(cfg: PrevalenceConfig) -> dict[str, Column]:
    group = Window.partitionBy(cfg.group_key)
    return {
        f"{m.short}_rank": F.row_number()
        .over(group.orderBy(*_rank_order(m.column, cfg.entity_key)))
        .cast("bigint")
        for m in cfg.ranked
    }


def entity_ranking(
    staged: DataFrame,
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    method: str = AUTO,
    shape: GroupShape | None = None,
) -> DataFrame:
    """Entities with group means, deviations and ranks.

    With ``window`` the means and all ranks come out of a single shuffle; with ``sorted`` the
    means are aggregated and joined back.
    """
    if method != WINDOW:
        shape = shape or GroupShape.of(staged, cfg.group_cols)
    slim = staged.select(*cfg.keys, *cfg.measures)
    if _choose(method, staged, cfg, shape) == WINDOW:
        group = Window.partitionBy(cfg.group_key)
        means = {
            _mean_name(m.short, cfg): mean_of(F.col(m.column), slim.schema[m.column].dataType, group)
            for m in cfg.ranked
        }
        ranked = slim.withColumns({**means, **_window_ranks(cfg)})
    else:
        names = {m.column: _mean_name(m.short, cfg) for m in cfg.ranked}
        ranked = attach_group_values(
            rank_in_group(slim, cfg, SORTED, shape),
            group_means(slim, cfg.group_key, names),
            cfg.group_key,
            shape,
            cfg.broadcast_groups,
        )
    deviations = _deviations(cfg)
    return ranked.withColumns(deviations).select(
        *cfg.keys,
        *cfg.measures,
        *[_mean_name(m.short, cfg) for m in cfg.ranked],
        *deviations,
        *[f"{m.short}_rank" for m in cfg.ranked],
    )
