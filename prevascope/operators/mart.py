"""The scorecard: ranked entities joined to their group's profile."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prevascope.config import DEFAULT_CONFIG, INCOMPLETE, SMALL, VALID, PrevalenceConfig
from prevascope.functions.numeric import round2
from prevascope.operators.groups import GroupShape
from prevascope.operators.profile import group_context
from prevascope.operators.ranking import AUTO, entity_ranking

ALLOW, ERROR, MATCH_ALL = "allow", "error", "match_all"


class FanOutError(ValueError):
    """A group key has several profile rows, so a join on it would repeat entities."""


def assert_one_profile_per_group(profile: DataFrame, cfg: PrevalenceConfig = DEFAULT_CONFIG) -> None:
    """Raise when a group key occurs in more than one profile row."""
    repeated = profile.groupBy(cfg.group_key).count().where("count > 1").select(cfg.group_key).take(5)
    if repeated:
        raise FanOutError(f"several profiles for {cfg.group_key}: {[r[0] for r in repeated]}")


def left_join_context(
    ranked: DataFrame,
    profile: DataFrame,
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    profiles: int | None = None,
    on_fanout: str = ALLOW,
) -> DataFrame:
    """Left join of entities to the profile of their group.

    The join is on the group key although a profile has one row per key *and* label: two spellings
    of a label repeat the entities. ``error`` refuses such a profile, ``match_all`` joins on key
    and label. The profile is broadcast when ``profiles`` (its counted rows) is small enough.
    """
    if on_fanout == ERROR:
        assert_one_profile_per_group(profile, cfg)
    on = list(cfg.group_cols) if on_fanout == MATCH_ALL else [cfg.group_key]
    averages = [
        F.col(f"avg_{m.column}").alias(f"{cfg.group_noun}_avg_{m.short}_agg") for m in cfg.ranked
    ]
    ranges = [
        F.col(f"{m.short}_disparity_range").alias(f"{cfg.group_noun}_{m.short}_range") for m in cfg.watched
    ]
    context = profile.select(*on, *averages, *ranges)
    if profiles is not None and profiles <= cfg.broadcast_groups:
        context = F.broadcast(context)
    renamed = context.withColumnsRenamed({c: f"_context_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_context_{c}")) if on_fanout == MATCH_ALL else F.col(c) == F.col(f"_context_{c}") for c in on])
    joined = ranked.join(renamed, same, "left").drop(*[f"_context_{c}" for c in on])
    first = [*on, *[c for c in joined.columns if c not in on]]
    return joined.select(*first)


def threshold_flags(cfg: PrevalenceConfig = DEFAULT_CONFIG) -> dict[str, Column]:
    """True when a measure exceeds the group mean by more than a share of the group's range.

    A comparison with null is false, never null.
    """
    noun, share = cfg.group_noun, F.lit(cfg.flag_range_share)
    return {
        f"flag_high_{m.short}": F.coalesce(
            F.col(m.column) > F.col(f"{noun}_avg_{m.short}") + F.col(f"{noun}_{m.short}_range") * share,
            F.lit(False),
        )
        for m in cfg.watched
    }


def burden_score(cfg: PrevalenceConfig = DEFAULT_CONFIG) -> Column:
    """Sum of absolute deviations of the ranked measures; null when one of them is null."""
    gaps = [F.abs(F.col(m.column) - F.col(f"{cfg.group_noun}_avg_{m.short}")) for m in cfg.ranked]
    return round2(reduce(lambda total, gap: total + gap, gaps))


def quality_status(cfg: PrevalenceConfig = DEFAULT_CONFIG) -> Column:
    """Completeness label, first match wins; an unknown population counts as valid."""
    incomplete = reduce(lambda some, m: some | m, [F.col(m.column).isNull() for m in cfg.ranked])
    return (
        F.when(incomplete, INCOMPLETE)
        .when(F.col(cfg.population) < cfg.small_population_below, SMALL)
        .otherwise(VALID)
    )


def scorecard(
    ranked: DataFrame,
    profile: DataFrame,
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    profiles: int | None = None,
    on_fanout: str = ALLOW,
) -> DataFrame:
    """Mart rows from a ranking table and a profile table."""
    noun = cfg.group_noun
    flags = threshold_flags(cfg)
    return (
        left_join_context(ranked, profile, cfg, profiles, on_fanout)
        .withColumns({**flags, "health_burden_score": burden_score(cfg), "data_quality_status": quality_status(cfg)})
        .select(
            *cfg.keys,
            *cfg.measures,
            *[f"{noun}_avg_{m.short}" for m in cfg.ranked],
            *[f"{m.short}_rank" for m in cfg.ranked],
            *[f"{noun}_avg_{m.short}_agg" for m in cfg.ranked],
            *[f"{noun}_{m.short}_range" for m in cfg.watched],
            *flags,
            "health_burden_score",
            "data_quality_status",
        )
    )


def entity_mart(
    staged: DataFrame,
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    method: str = AUTO,
    shape: GroupShape | None = None,
    on_fanout: str = ALLOW,
) -> DataFrame:
    """The scorecard straight from staging, without intermediate tables.

    Of the profile only the means and ranges are computed, which is all the scorecard shows.
    """
    shape = shape or GroupShape.of(staged, cfg.group_cols)
    return scorecard(
        entity_ranking(staged, cfg, method, shape),
        group_context(staged, cfg),
        cfg,
        shape.profiles,
        on_fanout,
    )


def mart_order(cfg: PrevalenceConfig = DEFAULT_CONFIG) -> list[Column]:
    """Group, then highest burden first, then entity name.

    A rank, unique within the group, comes last: a sort can then split even many copies of one
    entity over several tasks.
    """
    return [
        F.col(cfg.group_key).asc_nulls_last(),
        F.col("health_burden_score").desc_nulls_last(),
        F.col(cfg.entity_name).asc_nulls_last(),
        F.col(f"{cfg.ranked[0].short}_rank").asc(),
    ]
