"""How large groups are, and joining group-level values back to rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.config import BROADCAST_GROUPS


@dataclass(frozen=True)
class GroupShape:
    """Distinct group keys, distinct (key, label, ...) profiles, rows of the largest key, all rows."""

    groups: int
    profiles: int
    largest: int
    rows: int

    @classmethod
    def of(cls, df: DataFrame, group_cols: Sequence[str]) -> "GroupShape":
        """Measure ``df``: reads only the group columns and combines counts before the shuffle."""
        key = group_cols[0]
        row = (
            df.groupBy(*group_cols)
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy(key)
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("profiles"))
            .agg(F.count(F.lit(1)), F.sum("profiles"), F.max("n"), F.sum("n"))
            .first()
        )
        return cls(*[value or 0 for value in row])


def attach_group_values(
    df: DataFrame,
    values: DataFrame,
    key: str,
    shape: GroupShape,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Add the columns of ``values`` (one row per ``key``) to every row of ``df``.

    The group table is broadcast when the measured number of groups is within
    ``broadcast_groups``; beyond that Spark joins by shuffle, where adaptive execution splits the
    partitions of hot groups. A null key finds the values of the null group.
    """
    right = values.withColumnRenamed(key, "_group")
    if shape.groups <= broadcast_groups:
        right = F.broadcast(right)
    return df.join(right, df[key].eqNullSafe(right["_group"]), "left").drop("_group")
