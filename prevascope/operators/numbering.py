"""Row numbers that do not gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prevascope.session import materialise


def numbered_by_sort(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    name: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``row_number() over (partition by group_cols order by order)``, for groups of any size.

    ``order`` should end in a unique key. Rows are range-partitioned on groups and order, so a
    large group spans many tasks. Each row keeps its position in its partition; a small table of
    runs (one per group and partition) says how many rows of the group lie in earlier partitions.
    The sorted rows are written once, so positions stay the same when tasks are run again.
    ``keep`` names the columns wanted besides the number; those only sorted by are not written.
    """
    group_cols = list(group_cols)
    keep = list(keep or df.columns)
    placed = materialise(
        df.orderBy(*[F.col(c).asc_nulls_last() for c in group_cols], *order)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_pos", 33))
        .select(*dict.fromkeys([*keep, *group_cols]), "_pos", "_part"),
        "sorted",
    )
    runs = placed.groupBy(*group_cols, "_part").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*group_cols)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Written too: its true size then decides between a broadcast and a shuffle join.
    runs = materialise(
        runs.select(
            *[F.col(c).alias(f"_run_{c}") for c in group_cols],
            F.col("_part").alias("_run_part"),
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        ),
        "runs",
    )
    match = F.col("_part") == F.col("_run_part")
    for c in group_cols:
        match = match & F.col(c).eqNullSafe(F.col(f"_run_{c}"))
    return placed.join(runs, match).select(
        *keep, (F.col("_pos") + F.col("_shift")).cast("bigint").alias(name)
    )
