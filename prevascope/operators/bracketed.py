"""Exact medians of groups of any size and values of any number, without sorting the values.

A pass over the rows keeps a quantile sketch of bounded size per group and measure; its error is bounded, so two of its
quantiles enclose the middle rows. The next pass counts the rows below and at the ends of that bracket and sketches
those inside, a hundredth of them or so; after a few passes a bracket holds few rows, whose values are counted. All
passes combine within tasks: what moves is one sketch per task, group and measure, however large or hot a group is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prevascope.config import BROADCAST_GROUPS
from prevascope.session import materialise

#: Steps of the quantiles read from a sketch, and the inverse of its relative rank error.
STEPS, ACCURACY = 200, 4_000
#: Rows strictly inside a bracket that are counted value by value.
INSIDE = 10_000


def _with_brackets(rows: DataFrame, brackets: DataFrame, key: str, n_brackets: int) -> DataFrame:
    right = brackets.select(F.col(key).alias("_b_key"), F.col("_measure").alias("_b_measure"), "_lo", "_hi", "_n")
    if n_brackets <= BROADCAST_GROUPS:
        right = F.broadcast(right)
    return rows.join(right, rows[key].eqNullSafe(F.col("_b_key")) & (F.col("_measure") == F.col("_b_measure"))).drop(
        "_b_key", "_b_measure"
    )


def _narrowed(counted: DataFrame, key: str) -> DataFrame:
    """Brackets from the counts and sketches of a pass: nearer ends where the sketch is sure of them.

    The quantile of step ``i`` has a rank of ``i / STEPS`` of the rows inside, give or take an error. ``_inside`` is the
    most that the new bracket may have strictly inside.
    """
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    inside, before = F.col("_inside"), F.col("_below") + F.col("_at_lo")
    slack = inside * (2.0 / ACCURACY) + 1
    ranked = F.transform("_q", lambda q, i: F.struct((i / F.lit(float(STEPS)) * inside).alias("rank"), q.alias("q")))
    lows = F.array_max(F.filter(ranked, lambda x: before + x["rank"] + slack < low))
    highs = F.array_min(F.filter(ranked, lambda x: before + x["rank"] - slack > high))
    at_lo, at_hi = high <= before, low > before + inside
    new_lo = F.when(at_hi, F.col("_hi")).otherwise(F.coalesce(lows["q"], F.col("_lo")))
    new_hi = F.when(at_lo, F.col("_lo")).otherwise(F.coalesce(highs["q"], F.col("_hi")))
    most = F.coalesce(highs["rank"], inside) - F.coalesce(lows["rank"], F.lit(0.0)) + 2 * slack
    left = F.when(at_lo | at_hi, 0).otherwise(F.least(inside, F.ceil(most)))
    return counted.select(key, "_measure", new_lo.alias("_lo"), new_hi.alias("_hi"), "_n", left.alias("_inside"))


def middle_values(stacked: DataFrame, key: str, inside: int = INSIDE) -> DataFrame | None:
    """(key, _measure, _low, _high), the two middle values of each group of ``stacked`` (key, _measure, _value, no nulls).

    NaN is the largest value, as where values are sorted. None if the error bound of a sketch did not hold, which the
    last pass finds out, or passes no longer narrow a bracket; the caller then sorts.
    """
    # brackets compare doubles: they keep the order of all numeric types, and values that become equal stay together
    point = F.nanvl(F.col("_value").cast("double"), F.lit(float("inf")))
    rows = stacked.withColumn("_point", point)
    at, lo, hi = F.col("_point"), F.col("_lo"), F.col("_hi")
    steps = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    whole = rows.groupBy(key, "_measure").agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    brackets = materialise(whole, "brackets")
    n_brackets, largest = brackets.agg(F.count(F.lit(1)), F.max("_n")).first()
    while largest and largest > inside:
        strictly = (at > lo) & (at < hi)
        counted = _with_brackets(rows, brackets, key, n_brackets).groupBy(key, "_measure").agg(
            *[F.first(c).alias(c) for c in ("_lo", "_hi", "_n")],
            F.count_if(at < lo).alias("_below"),
            F.count_if(at == lo).alias("_at_lo"),
            F.count_if(strictly).alias("_inside"),
            F.percentile_approx(F.when(strictly, at), steps, ACCURACY).alias("_q"),
        )
        before = largest
        brackets = materialise(_narrowed(counted, key), "brackets")
        largest = brackets.agg(F.max("_inside")).first()[0]
        if largest >= before:
            return None
    # the rows below a bracket are counted as a value of their own, null
    enclosed = _with_brackets(rows, brackets, key, n_brackets).where(at <= hi)
    values = enclosed.groupBy(key, "_measure", F.when(at >= lo, F.col("_value")).alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows"), F.first("_n").alias("_n")
    )
    order = Window.partitionBy(key, "_measure").orderBy(F.col("_value").asc_nulls_first())
    half, value = F.sum("_rows").over(order) * 2, F.col("_value")
    middle = (
        values.select(key, "_measure", "_value", (half >= F.col("_n")).alias("_from_low"), (half > F.col("_n")).alias("_from_high"))
        .groupBy(key, "_measure")
        .agg(
            F.min(F.when(F.col("_from_low"), value)).alias("_low"),
            F.min(F.when(F.col("_from_high"), value)).alias("_high"),
            F.count_if(F.col("_from_low") & value.isNull()).alias("_missed"),
        )
    )
    middle = materialise(middle, "middle")
    if middle.where((F.col("_missed") > 0) | F.col("_high").isNull()).head(1):
        return None
    return middle.drop("_missed")
