"""Bracketed medians equal sorted ones."""

import pytest
from pyspark.sql import functions as F

from prevascope.operators import bracketed, profile
from tests.test_scale import rows_of

NAMES = {"x": "median_x", "y": "median_y"}


def numbers(spark, kind, n=40_000):
    """A hot group, a value that most rows of a group share, groups of one and two rows, NaN, infinities, nulls."""
    i = F.col("id")
    spread = F.pmod(F.xxhash64(i), F.lit(1_000_003)).cast("double") / 1000
    x = F.when(i % 13 == 0, None).when(i % 3 == 0, spread).when(i % 5 < 3, 7.25).otherwise(spread - 500)
    group = F.when(i % 3 == 0, "hot").when(i == 1, "one").when(i.isin(2, 4), "two").when(i % 7 == 0, None).otherwise("other")
    y = spread * spread
    if kind == "double":
        y = F.when(i % 4 == 0, float("nan")).when(i % 9 == 0, float("-inf")).when(i % 10 == 0, float("inf")).otherwise(y)
    return spark.range(n).select(group.alias("g"), x.cast(kind).alias("x"), y.cast(kind).alias("y"))


def both(df, **options):
    return [rows_of(profile.group_medians(df, "g", NAMES, method=m, **options)) for m in (profile.EXACT, profile.BRACKETED)]


@pytest.mark.parametrize("kind", ["double", "decimal(24,6)", "bigint"])
def test_equal_to_sorting(spark, monkeypatch, kind):
    made = []
    narrowed = bracketed._narrowed
    monkeypatch.setattr(bracketed, "_narrowed", lambda *a: made.append(1) or narrowed(*a))
    middle_values = bracketed.middle_values
    results = []
    monkeypatch.setattr(
        profile, "middle_values", lambda stacked, key: results.append(middle_values(stacked, key, inside=20)) or results[-1]
    )
    exact, found = both(numbers(spark, kind))
    assert found == exact and len(made) >= 2 and None not in results


def test_no_fallback_and_no_sort(spark, monkeypatch, plan_of):
    df = numbers(spark, "double")
    exact = rows_of(profile.group_medians(df, "g", NAMES))
    monkeypatch.setattr(profile, "_middle_by_counts", None)
    found = profile.group_medians(df, "g", NAMES, method=profile.BRACKETED)
    assert rows_of(found) == exact and "rangepartitioning" not in plan_of(found)


def test_sorts_where_a_sketch_fails(spark, monkeypatch):
    """Quantiles far from the truth are found out."""
    df = numbers(spark, "double", 5000)
    exact = rows_of(profile.group_medians(df, "g", NAMES))
    narrowed = bracketed._narrowed
    wrong = lambda *a: narrowed(*a).withColumns({"_hi": F.col("_lo"), "_inside": F.lit(0)})
    monkeypatch.setattr(bracketed, "_narrowed", wrong)
    middle_values = bracketed.middle_values
    monkeypatch.setattr(profile, "middle_values", lambda stacked, key: middle_values(stacked, key, inside=20))
    assert rows_of(profile.group_medians(df, "g", NAMES, method=profile.BRACKETED)) == exact


def test_empty(spark):
    exact, found = both(numbers(spark, "double").limit(0))
    assert exact == found == []
    exact, found = both(numbers(spark, "double", 100).withColumn("x", F.lit(None).cast("double")))
    assert exact == found
