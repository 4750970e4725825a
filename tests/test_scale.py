"""Strategies for large or skewed groups give the same rows, and plans keep their shape."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from prevascope.config import DEFAULT_CONFIG as CFG
from prevascope.operators import filters, mart, profile, ranking, reshape
from prevascope.operators.groups import GroupShape
from prevascope.operators.numbering import numbered_by_sort
from prevascope.operators.dedupe import latest_per_entity
from tests.conftest import COUNTY


def skewed(spark, n=6000):
    """A group with a third of all rows, one value that a third of them share, nulls, repeated keys."""
    i = F.col("id")
    state = F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), (i % 17).cast("string")))
    value = lambda k: F.when(i % 5 == k, None).when(i % 9 < 3, 0.0).otherwise((i * (37 + k)) % 9973 / 100.0)
    return spark.range(n).select(
        state.alias("state_code"),
        F.concat(F.lit("State "), state).alias("state_name"),
        F.concat(F.lit("c"), i.cast("string")).alias("county_name"),
        F.when(i % 50 == 0, "dup").otherwise(i.cast("string")).alias("county_fips"),
        (i % 30_000).cast("int").alias("total_population"),
        *[
            value(k).cast("decimal(5,2)").alias(c)
            for k, c in enumerate(
                "pct_uninsured pct_diabetes pct_current_smoker pct_obesity pct_arthritis pct_heart_disease pct_stroke".split()
            )
        ],
    ).to(spark.createDataFrame([], COUNTY).schema)


def rows_of(df):
    return sorted(map(str, df.collect()))


def unique_keys(df):
    """Without repeated keys, so that ties have one right order."""
    return df.where("county_fips <> 'dup'")


def test_shape(spark):
    shape = GroupShape.of(skewed(spark), CFG.group_cols)
    assert (shape.groups, shape.profiles, shape.largest, shape.rows) == (18, 18, 2000, 6000)
    assert GroupShape.of(skewed(spark).limit(0), CFG.group_cols) == GroupShape(0, 0, 0, 0)


def test_sorted_ranking_equals_window_ranking(spark):
    df = unique_keys(skewed(spark))
    assert rows_of(ranking.entity_ranking(df, method=ranking.SORTED)) == rows_of(
        ranking.entity_ranking(df, method=ranking.WINDOW)
    )


def test_large_group_is_ranked_by_sorting(spark, plan_of):
    small_tasks = replace(CFG, rows_per_task=1000)
    plan = plan_of(ranking.rank_in_group(unique_keys(skewed(spark)), small_tasks))
    assert "row_number" not in plan
    assert "row_number" in plan_of(ranking.rank_in_group(unique_keys(skewed(spark)), CFG))


@pytest.mark.parametrize("method", [ranking.WINDOW, ranking.SORTED])
def test_ranks_are_a_permutation_even_with_repeated_keys(spark, method):
    ranked = ranking.rank_in_group(skewed(spark), method=method)
    for m in CFG.ranked:
        odd = ranked.groupBy("state_code").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(f"{m.short}_rank").alias("d"),
            F.min(f"{m.short}_rank").alias("lo"), F.max(f"{m.short}_rank").alias("hi"),
        ).where("n <> d or lo <> 1 or hi <> n")
        assert odd.count() == 0


def test_without_broadcast_the_result_is_the_same(spark, plan_of):
    df, never = unique_keys(skewed(spark)), replace(CFG, broadcast_groups=0)
    assert rows_of(mart.entity_mart(df, never)) == rows_of(mart.entity_mart(df))
    assert rows_of(profile.group_profile(df, never)) == rows_of(profile.group_profile(df))
    assert rows_of(ranking.group_deviation(df, never)) == rows_of(ranking.group_deviation(df))


def test_numbering_spans_partitions(spark):
    df = skewed(spark, 3000).repartition(13)
    order = [F.col("pct_diabetes").desc_nulls_last(), F.col("county_name").asc()]
    numbered = numbered_by_sort(df, ["state_code"], order, "n")
    expected = df.selectExpr(
        "*", "cast(row_number() over (partition by state_code order by pct_diabetes desc nulls last, county_name) as bigint) n"
    )
    assert rows_of(numbered) == rows_of(expected)
    overall = numbered_by_sort(df, [], order, "n").agg(F.count_distinct("n"), F.max("n")).first()
    assert tuple(overall) == (3000, 3000)


def test_numbering_of_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v int")
    got = {(r.g, r.v, r.n) for r in numbered_by_sort(df, ["g"], [F.col("v").asc()], "n").collect()}
    assert got == {(None, 1, 1), (None, 3, 2), ("a", 2, 1)}


def test_ranking_shuffles_once(spark, plan_of):
    shape = GroupShape(18, 18, 2000, 6000)
    plan = plan_of(ranking.entity_ranking(skewed(spark), shape=shape))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange") == 1


def test_scorecard_broadcasts_the_context(spark, plan_of):
    plan = plan_of(mart.entity_mart(skewed(spark), shape=GroupShape(18, 18, 2000, 6000)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # ranking by group, and partial context rows by group: nothing else moves
    assert plan.count("Exchange hashpartitioning") == 2


def test_unpivot_scans_once(spark, plan_of, tmp_path):
    path = str(tmp_path / "staged")
    skewed(spark, 100).write.parquet(path)
    plan = plan_of(reshape.unpivot_measures(spark.read.parquet(path), CFG.keys))
    assert plan.count("FileScan parquet") == 1 and "pct_stroke" not in plan


def test_dedupe_drops_copies_before_the_shuffle(spark, plan_of):
    df = skewed(spark).withColumns({"loaded_at": F.current_timestamp(), "source_file": F.lit("f")})
    plan = plan_of(latest_per_entity(df, "county_fips"))
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning") < partial  # below the exchange in the tree


@pytest.mark.parametrize("kind", ["decimal(5,2)", "decimal(12,2)", "double"])
def test_median_of_skewed_groups(spark, kind):
    df = skewed(spark).select("state_code", F.col("pct_diabetes").cast(kind).alias("v"))
    expected = {r.state_code: r.m for r in df.selectExpr("state_code", "cast(v as double) v").groupBy("state_code").agg(
        F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    got = {r.state_code: r.m for r in profile.group_medians(df, "state_code", {"v": "m"}, truncate=False).collect()}
    assert got == pytest.approx(expected)


def test_rows_that_share_all_keys_are_cut_in_each_task(spark, plan_of):
    """A page within 200,000 rows of one key brings no more than the page to the task that numbers them."""
    same = spark.range(200_000).select(F.lit(1).alias("k"), "id").repartition(8)
    page = filters.page_of_table(same, ["k"], 50_000, 30, shallow_end=10)
    assert page.count() == 30 and page.distinct().count() == 30
    assert "_task" in plan_of(page)
