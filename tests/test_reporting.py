import pytest
from pyspark.sql import functions as F

from prevascope.operators import filters, reporting


def test_groups_without_values_sum_to_zero_and_null_groups_are_left_out(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 9), ("c", 3), ("d", 3)], "state string, cases int")
    got = [tuple(r) for r in reporting.top_groups(df).collect()]
    assert got == [("c", 3), ("d", 3), ("a", 1), ("b", 0)]
    assert reporting.top_groups(df.drop("cases"), 1).first()["count"] == 1
    assert reporting.top_groups(df.drop("state")) is None


def test_text_metric_is_summed_as_a_number(spark):
    df = spark.createDataFrame([("a", "1.5"), ("a", "2")], "state string, cases string")
    assert reporting.top_groups(df).first().cases == 3.5


@pytest.mark.parametrize("mode, total, mean", [(reporting.RESET, 0.0, None), (reporting.SKIP, 3.0, 1.5)])
def test_unreadable_metric(spark, mode, total, mean):
    df = spark.createDataFrame([("1",), ("2",), ("x",), (None,)], "cases string")
    assert tuple(reporting.metric_totals(df, "cases", mode).first()) == (total, mean)


def test_total_of_nothing(spark):
    df = spark.createDataFrame([], "cases int")
    assert tuple(reporting.metric_totals(df, "cases").first()) == (0.0, None)


def test_first_table_with_rows(spark):
    spark.createDataFrame([], "x int").createOrReplaceTempView("empty_one")
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("full_one")
    assert reporting.first_table(spark, ["absent_one", "empty_one", "full_one"]).first().x == 1
    assert reporting.first_table(spark, ["absent_one", "empty_one"]) is None


def test_latest_value_overall_and_per_group(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, 10), ("a", 2, 1, 20), ("a", 2, 2, 30), ("b", 1, 1, 5), ("b", None, 9, 99)], "g string, t int, k int, v int"
    )
    assert tuple(reporting.latest_value(df, "t", "v", "k").first()) == (2, 30)
    got = {tuple(r) for r in reporting.latest_value(df, "t", "v", "k", "g").collect()}
    assert got == {("a", 2, 30), ("b", 1, 5)}


@pytest.mark.parametrize("narrow_above", [0, 1000])
@pytest.mark.parametrize("limit", [1, 3, 4, 5, 100])
def test_recent_rows_with_ties_and_nulls(spark, limit, narrow_above):
    df = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:59:59"), (3, "2024-01-01 10:59:59"), (4, "2024-01-02 00:00:00"), (5, None), (6, None)],
        "k int, t string",
    ).withColumn("t", F.col("t").cast("timestamp"))
    got = [r.k for r in filters.recent_rows(df, "t", ["k"], limit, narrow_above).collect()]
    assert got == [4, 2, 3, 1, 5, 6][:limit]


def test_pages_cover_the_table(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    for shallow in (10_000, 0):
        pages = [
            sorted(r.k for r in filters.page_of_table(df, ["k"], start, 300, shallow).collect())
            for start in (0, 300, 600, 900, 1200)
        ]
        assert pages == [list(range(s, min(s + 300, 1000))) for s in (0, 300, 600, 900)] + [[]]


def test_sample_and_series(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, None)], "d int, v double")
    assert [r.d for r in reporting.series_by_date(df, "d", "v").collect()] == [1, 2, 3]
    assert [r.d for r in reporting.sample_rows(df, ["d"], 2).collect()] == [1, 2]


def test_large_totals_and_nan(spark):
    big = spark.createDataFrame([(1e15,), (2e15,)], "cases double")
    assert tuple(reporting.metric_totals(big, "cases").first()) == (3e15, 1.5e15)
    text = spark.createDataFrame([("NaN",), ("2",), ("4",)], "cases string")
    assert tuple(reporting.metric_totals(text, "cases").first()) == (6.0, 3.0)


@pytest.mark.parametrize("shallow", [10_000, 0])
def test_pages_keep_their_order_and_size(spark, shallow):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    assert [r.k for r in filters.page_of_table(df, ["k"], 120, 30, shallow).collect()] == list(range(120, 150))
    twins = df.unionByName(df).withColumn("v", F.lit("x"))
    got = [r.k for r in filters.page_of_table(twins, ["k"], 121, 30, shallow).collect()]
    assert got == [i // 2 for i in range(121, 151)]


@pytest.mark.parametrize("narrow_above", [0, 10_000])
def test_recent_rows_of_any_type(spark, narrow_above):
    epochs = spark.range(0, 1500).select(F.col("id").alias("k"), F.lit("1771407117").alias("t"))  # one load time, as text
    assert [r.k for r in filters.recent_rows(epochs, "t", ["k"], 1200, narrow_above).collect()] == list(range(1200))
    twins = epochs.unionByName(epochs)
    assert [r.k for r in filters.recent_rows(twins, "t", ["k"], 1201, narrow_above).collect()] == [i // 2 for i in range(1201)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # local times that the clock change leaves out
        gap = spark.range(0, 1200).select(F.col("id").alias("k"), F.lit("2024-03-10 02:30:00").cast("timestamp_ntz").alias("t"))
        assert filters.recent_rows(gap, "t", ["k"], 1200, narrow_above).count() == 1200
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_candidate_that_fails_when_read_is_passed_over(spark):
    broken = spark.range(1).where(F.assert_true(F.col("id") < 0, "gone").isNull())
    full = spark.range(3)
    assert reporting.first_available([lambda: broken, lambda: full]).count() == 3


def test_report_chain(spark):
    empty = spark.createDataFrame([], "state string, cases int, ts timestamp, k int")
    rows = [("a", 1, "2024-01-01", 1), ("b", 5, "2024-01-02", 2), ("a", 9, "2024-01-03", 3)]
    full = spark.createDataFrame(rows, "state string, cases int, ts string, k int").withColumn("ts", F.col("ts").cast("timestamp"))
    source = [lambda: spark.table("no_such_table"), lambda: empty, lambda: full]
    assert [tuple(r) for r in reporting.report_top_groups(source, "ts", ["k"]).collect()] == [("a", 10), ("b", 5)]
    assert [tuple(r) for r in reporting.report_top_groups(source, "ts", ["k"], limit=2).collect()] == [("a", 9), ("b", 5)]
    assert reporting.report_top_groups(source[:2], "ts", ["k"]) is None


def test_nan_is_no_value_in_group_sums(spark):
    rows = [("A", "5"), ("B", "NaN"), ("C", "7"), ("C", "NaN"), ("D", None)]
    for kind in ("string", "double"):
        df = spark.createDataFrame(rows, "state string, cases string").withColumn("cases", F.col("cases").cast(kind))
        got = [tuple(r) for r in reporting.top_groups_by_metric(df, "state", "cases").collect()]
        assert got == [("C", 7.0), ("A", 5.0), ("B", 0.0), ("D", 0.0)]
