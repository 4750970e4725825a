"""Counts and bounds from footers equal those of a scan."""

import pytest
from pyspark.sql import functions as F

from prevascope.sources import footers

COLUMNS = ["i", "d", "at"]


def written(spark, path, kind="TIMESTAMP_MICROS", n=1000):
    i = F.col("id")
    at = F.when(i % 7 > 0, F.timestamp_seconds(i * 977 - 5000))
    spark.conf.set("spark.sql.parquet.outputTimestampType", kind)
    try:
        df = spark.range(n).select(
            F.when(i % 5 > 0, i * 3 - 100).cast("int").alias("i"), F.date_add(F.lit("1969-12-01").cast("date"), i.cast("int")).alias("d"),
            at.alias("at"), at.cast("timestamp_ntz").alias("plain"), F.when(i == 3, float("nan")).otherwise(i / 7).alias("x"),
            F.lit(None).cast("int").alias("none"),
        )
        df.repartition(3).write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    return path


def scanned(spark, path, columns):
    return footers._aggregate(spark, path, spark.read.parquet(path).schema, columns).collect()


def test_from_footers(spark, tmp_path, monkeypatch, plan_of):
    path = written(spark, str(tmp_path / "t"))
    columns = [*COLUMNS, "plain"]
    expected = scanned(spark, path, columns)
    plan = plan_of(footers._from_footers(spark, path, spark.read.parquet(path).schema, columns))
    assert "PushedAggregation: [COUNT(*), MIN(i)" in plan
    monkeypatch.setattr(footers, "_aggregate", lambda s, *a, real=footers._aggregate: real(s, *a) if s is not spark else None)
    assert footers.file_bounds(spark, path, columns, uniform=True).collect() == expected
    assert footers.record_counts_of_files(spark, {"t": path}).collect() == [("t", 1000)]


@pytest.mark.parametrize("kind", ["INT96", "TIMESTAMP_MICROS"])
@pytest.mark.parametrize("columns", [["at"], ["x"], ["none"], ["i", "none"]])
def test_scans_where_footers_do_not_say(spark, tmp_path, kind, columns):
    path = written(spark, str(tmp_path / "t"), kind)
    got = footers.file_bounds(spark, path, columns, uniform=True).collect()
    assert str(got) == str(scanned(spark, path, columns))


def test_no_rows(spark, tmp_path):
    path = written(spark, str(tmp_path / "t"), n=0)
    row = footers.file_bounds(spark, path, COLUMNS, uniform=True).first()
    assert row.records == 0 and row.min_i is None and row.values_at == 0


def test_files_of_different_layouts_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).select(F.col("id").alias("a"), (F.col("id") + 100).alias("b")).write.parquet(path)
    spark.range(5).select((F.col("id") + 100).alias("b"), F.col("id").alias("a")).write.mode("append").parquet(path)
    row = footers.file_bounds(spark, path, ["a", "b"]).first()
    assert (row.records, row.min_a, row.max_a, row.min_b, row.max_b) == (10, 0, 4, 100, 104)


def test_settings_stay(spark, tmp_path):
    path = written(spark, str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    footers.file_bounds(spark, path, ["i"])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before and "parquet" in before
