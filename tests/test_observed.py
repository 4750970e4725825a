import uuid

import pytest
from pyspark.sql import functions as F

from prevascope.operators import observed, quality
from prevascope.sources import raw_table
from prevascope.streaming import ingest

SCHEMA = "stateabbr string, countyname string, diabetes_crudeprev string, loaded_at string"
LOADS = [
    [("AL", "Autauga", "12.5", "2024-01-30 10:00:00.123456"), (None, "Baldwin", "", "2024-01-30 11:00:00")],
    [("AK", None, None, "2024-01-31 09:00:00"), ("AK", "Nome", "7.1", None)],
    [],
    [("AL", "Autauga", "12.9", "2024-01-30 23:59:59")],
]
def as_of():
    return F.timestamp_seconds(F.lit(1_706_720_400))


@pytest.fixture
def name(spark):
    space = f"raw_{uuid.uuid4().hex}"
    raw_table.ensure_namespace(spark, space)
    yield f"{space}.places"
    spark.sql(f"DROP SCHEMA {space} CASCADE")


def frames(spark):
    return [spark.createDataFrame(rows, SCHEMA).withColumn("loaded_at", F.to_timestamp("loaded_at")) for rows in LOADS]


def rows(report):
    return sorted(map(tuple, report.collect()))


def test_facts_of_loads_combine(spark):
    whole = raw_table.combine_loads(frames(spark))
    taken = raw_table.combine_loads([df.agg(observed.load_facts(df.columns).alias("facts")) for df in frames(spark)])
    by_load = quality.report_of_facts(observed.combined(taken), whole.columns, as_of())
    assert rows(by_load) == rows(quality.quality_report(whole, as_of()))
    none = observed.combined(taken.limit(0))
    assert rows(quality.report_of_facts(none, whole.columns, as_of())) == rows(quality.quality_report(whole.limit(0), as_of()))


def test_unreadable_load_times_and_missing_columns(spark):
    text = spark.createDataFrame([("AL", "x", "1", "no time"), ("AL", "y", "", "2024-01-30 10:00:00")], SCHEMA)
    bare = text.drop("countyname", "diabetes_crudeprev")
    loads = [df.agg(observed.load_facts(df.columns).alias("facts")) for df in (text, bare)]
    got = quality.report_of_facts(observed.combined(raw_table.combine_loads(loads)), text.columns, as_of())
    assert rows(got) == rows(quality.quality_report(raw_table.combine_loads([text, bare]), as_of()))
    assert {r.name: r.status for r in got.collect()}["Data Freshness"] == "ERROR"


def test_report_of_loads_scans_nothing(spark, name):
    for df in frames(spark):
        ingest.load_frame(df, name)
    report = ingest.quality_report_of_loads(spark, name, as_of=as_of())
    assert not [f for f in report.inputFiles() if "/places/" in f] and [f for f in report.inputFiles() if "/places_batches/" in f]
    assert rows(report) == rows(quality.quality_report(spark.table(name), as_of()))
    assert spark.table(ingest.batches_of(name)).where("facts is not null").count() == len(LOADS)


def test_rows_past_the_ledger_are_scanned(spark, name):
    first, second, _, third = frames(spark)
    batch = ingest.load_frame(first, name)
    raw_table.append_by_name(second, name)
    ingest.load_frame(third, name)
    same = lambda: rows(ingest.quality_report_of_loads(spark, name, as_of=as_of())) == rows(quality.quality_report(spark.table(name), as_of()))
    assert same() and spark.table(name).count() == 5
    spark.sql(f"ALTER TABLE {name} DROP PARTITION ({ingest.BATCH} = '{batch}')")
    spark.catalog.refreshTable(name)
    assert same() and spark.table(name).count() == 3


def test_rows_of_a_batch_not_entered_are_scanned(spark, name, monkeypatch):
    first, second, *_ = frames(spark)
    ingest.load_frame(first, name)
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_enter", lambda *a: (_ for _ in ()).throw(RuntimeError("the end")))
        with pytest.raises(RuntimeError):
            ingest.load_frame(second, name)
    got = ingest.quality_report_of_loads(spark, name, as_of=as_of())
    assert rows(got) == rows(quality.quality_report(spark.table(name), as_of()))
    assert spark.table(name).count() == 4


def test_ledger_of_an_earlier_version(spark, name):
    """A ledger without facts gets the column with the next batch; until then, and for earlier batches, rows are scanned."""
    first, second, *_ = frames(spark)
    spark.sql(f"CREATE TABLE {ingest.batches_of(name)} (batch string, files long, unreadable long, loaded_at timestamp) USING parquet")
    assert {r.status for r in ingest.quality_report_of_loads(spark, name, as_of=as_of()).collect()} == {"ERROR"}
    first.withColumn(ingest.BATCH, F.lit("old")).write.partitionBy(ingest.BATCH).saveAsTable(name)
    spark.sql(f"INSERT INTO {ingest.batches_of(name)} VALUES ('old', 1, 0, current_timestamp())")
    for df in (None, second):
        if df is not None:
            ingest.load_frame(df, name)
        got = ingest.quality_report_of_loads(spark, name, as_of=as_of())
        assert rows(got) == rows(quality.quality_report(spark.table(name), as_of()))


def test_tables_without_batches(spark, name):
    raw_table.append_by_name(frames(spark)[0], name)
    got = ingest.quality_report_of_loads(spark, name, as_of=as_of())
    assert rows(got) == rows(quality.quality_report(spark.table(name), as_of()))


def test_a_batch_that_is_there_is_not_written_again(spark, name):
    """In a table without partitions, a batch whose rows are there has no facts, and nothing waits for them."""
    df = frames(spark)[0].withColumn(ingest.BATCH, F.lit("b"))
    raw_table.append_by_name(df, name)
    assert ingest._write_batch(df.drop(ingest.BATCH), name, "b") is None
    assert spark.table(name).count() == 2
