from datetime import datetime

import pytest
from pyspark.sql import functions as F

from prevascope.operators import contracts, quality
from prevascope.sources import reports

SCHEMA = "stateabbr string, countyname string, diabetes_crudeprev string, loaded_at timestamp"
NOW = "2026-02-20 12:00:00"


def as_of():
    return F.lit(NOW).cast("timestamp")



@pytest.fixture
def loads(spark):
    def build(*rows):
        stamped = [(*r[:3], datetime.fromisoformat(r[3]) if r[3] else None) for r in rows]
        return spark.createDataFrame(stamped, SCHEMA.replace("timestamp", "timestamp_ntz")).withColumn(
            "loaded_at", F.col("loaded_at").cast("timestamp")
        )

    return build


def statuses(report):
    return {r.name: r.status for r in report.collect()}


def test_passing_report(spark, loads, plan_of):
    df = loads(("WI", "Dane", "9.1", "2026-02-20 11:45:00.5"), ("MN", "Cook", "", "2026-02-18 09:33:02"))
    report = quality.quality_report(df, as_of())
    rows = {r.name: r for r in report.collect()}
    assert {r.status for r in rows.values()} == {"PASS"}
    fresh = rows["Data Freshness"]
    assert (fresh.last_load, fresh.hours_old, fresh.reason) == ("2026-02-20 11:45:00.500000", 0.25, None)
    assert rows["Record Counts"].total_records == 2
    assert rows["Null Values Check"].null_diabetes == 1
    dates = rows["Date Range Check"]
    assert (dates.min_date, dates.distinct_dates) == ("2026-02-18 09:33:02", 2)
    summary = quality.dq_summary(report).first()
    assert tuple(summary) == (4, 4, 0, "PASS")
    quality.assert_quality(report)
    plan = plan_of(quality.quality_report(df, as_of()))
    assert plan.count("Scan ExistingRDD") == 1


@pytest.mark.parametrize(
    "loaded, fresh, recent",
    [
        ("2026-02-19 12:00:00", "PASS", "PASS"),
        ("2026-02-19 11:59:00", "FAIL", "PASS"),
        ("2026-02-13 13:00:00", "FAIL", "PASS"),
        ("2026-02-13 12:00:00", "FAIL", "FAIL"),
        ("2026-02-21 12:00:00", "PASS", "PASS"),
    ],
)
def test_age_limits(loads, loaded, fresh, recent):
    got = statuses(quality.quality_report(loads(("WI", "Dane", "1", loaded)), as_of()))
    assert (got["Data Freshness"], got["Date Range Check"]) == (fresh, recent)


def test_stale_reason(loads):
    report = quality.quality_report(loads(("WI", "Dane", "1", "2026-02-19 11:30:00")), as_of())
    assert report.where("name = 'Data Freshness'").first().reason == "Data is 24.5 hours old (max: 24)"


def test_empty_table(loads):
    rows = {r.name: r for r in quality.quality_report(loads().limit(0), as_of()).collect()}
    assert {n: r.status for n, r in rows.items()} == {
        "Data Freshness": "FAIL", "Record Counts": "FAIL", "Null Values Check": "PASS", "Date Range Check": "FAIL",
    }
    assert rows["Data Freshness"].reason == "No data loaded"
    assert rows["Record Counts"].reason == "No records found"
    assert rows["Date Range Check"].reason == "No date data"
    assert rows["Null Values Check"].null_states == 0


def test_null_keys_fail_once(loads):
    report = quality.quality_report(loads((None, "Dane", None, NOW)), as_of())
    nulls = report.where("name = 'Null Values Check'").first()
    assert (nulls.status, nulls.null_states, nulls.null_counties, nulls.null_diabetes) == ("FAIL", 1, 0, 1)
    assert tuple(quality.dq_summary(report).first()) == (4, 3, 1, "FAIL")
    with pytest.raises(quality.QualityGateError, match="Null Values Check"):
        quality.assert_quality(report)


def test_missing_column_and_missing_table_are_errors(spark, loads):
    report = quality.quality_report(loads(("WI", "Dane", "1", NOW)).drop("countyname"), as_of())
    got = {r.name: (r.status, r.error) for r in report.collect()}
    assert got["Null Values Check"] == ("ERROR", "no column countyname")
    assert got["Data Freshness"][0] == "PASS"
    missing = quality.quality_report_of_table(spark, "no_such_table")
    assert set(statuses(missing).values()) == {"ERROR"}
    assert quality.dq_summary(missing).first().failed == 4


def test_report_file(spark, loads, tmp_path):
    report = quality.quality_report(loads(("WI", "Dane", "1", NOW)), as_of())
    path = str(tmp_path / "report")
    reports.save_report(reports.nest_report(report, NOW), path)
    read = reports.read_report(spark, path)
    assert tuple(reports.report_summary(read).first()) == (4, 4, 0, "PASS")
    assert [r.name for r in reports.report_checks(read).collect()] == [r.name for r in report.collect()]
    assert len(list((tmp_path / "report").glob("*.json"))) == 1


def test_pretty_printed_report_can_be_read(spark, tmp_path):
    file = tmp_path / "report.json"
    file.write_text(
        """{
  "timestamp": "2031-07-11T04:05:06",
  "checks": [
    {"name": "Data Freshness", "status": "PASS", "hours_old": 0.0},
    {"name": "Record Counts", "status": "FAIL", "reason": "No records found"}
  ],
  "summary": {"total_checks": 2, "passed": 1, "failed": 1, "status": "FAIL"}
}"""
    )
    read = reports.read_report(spark, str(file))
    assert [(r.name, r.status) for r in reports.report_checks(read).collect()] == [
        ("Data Freshness", "PASS"), ("Record Counts", "FAIL"),
    ]


def test_contracts(spark):
    df = spark.createDataFrame([("WI", "Valid"), (None, "Odd"), ("XX", None)], "state_code string, status string")
    rules = [
        contracts.NotNull("state_code"),
        contracts.AcceptedValues("status", ("Valid",)),
        contracts.AcceptedValues("state_code", tuple(contracts.STATE_CODES)),
    ]
    got = [(r.column_name, r.failures, r.status) for r in contracts.contract_failures(df, "m", rules).collect()]
    assert got == [("state_code", 1, "FAIL"), ("status", 1, "FAIL"), ("state_code", 1, "FAIL")]
    assert len(contracts.STATE_CODES) == 51


def test_unreadable_load_time_spoils_only_its_checks(spark):
    df = spark.createDataFrame([("WI", "Dane", "9.1", "2026-02-20 11:00:00"), ("MN", "Cook", "8", "soon")], SCHEMA.replace("timestamp", "string"))
    rows = {r.name: r for r in quality.quality_report(df, as_of()).collect()}
    assert [rows[n].status for n in (quality.FRESHNESS, quality.COUNTS, quality.NULLS, quality.DATES)] == ["ERROR", "PASS", "PASS", "ERROR"]
    assert rows[quality.FRESHNESS].error == "1 values of loaded_at are no timestamps" and rows[quality.FRESHNESS].hours_old is None
    assert quality.dq_summary(quality.quality_report(df, as_of())).first().failed == 2
