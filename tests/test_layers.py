"""Landing files to scorecard, contracts and quality report."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from prevascope.operators.mart import FanOutError
from prevascope.operators.quality import assert_quality, dq_summary
from prevascope.plans.layers import ContractError, Layers, build_models, check_models, check_raw, load_directory, run_all
from prevascope.sources.raw_table import ensure_namespace
from prevascope.sources.reports import read_report, report_summary
from prevascope.streaming.ingest import ingest_new_files


def layers(tag):
    return Layers(
        raw=f"raw_{tag}.entities", staging=f"stg_{tag}.entities", long=f"long_{tag}",
        ranking=f"int_{tag}.ranking", profile=f"int_{tag}.profile", mart=f"mart_{tag}.scorecard",
    )


def record(state, county, fips, diabetes, **more):
    return {
        "stateabbr": state, "statedesc": f"{state} name", "countyname": county, "countyfips": fips,
        "totalpopulation": "20000", "diabetes_crudeprev": diabetes, "obesity_crudeprev": "30.1",
        "csmoking_crudeprev": "12.0", "access2_crudeprev": "8.8", **more,
    }


RECORDS = [record("WI", "Dane", "55025", "8.1"), record("WI", "Iron", "55051", "11.9"), record("MN", "Cook", "27031", "")]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "places_county_20260218_093157.json").write_text(json.dumps(RECORDS))
    return folder


def test_run(spark, landing):
    where = layers("run")
    for _ in range(2):  # the second run finds nothing new
        assert load_directory(spark, str(landing), where).count() == 0
    assert spark.table(where.raw).count() == 3

    models = build_models(spark, where)
    assert {name: df.count() for name, df in models.items()} == {
        "staging": 3, "long": 11, "ranking": 3, "profile": 2, "mart": 3,
    }
    assert len(models["staging"].columns) == 34
    assert len(models["long"].columns) == 7
    assert len(models["ranking"].columns) == 22
    assert len(models["profile"].columns) == 23
    assert len(models["mart"].columns) == 29
    assert spark.table(where.long).count() == 11
    assert [r.county_name for r in models["mart"].where("state_code = 'WI'").orderBy("diabetes_rank").collect()] == ["Iron", "Dane"]
    assert models["mart"].where("data_quality_status = 'Incomplete Data'").first().county_name == "Cook"
    assert check_models(models).where("status = 'FAIL'").count() == 0

    report = check_raw(spark, where, as_of=F.current_timestamp())
    assert dq_summary(report).first().status == "PASS"
    assert_quality(report)


def test_literal_append_only_run(spark, landing):
    where = layers("literal")
    for _ in range(2):
        load_directory(spark, str(landing), where, once=False)
    models = build_models(spark, where, dedupe=False, on_fanout="allow")
    assert models["mart"].count() == 6
    assert {r.num_counties for r in models["profile"].collect()} == {1, 2}


def test_ambiguous_group_label_stops_the_run(spark, landing):
    where = layers("fanout")
    other = record("WI", "Door", "55029", "9.0") | {"statedesc": "Wisconsin"}
    (landing / "places_county_2.json").write_text(json.dumps({"data": [other]}))
    load_directory(spark, str(landing), where)
    with pytest.raises(FanOutError):
        build_models(spark, where)


def test_unknown_state_breaks_the_contract(spark, landing):
    where = layers("contract")
    (landing / "places_county_2.json").write_text(json.dumps(record("XX", "Nowhere", "99001", "9.0")))
    load_directory(spark, str(landing), where)
    broken = check_models(build_models(spark, where)).where("status = 'FAIL'").collect()
    assert [(r.model, r.column_name, r.rule, r.failures) for r in broken] == [("profile", "state_code", "accepted_values", 1)]


def test_everything_in_one_call(spark, landing, tmp_path):
    where, report = layers("all"), str(tmp_path / "report")
    models = run_all(spark, str(landing), where, report_path=report)
    assert models["mart"].count() == 3
    assert report_summary(read_report(spark, report)).first().status == "PASS"
    (landing / "places_county_2.json").write_text(json.dumps(record("XX", "Nowhere", "99001", "9.0")))
    with pytest.raises(ContractError, match="profile.state_code accepted_values: 1 rows"):
        run_all(spark, str(landing), where)


def test_models_over_a_streamed_raw_table(spark, landing, tmp_path):
    where = layers("streamed")
    ensure_namespace(spark, "raw_streamed")
    for _ in range(2):
        ingest_new_files(spark, str(landing), where.raw, str(tmp_path / "state")).awaitTermination()
    spark.catalog.refreshTable(where.raw)
    assert spark.table(where.raw).count() == 3
    assert build_models(spark, where, dedupe=False)["mart"].count() == 3


def test_every_landed_value_is_accounted_for(spark, landing, tmp_path, caplog):
    where = layers("counted")
    (landing / "places_county_2.json").write_text("\n".join(json.dumps(r) for r in RECORDS) + "\n" + '{"stateabbr": \n')
    (landing / "places_county_3.json").write_text(json.dumps(RECORDS, indent=1)[:-20])
    (landing / "places_county_4.json").write_text('{"data": null}')
    (landing / "places_county_5.json").write_text(json.dumps(RECORDS[0], indent=1) + json.dumps(RECORDS[1], indent=1))
    lost = load_directory(spark, str(landing), where)
    assert spark.table(where.raw).count() == 6
    assert sorted(r.source_file[-6] for r in lost.collect()) == ["2", "3", "5"]
    assert "places_county_3.json" in caplog.text
    assert load_directory(spark, str(landing), where).count() == 3 and spark.table(where.raw).count() == 6


def test_batch_and_stream_share_a_table(spark, landing):
    where = layers("shared")
    load_directory(spark, str(landing), where)
    load_directory(spark, str(landing), where, once=False)
    assert spark.table(where.raw).count() == 6
    (landing / "places_county_9.json").write_text(json.dumps(RECORDS[:1]))
    load_directory(spark, str(landing), where)
    assert spark.table(where.raw).count() == 7


def test_scratch_copies_go_with_the_run(spark, landing):
    from prevascope.session import shared_root

    folder = Path(shared_root(spark).removeprefix("file:"))
    before = {p for p in folder.rglob("*") if "ingest" not in p.parts}
    models = run_all(spark, str(landing), layers("scratch"))
    assert {p for p in folder.rglob("*") if "ingest" not in p.parts} <= before | {folder / "ingest"}
    assert models["mart"].count() == 3
