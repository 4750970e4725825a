"""The ledger: nothing lost and nothing twice, whatever fails in between."""

import json
import logging

import pytest

from prevascope.sources import landing, raw_table
from prevascope.streaming import ingest

SCHEMA = "state string, cases int"


@pytest.fixture
def place(spark, tmp_path, request):
    folder = tmp_path / "landing"
    folder.mkdir()
    raw_table.ensure_namespace(spark, "raw_ledger")
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)[:60]
    return folder, f"raw_ledger.{name}"


def land(folder, name, rows):
    (folder / f"places_{name}.json").write_text("\n".join(json.dumps({"state": s, "cases": i}) for i, s in enumerate(rows)))


def schema():
    return ingest.T.StructType.fromDDL(SCHEMA)


def load(spark, folder, table, **options):
    return ingest.load_files(landing.landing_files(spark, str(folder)), table, schema(), **options)


def states(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(r.state for r in spark.table(table).select("state").collect())


def stream(spark, folder, table, checkpoint):
    ingest.ingest_new_files(spark, str(folder), table, str(checkpoint), schema()).awaitTermination()


@pytest.mark.parametrize("fate", ["new", "emptied", "moved"])
def test_lost_checkpoint(spark, place, tmp_path, fate):
    folder, table = place
    first = tmp_path / "state"
    land(folder, "1", "ABCDEFGHIJ")
    stream(spark, folder, table, first)
    land(folder, "2", "KLMNOPQRST")
    if fate == "emptied":
        for file in sorted(first.rglob("*"), reverse=True):
            file.rmdir() if file.is_dir() else file.unlink()
    elif fate == "moved":
        first.rename(tmp_path / "elsewhere")
    for _ in range(2):
        stream(spark, folder, table, tmp_path / "other" if fate == "new" else first)
        assert states(spark, table) == sorted("ABCDEFGHIJKLMNOPQRST")


def test_a_table_that_was_dropped_is_loaded_again(spark, place):
    folder, table = place
    land(folder, "1", "AB")
    load(spark, folder, table)
    for name in (table, ingest.files_of(table), ingest.batches_of(table), raw_table.quarantine_of(table)):
        spark.sql(f"DROP TABLE {name}")
    load(spark, folder, table)
    assert states(spark, table) == ["A", "B"]


@pytest.mark.parametrize("step", ["before rows", "after rows", "after quarantine"])
def test_crash_within_a_batch(spark, place, monkeypatch, step):
    folder, table = place
    land(folder, "1", "AB")
    load(spark, folder, table)
    land(folder, "2", "CD")
    (folder / "places_bad.json").write_text('{"state": \n{"state": "E", "cases": 1}\n{"state": "G", "cases": 1}')
    real, calls = ingest._replace_batch, []

    def failing(df, name, batch):
        calls.append(name)
        if step != "before rows":
            real(df, name, batch)
        if len(calls) == (2 if step == "after quarantine" else 1):
            raise OSError("gone")

    monkeypatch.setattr(ingest, "_replace_batch", failing)
    with pytest.raises(OSError):
        load(spark, folder, table)
    monkeypatch.setattr(ingest, "_replace_batch", real)
    land(folder, "3", "F")
    assert load(spark, folder, table) == 2  # the one that failed and the new file
    assert states(spark, table) == list("ABCDEFG")
    assert spark.table(raw_table.quarantine_of(table)).count() == 1
    assert load(spark, folder, table) == 0
    assert spark.table(ingest.batches_of(table)).count() == 3


def test_rows_left_by_a_failed_attempt_are_replaced(spark, place, monkeypatch):
    folder, table = place
    land(folder, "1", "ABC")
    real = ingest._replace_batch

    def half(df, name, batch):  # some rows and then the end
        real(df.limit(1), name, batch)
        raise OSError("gone")

    monkeypatch.setattr(ingest, "_replace_batch", half)
    with pytest.raises(OSError):
        load(spark, folder, table)
    assert len(states(spark, table)) == 1
    monkeypatch.setattr(ingest, "_replace_batch", real)
    load(spark, folder, table)
    assert states(spark, table) == ["A", "B", "C"]


def test_a_second_run_waits_its_turn(spark, place, monkeypatch):
    folder, table = place
    land(folder, "1", "AB")
    real = ingest._load_batch

    def meanwhile(*arguments):
        with pytest.raises(ingest.IngestBusyError):
            load(spark.newSession(), folder, table)
        return real(*arguments)

    monkeypatch.setattr(ingest, "_load_batch", meanwhile)
    load(spark, folder, table)
    monkeypatch.setattr(ingest, "_load_batch", real)
    assert load(spark.newSession(), folder, table) == 0
    assert states(spark, table) == ["A", "B"]


def test_a_claim_of_a_dead_run_ends(spark, place, caplog):
    folder, table = place
    land(folder, "1", "A")
    ingest.ensure_tables(spark, table, schema())
    turn = ingest._turn(spark, table)
    turn.__enter__()
    with pytest.raises(ingest.IngestBusyError):
        load(spark, folder, table)
    with caplog.at_level(logging.WARNING), ingest._turn(spark, table, lease=-1):
        assert "given up" in caplog.text
    assert load(spark, folder, table) == 1


def test_changed_and_vanished_files(spark, place):
    folder, table = place
    land(folder, "1", "A")
    land(folder, "2", "B")
    load(spark, folder, table)
    land(folder, "1", "AC")  # another length: a new file
    (folder / "places_2.json").unlink()
    load(spark, folder, table)
    assert states(spark, table) == ["A", "A", "B", "C"]


def test_many_files_in_several_batches(spark, place):
    folder, table = place
    for i in range(40):
        land(folder, f"{i:03}", [f"s{i:03}"])
    assert 2 <= load(spark, folder, table, max_files_per_batch=10) <= 4
    assert states(spark, table) == [f"s{i:03}" for i in range(40)]
    assert spark.table(ingest.files_of(table)).count() == 40
    assert spark.table(ingest.batches_of(table)).agg({"files": "sum"}).first()[0] == 40


def test_a_raw_table_of_another_kind_of_load(spark, place):
    folder, table = place
    raw_table.append_by_name(spark.createDataFrame([("Z", 1)], SCHEMA), table)
    land(folder, "1", "AB")
    for _ in range(2):
        load(spark, folder, table)
    assert states(spark, table) == ["A", "B", "Z"]


# --- one parse ---------------------------------------------------------------------------------


@pytest.mark.parametrize("layout", [landing.LINES, landing.AUTO, landing.DOCUMENT])
def test_a_value_is_parsed_once(spark, tmp_path, layout, plan_of):
    (tmp_path / "places_1.json").write_text('{"state": "A"}\n{"state": "B"}\n')
    landed = landing.read_landing(spark, str(tmp_path / "places_1.json"), landing.LANDING_SCHEMA, layout)
    for frame in (landed.records, landed.quarantine):
        assert plan_of(frame).split("== Initial Plan ==")[0].count("from_json") <= 2


def test_damaged_ends_cost_only_themselves(spark, tmp_path):
    lines = [json.dumps({"state": f"s{i}", "cases": i}) for i in range(100)]
    for name, damaged in (("first", [0]), ("last", [99]), ("both", [0, 50, 99])):
        broken = [line[:-3] if i in damaged else line for i, line in enumerate(lines)]
        path = tmp_path / f"places_{name}.json"
        path.write_text("\n".join(broken))
        landed = landing.read_landing(spark, str(path), schema())
        assert (landed.records.count(), landed.quarantine.count()) == (100 - len(damaged), len(damaged))


@pytest.mark.parametrize(
    "content, records, lost",
    [
        ('[\n{"state": "A"}\n]', 1, 0),  # the middle line is a value by itself
        ('[\n{"state": "A"},\n{"state": "B"}\n', 0, 1),  # a document that ends early is not read in part
        ('{"data":\n[{"state": "A"}, {"state": "B"}]\n}', 2, 0),
        ('[{"state": "A"}]\n[{"state": "B"}, {"state": "C"}]', 3, 0),
        ('{"data": [{"state": "A"}]}\n{"state": "B"}', 2, 0),
        ('{"state": "A"} {"state": "B"}', 0, 1),
        ('{"state": "A"}, {"state": "B"}', 0, 1),
        ('[{"state": "A"}], "x": 1', 0, 1),
        ("5", 0, 1),
        ("null", 0, 1),
        ('["A"]', 0, 1),
        ("", 0, 0),
        ("﻿{\n\"state\": \"A\"\n}", 1, 0),
        ('{"data": null}', 0, 0),
        ('{"datum": 1}', 1, 0),
        ("{}", 1, 0),
    ],
)
def test_layouts(spark, tmp_path, content, records, lost):
    path = tmp_path / "places_1.json"
    path.write_text(content)
    landed = landing.read_landing(spark, str(path), schema())
    assert (landed.records.count(), landed.quarantine.count()) == (records, lost)
