import json
import logging
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prevascope.sources import landing, raw_table
from prevascope.streaming.ingest import ingest_new_files

DAILY = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("cases", T.IntegerType()),
        T.StructField("deaths", T.IntegerType()),
    ]
)
ROWS = [
    {"state": "OR", "date": "2031-07-09", "cases": 17, "deaths": None},
    {"state": "VT", "date": "2031-07-10", "cases": 0, "deaths": 3, "note": "later"},
]


def write(path, content):
    path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
    return str(path)


def states(df):
    return sorted(r.state for r in df.select("state").collect())


@pytest.mark.parametrize("content, expected", [(ROWS, ["OR", "VT"]), ({"data": ROWS}, ["OR", "VT"]), (ROWS[0], ["OR"]), ({"data": []}, []), ([], [])])
def test_document_shapes(spark, tmp_path, content, expected):
    landed = landing.read_landing(spark, write(tmp_path / "places_a.json", content), DAILY)
    assert states(landed.records) == expected
    assert landed.quarantine.count() == 0


def test_missing_keys_are_null_and_extra_keys_ignored(spark, tmp_path):
    path = write(tmp_path / "places_a.json", [{"state": "OR", "other": 1}])
    row = landing.read_landing(spark, path, DAILY).records.first()
    assert (row.state, row.cases) == ("OR", None)
    assert row.source_file.endswith("places_a.json")


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        landing.read_landing(spark, str(tmp_path / "absent.json"), DAILY)


def test_directory(spark, tmp_path, caplog):
    write(tmp_path / "places_1.json", ROWS)
    write(tmp_path / "places_2.json", {"data": ROWS[:1]})
    write(tmp_path / "places_bad.json", '[{"state": "TX"')
    write(tmp_path / "flu_1.json", ROWS)
    write(tmp_path / "places_notes.txt", "not json")
    (tmp_path / "sub.d").mkdir()
    write(tmp_path / "sub.d" / "places_3.json", ROWS)
    with caplog.at_level(logging.WARNING):
        landed = landing.read_landing_directory(spark, str(tmp_path), DAILY)
    assert states(landed.records) == ["OR", "OR", "VT"]
    bad = landed.quarantine.collect()
    assert [r.source_file.rsplit("/", 1)[1] for r in bad] == ["places_bad.json"]
    assert bad[0].content.startswith('[{"state"')
    assert "flu_1.json" in caplog.text and "places_1" not in caplog.text


def test_missing_directory_yields_no_rows(spark, tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        landed = landing.read_landing_directory(spark, str(tmp_path / "absent"), DAILY)
    assert landed.records.count() == 0 and landed.quarantine.count() == 0
    assert landed.records.columns == [*DAILY.names, "source_file"]
    assert "no landing files" in caplog.text


def test_bad_line_does_not_spoil_its_file(spark, tmp_path):
    path = write(tmp_path / "places_a.json", '{"state": "OR"}\n{"state": \n{"state": "VT"}\n')
    landed = landing.read_landing(spark, path, DAILY, landing.LINES)
    assert states(landed.records) == ["OR", "VT"]
    assert landed.records.count() == 2
    assert landed.quarantine.count() == 1


def test_extract_file_name_and_roundtrip(spark, tmp_path):
    df = landing.with_extract_provenance(spark.createDataFrame(ROWS, DAILY).withColumn("cases", F.lit(None).cast("int")))
    path = landing.write_extract(df, str(tmp_path / "new"), datetime(2026, 2, 18, 9, 31, 57))
    assert path.endswith("places_county_20260218_093157.json")
    text = "".join(part.read_text() for part in (tmp_path / "new").rglob("part-*.json"))
    assert '"cases":null' in text and '"source":"CDC_PLACES"' in text
    back = landing.read_landing_directory(spark, str(tmp_path / "new"), DAILY, landing.LINES).records
    assert states(back) == ["OR", "VT"]


def test_append_matches_columns_by_name(spark):
    raw_table.ensure_namespace(spark, "raw_append")
    table = "raw_append.t"
    raw_table.append_by_name(spark.createDataFrame([("a", 1)], "x string, y int"), table)
    raw_table.append_by_name(spark.createDataFrame([(2, "b")], "y int, x string"), table)
    raw_table.append_by_name(spark.createDataFrame([("c", 9.5)], "x string, z double"), table)
    got = {tuple(r) for r in spark.table(table).select("x", "y", "z").collect()}
    assert got == {("a", 1, None), ("b", 2, None), ("c", None, 9.5)}
    assert raw_table.list_tables(spark, ["raw_append"]) == [table]
    assert raw_table.record_counts_or_none(spark, [table]) == {table: 3}
    assert raw_table.record_counts_or_none(spark, ["raw_append.absent"]) == {}
    counted = {r.table_name: (r.records, r.status) for r in raw_table.table_counts(spark, [table, "absent"]).collect()}
    assert counted == {table: (3, "ok"), "absent": (None, "missing")}


def test_files_are_ingested_once(spark, tmp_path):
    raw_table.ensure_namespace(spark, "raw_stream")
    directory, table, checkpoint = tmp_path / "landing", "raw_stream.once", str(tmp_path / "state")
    directory.mkdir()

    def run():
        ingest_new_files(spark, str(directory), table, checkpoint, DAILY).awaitTermination()
        spark.catalog.refreshTable(table)
        return spark.table(table)

    write(directory / "places_1.json", ROWS)
    write(directory / "other_1.json", ROWS)
    assert run().count() == 2
    assert run().count() == 2
    write(directory / "places_2.json", {"data": ROWS[:1]})
    write(directory / "places_bad.json", "{")
    after = run()
    assert states(after) == ["OR", "OR", "VT"]
    assert {"loaded_at", "source_file"} <= set(after.columns)


def test_stream_finds_extracts_written_later(spark, tmp_path):
    raw_table.ensure_namespace(spark, "raw_stream")
    directory, table, checkpoint = str(tmp_path / "landing"), "raw_stream.later", str(tmp_path / "state")
    frame = spark.createDataFrame(ROWS, DAILY)
    for day, total in ((1, 2), (2, 4)):
        landing.write_extract(frame, directory, datetime(2026, 2, day))
        ingest_new_files(spark, directory, table, checkpoint, DAILY, landing.LINES).awaitTermination()
        spark.catalog.refreshTable(table)
        assert spark.table(table).count() == total


def test_extract_files_hold_at_most_one_page(spark, tmp_path):
    landing.write_extract(spark.range(1000).coalesce(1), str(tmp_path / "new"), page_size=300)
    sizes = sorted(len(p.read_text().splitlines()) for p in (tmp_path / "new").rglob("part-*.json"))
    assert sizes == [100, 300, 300, 300]
