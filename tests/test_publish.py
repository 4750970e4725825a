"""Versions behind views, the current table, the order index."""

import json
import re

import pytest
from pyspark.sql import functions as F

from prevascope.operators.contracts import AcceptedValues, NotNull
from prevascope.operators.current import current_parts, merge_batch, parts_of
from prevascope.operators.dedupe import latest_per_entity
from prevascope.operators.order_index import OrderIndex, build_order_index
from prevascope.plans import layers as plans
from prevascope.plans.publish import counting, note_counts, noted_counts, published, versions, write_version
from prevascope.sources import raw_table
from tests.test_layers import RECORDS, landing, layers, record  # noqa: F401


def counties_of(df):
    return sorted(r.county_name for r in df.collect())


def test_frames_of_an_earlier_run_stay_readable(spark, landing):  # noqa: F811
    where = layers("versions")
    first = plans.run_all(spark, str(landing), where)
    (landing / "places_county_2.json").write_text(json.dumps([record("WI", "Door", "55029", "9.0")]))
    second = plans.run_all(spark, str(landing), where)
    assert counties_of(first["mart"]) == ["Cook", "Dane", "Iron"]
    assert first["ranking"].count() == 3 and first["profile"].count() == 2
    assert counties_of(second["mart"]) == counties_of(spark.table(where.mart)) == ["Cook", "Dane", "Door", "Iron"]
    plans.run_all(spark, str(landing), where)
    for table in (where.staging, where.ranking, where.profile, where.mart):
        assert len(versions(spark, table)) == 2 and published(spark, table).lower() == versions(spark, table)[-1]


def test_broken_contract_leaves_the_views(spark, landing):  # noqa: F811
    where = layers("held_back")
    plans.run_all(spark, str(landing), where)
    shown = published(spark, where.mart)
    (landing / "places_county_2.json").write_text(json.dumps([record("XX", "Nowhere", "99001", "9.0")]))
    with pytest.raises(plans.ContractError):
        plans.run_all(spark, str(landing), where)
    assert published(spark, where.mart) == shown and counties_of(spark.table(where.mart)) == ["Cook", "Dane", "Iron"]
    plans.publish_models(spark, where)  # by hand, all the same
    assert "Nowhere" in counties_of(spark.table(where.mart))


def test_failed_write_changes_nothing(spark, landing, monkeypatch):  # noqa: F811
    where = layers("failing")
    plans.run_all(spark, str(landing), where)
    shown = {t: published(spark, t) for t in (where.staging, where.ranking, where.profile, where.mart)}
    real = plans.write_version

    def failing(df, table, run):
        if table == where.mart:
            raise OSError("no space")
        return real(df, table, run)

    monkeypatch.setattr(plans, "write_version", failing)
    with pytest.raises(OSError):
        plans.build_models(spark, where)
    assert {t: published(spark, t) for t in shown} == shown
    assert spark.table(where.mart).count() == 3


def test_a_plain_table_becomes_a_view(spark, landing):  # noqa: F811
    where = layers("migrated")
    plans.load_directory(spark, str(landing), where)
    raw_table.ensure_namespace(spark, where.mart.split(".")[0])
    spark.range(3).write.saveAsTable(where.mart)
    plans.build_models(spark, where)
    assert published(spark, where.mart) and spark.table(where.mart).count() == 3


# --- current table -----------------------------------------------------------------------------

ROW = "id int, name string, loaded_at timestamp, source_file string"


def batch(spark, day, rows):
    return spark.createDataFrame([(i, n, None, f"f{day}") for i, n in rows], ROW).withColumn(
        "loaded_at", F.lit(f"2024-01-{day:02}").cast("timestamp")
    )


def plain(df):
    return sorted((tuple(r) for r in df.select("id", "name", "source_file").collect()), key=repr)


def test_merges_equal_one_pass_over_all_loads(spark):
    raw_table.ensure_namespace(spark, "current_a")
    batches = [
        batch(spark, 3, [(i, f"a{i}") for i in range(500)] + [(None, "x")]),
        batch(spark, 5, [(i, f"b{i}") for i in range(0, 500, 7)] + [(700, "new"), (None, "y")]),
        batch(spark, 4, [(i, f"late{i}") for i in range(0, 500, 5)]),  # older than the one before
        batch(spark, 9, []),
        batch(spark, 6, [(700, "newer"), (700, "newer")]),
    ]
    everything = batches[0]
    for number, part in enumerate(batches):
        everything = everything if number == 0 else everything.unionByName(part)
        got = merge_batch(part, "current_a.t", "id", tie_break=["name"], buckets=16)
        assert plain(got) == plain(latest_per_entity(everything, "id", tie_break=["name"]))
        assert plain(merge_batch(part, "current_a.t", "id", tie_break=["name"])) == plain(got)


def test_only_touched_buckets_are_read_and_replaced(spark):
    raw_table.ensure_namespace(spark, "current_b")
    merge_batch(batch(spark, 1, [(i, "a") for i in range(1000)]), "current_b.t", "id", buckets=32)
    before = current_parts(spark, "current_b.t")
    old = spark.table("current_b.t")
    files = set(old.inputFiles())
    merge_batch(batch(spark, 2, [(5, "b"), (6, "b")]), "current_b.t", "id")
    after = current_parts(spark, "current_b.t")
    changed = {b for b in before if before[b] != after[b]}
    assert 1 <= len(changed) <= 2 and len(before) == 32
    new = spark.table("current_b.t")
    kept = files & set(new.inputFiles())
    assert len(kept) == len(files) - len({f for f in files if any(before[b] in f for b in changed)})
    assert plain(old.where("id < 7")) == [(i, "a", "f1") for i in range(7)]  # outlives one merge
    # a third merge reads the parts of its bucket alone, and drops what the second has replaced
    merge_batch(batch(spark, 3, [(5, "c")]), "current_b.t", "id")
    present = {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {parts_of('current_b.t')}").collect()}
    assert not {before[b] for b in changed} & present
    assert spark.table("current_b.t").where("name = 'c'").count() == 1 and spark.table("current_b.t").count() == 1000


def test_failed_merge_changes_nothing(spark, monkeypatch):
    from prevascope.operators import current

    raw_table.ensure_namespace(spark, "current_c")
    merge_batch(batch(spark, 1, [(1, "a")]), "current_c.t", "id", buckets=4)
    monkeypatch.setattr(current, "_show", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        merge_batch(batch(spark, 2, [(1, "b")]), "current_c.t", "id")
    monkeypatch.undo()
    assert plain(spark.table("current_c.t")) == [(1, "a", "f1")]
    assert plain(merge_batch(batch(spark, 2, [(1, "b")]), "current_c.t", "id")) == [(1, "b", "f2")]


def test_new_columns(spark):
    raw_table.ensure_namespace(spark, "current_d")
    merge_batch(batch(spark, 1, [(1, "a"), (2, "a")]), "current_d.t", "id", buckets=4)
    got = merge_batch(batch(spark, 2, [(2, "b")]).withColumn("more", F.lit(7)), "current_d.t", "id")
    assert sorted((r.id, r.name, r.more) for r in got.collect()) == [(1, "a", None), (2, "b", 7)]


# --- order index -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = spark.range(10_000).select(
        F.when(F.col("id") % 97 != 0, F.col("id") % 500).alias("day"), F.col("id"), F.concat(F.lit("r"), "id").alias("text")
    )
    path = str(tmp_path_factory.mktemp("index") / "a b[1]")
    return build_order_index(rows.repartition(7), ["day", "id"], path, rows_per_file=300), rows


def ordered(rows):
    return [tuple(r) for r in rows.orderBy(F.col("day").asc_nulls_last(), "id").collect()]


def test_pages_read_only_their_files(spark, index, plan_of):
    index, rows = index
    want = ordered(rows)
    assert index.count() == len(want)
    for offset, limit in ((0, 10), (295, 20), (5000, 700), (9990, 50), (20_000, 5), (3, 0)):
        page = index.page(offset, limit)
        got = [tuple(r) for r in page.collect()]
        assert [g[:-1] for g in got] == want[offset : offset + limit]
        assert [g[-1] for g in got] == list(range(offset + 1, offset + 1 + len(got)))
        assert len(page.inputFiles()) <= limit // 100 + 2
        assert not re.search(r"rangepartitioning\(day", plan_of(page))


def test_last_rows(index):
    index, rows = index
    assert [tuple(r)[:-1] for r in index.last(25).collect()] == ordered(rows)[::-1][:25]


def test_cursor_walks_the_table(spark, index):
    index, rows = index
    seen, key = [], None
    while True:
        page = index.after(key, 1700)
        assert len(page.inputFiles()) <= 1700 // 100 + 3
        got = page.collect()
        if not got:
            break
        seen += [tuple(r)[:-1] for r in got]
        key = got[-1].asDict()
    assert seen == ordered(rows)


def test_index_is_read_again_from_its_folder(spark, index):
    index, rows = index
    again = OrderIndex(spark, index.path, index.keys)
    assert [tuple(r) for r in again.page(100, 5).collect()] == [tuple(r) for r in index.page(100, 5).collect()]


def test_empty_index(spark, tmp_path):
    index = build_order_index(spark.createDataFrame([], "a int, b string"), ["a"], str(tmp_path / "none"))
    assert index.count() == 0 and not index.page(0, 5).collect() and not index.last(3).collect() and not index.after({"a": 1}, 3).collect()


def test_contracts_are_counted_while_writing(spark, landing, monkeypatch):  # noqa: F811
    where = layers("noted")
    (landing / "places_county_2.json").write_text(json.dumps([record("XX", "Nowhere", "99001", "9.0")]))
    plans.load_directory(spark, str(landing), where)
    models = plans.build_models(spark, where)
    expected = sorted(map(tuple, plans.check_models(models).collect()))
    noted = plans.check_versions(spark, where)
    assert not noted.inputFiles() and sorted(map(tuple, noted.collect())) == expected
    assert ("profile", "state_code", "accepted_values", 1, "FAIL") in expected
    version = plans.version_of(where.profile, plans.newest_run(spark, where))
    spark.sql(f"ALTER TABLE {version} UNSET TBLPROPERTIES ('contract_failures')")
    scanned = plans.check_versions(spark, where)
    assert scanned.inputFiles() and sorted(map(tuple, scanned.collect())) == expected


def test_rules_of_other_columns_are_not_noted(spark):
    raw_table.ensure_namespace(spark, "odd_rules")
    df = spark.createDataFrame([("it's", None), (None, "b\\c")], "a string, b string")
    rules = [NotNull("a"), AcceptedValues("b", ("b\\c", "it's"))]
    counted, seen = counting(df, rules)
    write_version(counted, "odd_rules.t", "r1")
    note_counts(spark, "odd_rules.t__vr1", rules, seen)
    assert noted_counts(spark, "odd_rules.t__vr1", rules) == {"_0": 1, "_1": 0}
    assert noted_counts(spark, "odd_rules.t__vr1", [*rules, NotNull("b")]) is None
    assert counting(df, [NotNull("c")]) == (df, None)
    spark.sql("DROP SCHEMA odd_rules CASCADE")
