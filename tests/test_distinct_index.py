"""Distinct counts kept load by load."""

import pytest
from pyspark.sql import functions as F

from prevascope.operators import distinct_index, profile
from prevascope.operators.distinct_index import DistinctIndex
from tests.test_scale import rows_of, skewed


@pytest.fixture
def index(spark, tmp_path):
    return DistinctIndex(spark, str(tmp_path / "index"), "key", ("a", "b"))


def load(spark, start, end):
    """Keys that earlier loads partly hold, a group with a third of all rows, null keys and null groups."""
    i = F.col("id")
    return spark.range(start, end).select(
        F.when(i % 3 == 0, "hot").when(i % 7 == 0, None).otherwise(F.concat(F.lit("g"), (i % 5).cast("string"))).alias("a"),
        (i % 2).alias("b"),
        F.when(i % 11 == 0, None).otherwise(F.concat(F.lit("k"), (i % 70_000).cast("string"))).alias("key"),
        F.lit("x").alias("_code"),
        F.lit("y").alias("_bucket"),
    )


def counted(df):
    return rows_of(df.groupBy("a", "b").agg(F.count_distinct("key").alias("distinct")).where("distinct > 0"))


def test_loads_add_up(spark, index):
    parts = [load(spark, 0, 50_000), load(spark, 40_000, 90_000), load(spark, 0, 0), load(spark, 85_000, 100_000)]
    whole = parts[0]
    assert index.add(parts[0], "l0") and rows_of(index.counts()) == counted(whole)
    for n, part in enumerate(parts[1:], 1):
        assert index.add(part, f"l{n}")
        whole = whole.union(part)
        assert rows_of(index.counts()) == counted(whole)
    assert not index.add(parts[1], "l1") and rows_of(index.counts()) == counted(whole)
    assert rows_of(index.counts(loads=["l0", "l3"])) == counted(parts[0].union(parts[3]))


def test_keys_have_one_number(spark, index):
    for n in range(3):
        index.add(load(spark, n * 1000, n * 1000 + 2000), f"l{n}")
    codes = index._read(distinct_index.CODES, index.loads(distinct_index.CODES))
    n, keys, numbers, last = codes.agg(F.count("*"), F.count_distinct("key"), F.count_distinct("_code"), F.max("_code")).first()
    assert n == keys == numbers == last


def test_a_load_that_died_is_repeated(spark, index, monkeypatch):
    first, second = load(spark, 0, 3000), load(spark, 2000, 6000)
    index.add(first, "l0")
    write = DistinctIndex._write

    def dying(self, df, kind, name):
        if kind == distinct_index.BITMAPS:
            raise OSError("lost")
        write(self, df, kind, name)

    monkeypatch.setattr(DistinctIndex, "_write", dying)
    with pytest.raises(OSError):
        index.add(second, "l1")
    monkeypatch.setattr(DistinctIndex, "_write", write)
    assert rows_of(index.counts()) == counted(first)
    assert index.add(second, "l1")
    assert rows_of(index.counts()) == counted(first.union(second))


def test_names_and_missing_loads(spark, index):
    with pytest.raises(ValueError):
        index.add(load(spark, 0, 10), "a/b")
    with pytest.raises(LookupError):
        index.counts()
    index.add(load(spark, 0, 0), "empty")
    assert index.counts().count() == 0
    with pytest.raises(LookupError):
        index.counts(loads=["other"])


def test_profile_takes_kept_counts(spark, tmp_path):
    staged = skewed(spark)
    index = DistinctIndex(spark, str(tmp_path / "index"), "county_fips", ("state_code", "state_name"))
    index.add(staged.limit(2500), "l0")
    index.add(staged, "l1")
    kept = profile.group_profile(staged, entity_totals=index.counts("num_counties"))
    assert rows_of(kept) == rows_of(profile.group_profile(staged))
