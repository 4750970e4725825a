"""Properties that hold for any input."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prevascope.config import DEFAULT_CONFIG as CFG
from prevascope.config import LONG_LABELS
from prevascope.operators import profile, ranking, reshape
from prevascope.operators.dedupe import latest_per_entity

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
percent = st.one_of(st.none(), st.decimals(min_value=0, max_value=100, places=2))
entities = st.lists(
    st.tuples(st.sampled_from("ABC"), st.integers(0, 40_000), percent, percent, percent), min_size=1, max_size=25
)


def build(counties, drawn):
    return counties(*[(s, f"c{i}", str(i), p, d, o, k) for i, (s, p, d, o, k) in enumerate(drawn)])


@QUICK
@given(entities)
def test_ranks_deviations_ranges(counties, drawn):
    df = build(counties, drawn)
    rows = ranking.entity_ranking(df, method=ranking.WINDOW).collect()
    for state in {r.state_code for r in rows}:
        group = [r for r in rows if r.state_code == state]
        assert sorted(r.diabetes_rank for r in group) == list(range(1, len(group) + 1))
        ranked = sorted(group, key=lambda r: r.diabetes_rank)
        known = [r.pct_diabetes for r in ranked if r.pct_diabetes is not None]
        assert known == sorted(known, reverse=True)
        deviations = [r.diabetes_deviation_from_state_avg for r in group if r.pct_diabetes is not None]
        assert abs(sum(deviations)) <= 0.005 * len(deviations) + 1e-9
    for r in profile.group_profile(df).collect():
        assert r.diabetes_disparity_range is None or r.diabetes_disparity_range >= 0


@QUICK
@given(entities)
def test_unpivot_has_one_row_per_known_cell(counties, drawn):
    df = build(counties, drawn)
    long = reshape.unpivot_measures(df, CFG.keys)
    cells = sum(v is not None for row in drawn for v in row[2:])
    assert long.count() == cells
    back = long.groupBy("county_fips").pivot("health_measure", list(LONG_LABELS.values())).agg(F.first("prevalence_percent"))
    restored = {r.county_fips: r.Diabetes for r in back.collect()}
    for i, row in enumerate(drawn):
        if str(i) in restored:
            assert restored[str(i)] == (None if row[2] is None else Decimal(row[2]))


@QUICK
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.sampled_from("xy")), max_size=20))
def test_dedupe_is_idempotent(spark, drawn):
    df = spark.createDataFrame(drawn, "k string, loaded_at int, source_file string")
    once = latest_per_entity(df, "k")
    assert sorted(map(str, latest_per_entity(once, "k").collect())) == sorted(map(str, once.collect()))
    newest = {}
    for k, at, file in drawn:
        if k is not None:
            newest[k] = max(newest.get(k, (at, file)), (at, file))
    got = {r.k: (r.loaded_at, r.source_file) for r in once.collect() if r.k is not None}
    assert got == newest
    assert once.where("k is null").count() == sum(k is None for k, _, _ in drawn)
