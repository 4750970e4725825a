"""Every registered query against its SQL."""

import re

import pytest

import __spark_entry__ as registry
from check_queries import differences
from tests.conftest import SAMPLE

#: the text operators' queries have tests of their own
QUERIES = {n: q for n, q in registry.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
SQL = {n: s for n, s in registry.oracle_sql().items() if n in QUERIES}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    outcome, _ = differences(spark, SAMPLE, name, QUERIES[name], SQL[name])
    assert outcome.startswith("ok"), outcome


def test_entry_has_the_scorecard_columns(spark):
    scorecard = registry.entry(spark)
    assert scorecard.count() == 150
    assert len(scorecard.columns) == 27


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_multiplies_rows_by_a_cross_join(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
