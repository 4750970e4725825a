"""The registered queries of the text operators: columns, one result a row, and their SQL."""

import re

import pytest

from check_queries import differences
from prevascope.llm import queries
from prevascope.llm.common import table
from tests.conftest import SAMPLE

QUERIES, SQL = queries.queries(), queries.oracle_sql()
#: What each result has at least, in the order of the operators.
COLUMNS = {
    1: "doc_id held_out n_tokens n_known train_tokens base_score score",
    2: "page_id url text n_chars",
    3: "doc_id keep_id group_size kept text_sha256",
    4: "doc_id n_shingles component_id kept",
    5: "doc_id n_words n_hit n_items items_sha256 contaminated",
    6: "doc_id held_out score predicted",
    7: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    8: "doc_id sample_no n_pieces log_prob perturbed log_inclusion pieces_sha256 round_trip",
    9: "doc_id n_assign n_access n_hex base_sha256 spans",
    10: "page_id payload_bytes payload_digest record_type refers_to",
    11: "item_id rank doc_id score",
    12: "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    13: "doc_id n_shingles component_id",
}


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14)) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_columns_and_rows(spark, name):
    got = QUERIES[name](spark, SAMPLE)
    number = int(re.match(r"op(\d+)_", name)[1])
    assert set(COLUMNS[number].split()) <= set(got.columns)
    if number == 11:  # the best for each item
        assert got.groupBy("item_id").count().where("count = 20").count() == table(spark, SAMPLE, "benchmark").count()
        return
    key = got.columns[0] if number not in (2, 10) else "page_id"
    source = table(spark, SAMPLE, {2: "pages", 10: "pages", 12: "embeddings"}.get(number, "documents"))
    counted = got.where("sample_no = 1") if number == 8 else got
    assert sorted(r[0] for r in counted.select(key).collect()) == sorted(r[0] for r in source.select(key).collect())


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    outcome, _ = differences(spark, SAMPLE, name, QUERIES[name], SQL[name])
    assert outcome.startswith("ok"), outcome
