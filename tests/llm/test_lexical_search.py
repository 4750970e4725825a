import math
import re
from collections import Counter

import numpy as np
import pytest

from prevascope.llm import lexical_search as ls
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm.rows import SCHEMA, awkward, rows, with_clashes

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def by_hand(docs, items, most=20):
    """All scores of all documents, one by one."""
    bags = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    total = sum(1 for _, bag in bags if bag)
    length = sum(sum(bag.values()) for _, bag in bags)
    frequency = Counter(t for _, bag in bags for t in bag)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            n, score = sum(bag.values()), 0
            for t in words(text):
                if bag[t]:
                    m = 75 + 25 * n * total // length
                    weight = math.floor(1000 * math.log((2 * total + 2) / (2 * frequency[t] + 1)))
                    score += weight * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:most], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "plain words, Wort5 is3"), (2, None), (2, ""), (3, "漢字 and emoji and more"), (3, "漢字 and emoji and more"), (None, "one"), (4, "absent")]


def test_awkward_rows(spark):
    docs = with_clashes(spark.createDataFrame(awkward(), SCHEMA))
    items = with_clashes(spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert rows(ls.search(docs, items)) == by_hand([r[:2] for r in awkward()], ITEMS)


def test_ties_and_classes_take_the_least_ids(spark):
    docs = [(i, "red blue") for i in range(200, 100, -1)] + [(i, "red green blue" if i % 2 else "red yellow blue") for i in range(60)] + [(500, "red")]
    items = [(1, "red"), (2, "blue red red"), (3, "green")]
    got = ls.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == by_hand(docs, items)


def test_blocks_of_items_give_the_same(spark):
    docs = table(spark, SAMPLE, "documents").limit(300)
    items = table(spark, SAMPLE, "benchmark")
    want = by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert rows(ls.search(docs, items, block_terms=200)) == want


def test_members_that_differ_from_their_head_are_hashed_anew(spark):
    bags = [(i, 100 + i, 75 + i % 2, [i % 3], [1 + i % 5]) for i in range(60)]
    df = spark.createDataFrame(bags, "row long, doc_id long, m long, terms array<int>, tfs array<long>")
    # the first hash puts all bags together, the second tells three groups of them apart, the next ones are good
    weak = lambda seed: ls.F.lit(0) if seed == 0 else ls.F.element_at("terms", 1) if seed == 1 else ls._bag_key(seed)
    heads, members = ls.classes(df, weak)
    want = {}
    for row, doc_id, m, terms, tfs in bags:
        want.setdefault((m, *terms, *tfs), []).append(doc_id)
    assert sorted((r.m, *r.terms, *r.tfs, r.low) for r in heads.collect()) == sorted((*k, min(v)) for k, v in want.items())
    own = {r.node: (r.m, *r.terms, *r.tfs) for r in heads.collect()}
    held = {}
    for r in members.collect():
        held.setdefault(own[r.node], []).append(r.doc_id)
    assert {k: sorted(v) for k, v in held.items()} == {k: v for k, v in want.items() if len(v) > 1}


def test_terms_are_confirmed_byte_by_byte():
    vocabulary = ls.Vocabulary([b"ab", b"abc"])
    raw = np.frombuffer(b"ab abc abcd abab", np.uint8)
    vocabulary.numbers.find = lambda hashes: np.zeros(len(hashes), np.int32)  # every hash a match
    words_, row, term, counts = vocabulary.bags(raw, np.array([0, 2, len(raw)]))
    assert words_.tolist() == [1, 3] and list(zip(row, term, counts)) == [(0, 0, 1)]


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty_tables(spark, empty):
    docs = spark.createDataFrame([] if empty != "items" else [(1, "one")], "doc_id long, text string")
    items = spark.createDataFrame([] if empty != "docs" else [(1, "one")], "item_id long, text string")
    got = ls.search(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and not got.collect()
