import hashlib
import random
import re
from collections import Counter

import pytest

from prevascope.llm import contamination as op
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm.rows import SCHEMA, awkward, rows, with_clashes


def decided(*arguments):
    """The operator's decisions, without the text key beside them."""
    return op.contamination(*arguments).drop("text_key")


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item) if item is not None else "null")
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("windows", [op.PASS_WINDOWS, 300])
def test_sample(spark, windows):
    docs, items = table(spark, SAMPLE, "documents"), table(spark, SAMPLE, "benchmark")
    got = rows(decided(docs, items, windows))
    assert got == brute(docs.select("doc_id", "text").collect(), items.collect())
    assert any(r[5] for r in got)


def test_random_words(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(i, text(rng.randint(0, 20))) for i in range(30)] + [(3, "b, A"), (None, "é é É"), (40, None)]
    docs = [(i, text(rng.randint(0, 200)) + rng.choice(["", ". é É;é é", "x"])) for i in range(150)]
    got = decided(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == brute(docs, items)


def test_windows_do_not_cross_texts(spark):
    item = " ".join(f"w{i}" for i in range(20))
    half = item.split()
    docs = [(1, " ".join(half[:10])), (2, " ".join(half[10:])), (3, item.upper() + "!"), (4, item.replace(" ", " -- "))]
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decided(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), items)
    assert rows(got) == brute(docs, [(7, item)])
    assert [r[2] for r in rows(got)] == [0, 0, 20, 20]


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    items = [(1, "plain words stand here"), (2, ""), (3, None), (4, "漢字 and 😀 emoji"), (5, "wort5 is5 wort6 is6 wort7 is7 wort8 is8 wort9 is9 wort10 is10 wort11 is11")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decided(with_clashes(docs), with_clashes(bench)))
    assert Counter(got) == Counter(brute([r[:2] for r in awkward()], items))
    assert rows(decided(docs.limit(0), bench)) == []
    assert all(r[2] == 0 for r in rows(decided(docs, bench.limit(0))))
