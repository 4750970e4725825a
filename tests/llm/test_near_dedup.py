import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from prevascope.llm import near_dedup as op
from prevascope.llm.components import roots
from tests.llm.rows import SCHEMA, awkward, rows, with_clashes


def decided(*arguments):
    """The operator's decisions, without the text key beside them."""
    return op.near_duplicates(*arguments).drop("text_key")


def sets_of(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: 32 for i in range(9, 14)}).split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(data):
    """Every pair of texts that share a shingle is compared."""
    sets = [sets_of(t) for _, t in data]
    parent = list(range(len(data)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    seen = set()
    for ids in holders.values():
        for n, i in enumerate(ids):
            for j in ids[:n]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                        parent[top(i)] = top(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(data):
        r = top(i)
        if doc_id is not None:
            lowest[r] = min(lowest.get(r, doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(data):
        low = lowest.get(top(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), low, doc_id == low))
    return sorted(out, key=repr)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def copies(seed, n, length=120, most=8):
    """A group of copies of one text with so many edits that some pairs are linked and others not."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    return [edited(rng, base, rng.randint(0, most)) for _ in range(n)]


@pytest.mark.parametrize("block", [op.BLOCK, 16])
def test_groups_of_copies(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    texts = copies(1, 150) + copies(2, 60, 40, 5) + copies(3, 30, 12, 2) + ["a b c", "A  b\tC", "a b", "only"] * 2
    data = list(enumerate(texts))
    assert rows(decided(spark.createDataFrame(data, "doc_id long, text string"))) == brute(data)


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    assert rows(decided(with_clashes(docs))) == brute([r[:2] for r in awkward()])
    assert rows(decided(docs.limit(0))) == []


def test_threshold_is_exact(spark):
    """15 of 20 shingles are common, then 14 of 20 and a few."""
    words = [f"w{i}" for i in range(24)]
    for cut in range(0, 9):
        data = [(1, " ".join(words)), (2, " ".join(words[cut:]))]
        got = rows(decided(spark.createDataFrame(data, "doc_id long, text string")))
        assert got == brute(data)
        if cut >= 2:
            break


def test_tiles_meet_every_pair():
    rng = np.random.default_rng(3)
    values = [np.unique(rng.integers(0, 3000, n).astype(np.uint64)) for n in (5, 400, 0, 2500, 1)]
    got = op.common_counts(values, np.array([0, 1, 3]), np.array([1, 2, 3, 4]))
    for x, i in enumerate((0, 1, 3)):
        for y, j in enumerate((1, 2, 3, 4)):
            assert i == j or got[x, y] == len(np.intersect1d(values[i], values[j]))
    table = pa.table({"key": [1, 1, 1, 2], "i": [0, 0, 0, 0], "j": [0, 1, 1, 0], "own": [0, 0, 1, 0]})
    batches = [table.slice(i, 1).to_batches()[0] for i in range(4)]
    assert [t.num_rows for t in op._each_tile(iter(batches))] == [1, 2, 1]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(70)]
    parent = {}

    def top(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: top(i) for i in parent}
