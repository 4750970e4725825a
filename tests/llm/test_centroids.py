import hashlib
import math

import numpy as np
import pytest

from prevascope.llm import centroids as ce
from tests.llm.rows import rows, with_clashes

SCHEMA = "vec_id long, embedding array<float>"


def by_hand(vectors, clusters=16, rounds=3):
    """Every distance of every round, in Python's own integers."""
    kept = [(i, [float(np.float32(x)) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and None not in v]
    kept = [(i, [math.floor(64 * x) for x in v], v) for i, v in kept if all(map(math.isfinite, v))]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2])
    centres = [list(r[1]) for r in sorted(kept, key=key)[:clusters]]
    distance = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    for turn in range(rounds + 1):
        near = [min((distance(v, c), j) for j, c in enumerate(centres)) for _, v, _ in kept]
        if turn == rounds:
            break
        for j in range(len(centres)):
            own = [v for (_, v, _), (_, k) in zip(kept, near) if k == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    inertia = [sum(d for d, k in near if k == j) for j in range(len(centres))]
    return sorted([(i, k, d, inertia[k], sum(inertia), digest[k]) for (i, _, _), (d, k) in zip(kept, near)], key=repr)


def scattered(n, seed, spread=1.0):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(20, 64))
    return [(i, (middles[random.integers(20)] + spread * random.normal(size=64)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_all_distances(spark, spread, monkeypatch):
    monkeypatch.setattr(ce, "BLOCK", 64)
    vectors = scattered(700, 3, spread)
    assert rows(ce.cluster(spark.createDataFrame(vectors, SCHEMA).repartition(5))) == by_hand(vectors)


def test_awkward_rows(spark):
    good = scattered(40, 5)
    vectors = [*good, *good[:9], (3, good[7][1]), (None, good[8][1]), (50, None), (51, []), (52, [1.0] * 63), (53, [1.0] * 65), (54, [None] + [1.0] * 63)]
    vectors += [(55, [float("nan")] + [1.0] * 63), (56, [float("inf")] + [1.0] * 63), (57, [-0.0] * 64), (58, [0.0] * 64)]
    assert rows(ce.cluster(with_clashes(spark.createDataFrame(vectors, SCHEMA)))) == by_hand(vectors)


def test_fewer_vectors_than_clusters_and_equal_ones(spark):
    few = scattered(5, 7)
    assert rows(ce.cluster(spark.createDataFrame(few, SCHEMA))) == by_hand(few)
    same = [(i, [0.5] * 64) for i in range(30)]
    assert rows(ce.cluster(spark.createDataFrame(same, SCHEMA))) == by_hand(same)


def test_empty_table(spark):
    got = ce.cluster(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and not got.collect()


def test_components_that_would_overflow_raise(spark):
    with pytest.raises(Exception, match="would not fit"):
        ce.cluster(spark.createDataFrame([(1, [1e6] * 64)], SCHEMA)).collect()


def test_only_expired_vectors_are_rescanned():
    vectors = np.array([v for _, v in scattered(2000, 11, 0.1)])
    block = ce.Block(np.floor(64 * vectors), 16)
    centres = np.floor(64 * vectors[:16]).astype(np.int64)
    counts, sums, scanned = block.advance(centres, [0.0] * 16)
    assert scanned == 2000 and counts.sum() == 2000
    first = block.owner.copy()
    # without drift only ties of the two nearest are looked at again
    assert block.advance(centres, [0.0] * 16)[2] <= sum(e[0] <= ce.MARGIN for heap in block.heaps for e in heap) + 100
    assert (block.owner == first).all()
    moved = centres.copy()
    moved[3] += 1
    drift = 8.0
    spent = [drift + (0.0 if c == 3 else 0.0) if c == 3 else drift for c in range(16)]
    _, _, scanned = block.advance(moved, spent)
    assert scanned < 1500
    assert (block.owner == ce._distances(block.vectors, moved).argmin(axis=1)).all()
    for heap in block.heaps:
        assert all(heap[(i - 1) // 2] <= heap[i] for i in range(1, len(heap)))
