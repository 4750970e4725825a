import numpy as np
import pytest
from pyspark.sql import functions as F

from prevascope.llm import jaccard_join as jj
from tests.llm.rows import SCHEMA, awkward, rows, with_clashes


def by_hand(docs):
    """Components from all pairs."""
    sets = [(d, jj.shingles(t)) for d, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if jj.linked(sets[i][1], sets[j][1]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        ids = low.setdefault(find(i), [])
        ids += [d] if d is not None else []
    return sorted([(d, len(s), min(low[find(i)], default=None) if s else d) for i, (d, s) in enumerate(sets)], key=repr)


def family(random, size, n, changes):
    """``n`` variants of one text of ``size`` words with up to ``changes`` words replaced, one after the other or from the first."""
    base = [f"w{x}" for x in random.integers(0, 10_000, size)]
    out, last = [], base
    for k in range(n):
        words = list(last if k % 3 else base)
        for at in random.integers(0, size, random.integers(0, changes + 1)):
            words[at] = f"v{random.integers(0, 10_000)}"
        out.append(" ".join(words))
        last = words
    return out


def test_links_of_all_sizes(spark):
    random, texts = np.random.default_rng(1), []
    for size in (1, 2, 3, 9, 10, 11, 12, 13, 20, 25, 40, 60, 100, 300, 900):
        texts += family(random, size, 14, max(1, size // 45))
    docs = list(enumerate(texts))
    random.shuffle(docs)
    docs = [(int(i), str(t)) for i, t in docs]
    got = rows(jj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")))
    want = by_hand(docs)
    assert got == want and len({w[2] for w in want}) < len(want) - 50


def test_awkward_rows(spark):
    docs = [*awkward(), (20, "a b"), (21, "A  B"), (22, "a b c"), (23, "b a"), (None, "a b")]
    frame = spark.createDataFrame([(*d, None, None, None)[:5] for d in docs], SCHEMA)
    assert rows(jj.jaccard_components(with_clashes(frame))) == by_hand([d[:2] for d in docs])


def test_empty_table(spark):
    got = jj.jaccard_components(spark.createDataFrame([], "doc_id long, text string"))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and not got.collect()


@pytest.mark.parametrize("size", [10, 18, 19, 28, 38, 39, 95, 400, 5000])
def test_linked_sets_share_a_key_and_sketches_bound_the_difference(size):
    random = np.random.default_rng(size)
    for _ in range(60):
        union = random.integers(1, 1 << 63, size, dtype=np.uint64)
        apart = int(random.integers(0, size // 10 + 1))
        cut = int(random.integers(0, apart + 1))
        left, right = union[: size - cut], union[apart - cut :]
        if 100 * (size - apart) < 90 * size:
            continue
        met = False
        for layout in set(jj._layouts(len(left))) & set(jj._layouts(len(right))):
            a, b = jj.sketch(left, layout), jj.sketch(right, layout)
            sketches = len(a) // jj.segments(layout)
            assert np.bitwise_count(a ^ b).sum() <= sketches * apart <= sketches * jj.most_different(len(left), len(right))
            met |= bool(set(jj.keys(a, layout)) & set(jj.keys(b, layout)))
        assert met or apart == 0


@pytest.mark.parametrize("size", [10, 19, 38, 95, 400, 5000])
def test_folded_sketches_bound_the_difference(size):
    random = np.random.default_rng(size)
    union = random.integers(1, 1 << 63, size, dtype=np.uint64)
    for apart in (0, 1, size // 20, size // 3):
        left, right = union, union[apart:]
        for layout in jj._layouts(size):
            a, b = jj.sketch(left, layout), jj.sketch(right, layout)
            assert jj.fold(a).nbytes * 4 == a.nbytes
            assert np.bitwise_count(jj.fold(a) ^ jj.fold(b)).sum() <= len(a) // jj.segments(layout) * apart
            assert set((jj.keys(a, layout) & np.uint64(511)).tolist()) == {layout}


def test_bands_of_linked_sizes_touch():
    for a in [*range(1, 3000), 10**6, 10**9]:
        assert jj.band_of(100 * a // 90) - jj.band_of(a) in (0, 1)


def test_tiles_of_a_large_bucket_stay_linear(spark):
    """Two components of 100,000 members each in one bucket."""
    members = spark.range(200_000).select(
        F.lit(7).cast("long").alias("key"), F.col("id").alias("node"), (F.col("id") % 2).alias("root"), F.lit(100).cast("long").alias("n_shingles")
    )
    dealt = jj.tiles(members)
    assert dealt.count() < 20 * 200_000
    # a small component costs the large one a single copy
    few = members.withColumn("root", (F.col("node") < 5).cast("long"))
    assert jj.tiles(few).count() < 200_100
    # all pairs of members of two components meet, and blocks are bounded
    pairs = jj.tiles(members.where("node < 300")).groupBy("i", "j").agg(F.countDistinct("root").alias("roots"))
    assert pairs.where("i != j").agg(F.min("roots")).first()[0] == 2
    assert dealt.groupBy("i", "j", "own").count().agg(F.max("count")).first()[0] < 1.2 * jj.BLOCK_SHINGLES / jj.LEAST


def test_links_between_components_of_a_bucket(spark, monkeypatch):
    """Chains of variants where the pivot is linked to few members."""
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 2048)
    random = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(120):
        words = list(words)
        for at in random.integers(0, 400, 4):
            words[at] = f"x{i}-{at}"
        docs.append((i, " ".join(words)))
    assert rows(jj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))) == by_hand(docs)


def test_only_texts_of_candidates_move(spark, monkeypatch):
    """Texts that share buckets with others, but differ too much from them, are told apart by their sketches."""
    stored, store = {}, jj.materialise

    def noted(frame, name="stage"):
        out = store(frame, name)
        stored[name] = stored.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jj, "materialise", noted)
    random = np.random.default_rng(6)
    base, docs = [f"w{i}" for i in range(300)], []
    for i in range(80):
        words = list(base)
        for at in random.choice(300, 25, replace=False):
            words[at] = f"x{i}-{at}"
        docs.append((i, " ".join(words)))
    docs += [(100 + i, docs[i][1] + " more") for i in (7, 40)]
    assert rows(jj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))) == by_hand(docs)
    assert stored["pairs"] > 10
    assert 4 <= stored["texts"] <= 8


def test_marks_let_all_texts_asked_for_pass(spark, monkeypatch):
    keys = [int(x) for x in np.random.default_rng(7).integers(-(1 << 63), 1 << 63, 20_000)] + [0, -1, (1 << 63) - 1, -(1 << 63)]
    docs = spark.createDataFrame([(i, f"t{i}", k) for i, k in enumerate(keys)], "doc_id long, text string, text_key long").repartition(3)
    wanted = docs.where("doc_id % 100 = 0 or doc_id >= 20000").select(F.col("doc_id").alias("node"), "doc_id", "text_key")
    ids = lambda frame: {r["doc_id"] for r in frame.collect()}
    got = ids(jj.marked(docs, wanted))
    assert ids(wanted) <= got and len(got) < 1.1 * wanted.count() + 400
    assert not ids(jj.marked(docs, wanted.where("false")))
    monkeypatch.setattr(jj, "MARKS", 1 << 15)
    assert ids(jj.marked(docs, wanted)) >= ids(wanted)
    assert ids(jj.marked(docs, docs.withColumn("node", F.col("doc_id")))) == set(range(len(keys)))
