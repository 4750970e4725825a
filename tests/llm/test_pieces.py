import hashlib
import math
from collections import Counter
from functools import cache

import numpy as np
import pytest
import sentencepiece

from prevascope.llm import pieces as op
from prevascope.llm.common import mixed, table
from tests.conftest import SAMPLE
from tests.llm.rows import SCHEMA, awkward, with_clashes


@pytest.fixture(scope="module")
def vocabulary():
    return op.load()


def all_paths(vocabulary, text):
    """Every segmentation of a short text with its probability, by plain recursion over the model's pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=op.MODEL)
    weight = dict(zip(vocabulary.ids.tolist(), vocabulary.weights.tolist()))
    known = {model.id_to_piece(i): i for i in weight}
    marked = "▁" + text.replace(" ", "▁")

    @cache
    def rest(at):
        if at == len(marked):
            return [((), 0.0)]
        out = []
        for n in range(1, 17):
            piece = marked[at : at + n]
            if len(piece) == n and piece in known:
                out += [((known[piece], *p), weight[known[piece]] + w) for p, w in rest(at + n)]
        if marked[at] not in known:
            spelled = tuple(int(vocabulary.byte_ids[b]) for b in marked[at].encode())
            out += [((*spelled, *p), vocabulary.byte_weight * len(spelled) + w) for p, w in rest(at + 1)]
        return out

    paths = rest(0)
    total = math.log(sum(math.exp(w) for _, w in paths))
    return {p: w - total for p, w in paths}


def keys(n, seed=0):
    return mixed(np.arange(seed * 10**6, seed * 10**6 + n).astype(np.uint64))


@pytest.mark.parametrize("text", ["ab", "the", "a cat", "né\n漢"])
def test_probabilities_and_frequencies(vocabulary, text):
    paths = all_paths(vocabulary, text)
    n = 4000
    found = op.sampled(vocabulary, [text] * n, keys(n), 2)
    first, pairs = Counter(), Counter()
    for rows in found:
        ids = [tuple(r[0].tolist()) for r in rows]
        assert len(set(ids)) == len(ids) == min(2, len(paths))
        for i, r in zip(ids, rows):
            assert r[1] == pytest.approx(paths[i], abs=1e-6)
        assert rows[0][2] > rows[-1][2] or len(rows) == 1
        first[ids[0]] += 1
        pairs[tuple(ids)] += 1
    for p, log in paths.items():  # the best is a plain sample
        assert abs(first[p] / n - math.exp(log)) < 5 * math.sqrt(math.exp(log) / n) + 1e-3
    best = sorted(paths, key=paths.get)[-2:]
    for a, b in [(best[1], best[0]), (best[0], best[1])] if len(best) == 2 else []:  # then one without replacement
        chance = math.exp(paths[a]) * math.exp(paths[b]) / (1 - math.exp(paths[a]))
        assert abs(pairs[a, b] / n - chance) < 5 * math.sqrt(chance / n) + 1e-3


def test_all_paths_come_out_once_if_asked_for(vocabulary):
    text = "one a"
    paths = all_paths(vocabulary, text)
    for rows in op.sampled(vocabulary, [text] * 20, keys(20, 1), len(paths) + 3):
        assert Counter(tuple(r[0].tolist()) for r in rows) == Counter(dict.fromkeys(paths, 1))
        values = [r[2] for r in rows]
        assert values == sorted(values, reverse=True) and all(r[3] == 0.0 for r in rows)  # none was left out


def test_inclusion_scores_weigh_rightly(vocabulary):
    """Samples weighted by probability over inclusion give an unbiased mean."""
    text, n = "the cat", 3000
    paths = all_paths(vocabulary, text)
    true = sum(math.exp(w) * len(p) for p, w in paths.items())
    found = op.sampled(vocabulary, [text] * n, keys(n, 2), 3)
    mean = np.mean([sum(math.exp(r[1] - r[3]) * len(r[0]) for r in rows) for rows in found])
    assert mean == pytest.approx(true, rel=0.05)


def test_round_trip_and_determinism(spark):
    docs = table(spark, SAMPLE, "documents")
    encoded = op.encode(docs)
    back = {}
    for r in op.decode(encoded).collect():
        back.setdefault(r.doc_id, []).append((r.text, tuple(r.pieces)))
    for r in docs.collect():
        assert all(t == r.text for t, _ in back[r.doc_id]) and len({p for _, p in back[r.doc_id]}) == len(back[r.doc_id])
    again = {(r.doc_id, r.sample_no): (r.pieces_sha256, r.round_trip) for r in op.encode(docs.repartition(7), digest=True).collect()}
    for r in encoded.collect():
        digest = hashlib.sha256(np.array(r.pieces, "<i4").tobytes()).hexdigest()
        assert again[r.doc_id, r.sample_no] == (digest, True)


def test_windows_change_nothing(vocabulary, monkeypatch):
    texts = ["Some words here, and\nmore words there.", "", "x" * 300, "▁ own mark ▁"]
    before = op.sampled(vocabulary, texts, keys(4), 4)
    monkeypatch.setattr(op, "_WINDOW", 10)
    after = op.sampled(vocabulary, texts, keys(4), 4)
    for a, b, text in zip(before, after, texts):
        assert [x[0].tolist() for x in a] == [x[0].tolist() for x in b]
        assert all(op.decoded(vocabulary, x[0]) == text for x in a) and len(a) == (4 if text else 1)


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    got = op.encode(with_clashes(docs), digest=True).collect()
    assert all(r.round_trip for r in got)
    assert {r.doc_id for r in got} == {r[0] for r in awkward()}
    assert Counter(r.doc_id for r in got)[2] == 4 and [r.n_pieces for r in got if r.doc_id in (3, 4)] == [0, 0]
    assert op.encode(docs.limit(0)).collect() == []
