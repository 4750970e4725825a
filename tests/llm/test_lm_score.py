import math
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from prevascope.llm import lm_score as op
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm.rows import SCHEMA, awkward, with_clashes


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def held(doc_id):
    return zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % 7 == 2


class Brute:
    """Prediction by partial matching with explicit escapes and sets of excluded bytes."""

    def __init__(self, texts, rare):
        self.seen = defaultdict(Counter)
        grams = 0
        for text in texts:
            data = [op.PAD] * op.ORDER + list(lower(text).encode()) + [op.END]
            grams += len(data)
            for i in range(op.ORDER, len(data)):
                for k in range(op.ORDER + 1):
                    self.seen[tuple(data[i - k : i])][data[i]] += 1
        self.least = rare * grams

    def log(self, data, i):
        excluded, p = set(), 1.0
        for k in range(op.ORDER, -1, -1):
            all_ = {s: n for s, n in self.seen.get(tuple(data[i - k : i]), {}).items() if n}
            kept = {s: n for s, n in all_.items() if n >= self.least and s != op.PAD}
            if not kept:
                continue
            total = sum(all_.values())
            left = 1 - sum((n - 0.5) / total for s, n in kept.items() if s in excluded)
            if data[i] in kept:
                return math.log10(p * (kept[data[i]] - 0.5) / total / left)
            p *= (1 - sum((n - 0.5) / total for n in kept.values())) / left
            excluded |= set(kept)
        return math.log10(p / (op.SYMBOLS - len(excluded)))

    def score(self, text):
        data = [op.PAD] * op.ORDER + list(lower(text).encode()) + [op.END]
        return sum(self.log(data, i) for i in range(op.ORDER, len(data)))


def base_of(data):
    count, n = Counter(), 0
    tokens = lambda t: [*re.findall("[^\x20\x09-\x0d]+", lower(t)), None]
    for doc_id, text in data:
        if not held(doc_id):
            count.update(tokens(text))
    n = sum(count.values())
    return n, {
        (i, t): (len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in tokens(t)))
        for i, t in data
    }


def compare(spark, data, got, rare):
    model = Brute([t for i, t in data if not held(i)], rare)
    n, base = base_of(data)
    expected = sorted(((i, held(i), *base[i, t][:2], n, base[i, t][2], model.score(t)) for i, t in data), key=repr)
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    assert len(got) == len(expected)
    key = lambda r: (repr(r[0]), r[2], round(r[5], 5), round(r[6], 5))
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-7)


@pytest.mark.parametrize("rare", [op.RARE, 2.0**-12])
def test_sample(spark, monkeypatch, rare):
    monkeypatch.setattr(op, "RARE", rare)
    monkeypatch.setattr(op, "RARE_WORD", rare)
    docs = table(spark, SAMPLE, "documents").where("n_chars < 900")
    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    compare(spark, data, op.score(docs), rare)


def test_probabilities_add_up_to_one():
    texts = ["the cat sat on the mat. the end", "thé ünd", "", "cats and mats"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    learned = np.concatenate([gram for _, gram in op.text_grams(raw, starts, 1 << 20)])
    contexts = (b"\xff" * 5, b"e cat", b"zzzzz", b"on th", b"\xff\xffthe", b"qqqat")
    symbols = np.array([s for s in range(256) if s != op.PAD], np.uint64)
    asked = [np.uint64(int.from_bytes(c, "big") << 8) + symbols for c in contexts]
    values = np.unique(np.concatenate([learned, *asked]))
    own, seen = np.unique(learned, return_counts=True)
    n = np.zeros(len(values), np.int64)
    n[np.searchsorted(values, own)] = seen
    last, place = np.unique(values & np.uint64((1 << 8 * op.LOW) - 1), return_inverse=True)
    for least in (0, 2, 4):
        low = op.low_nodes(last, np.bincount(place, n, len(last)), least)
        log = op.group_logs(low, values, n, least)
        for each in asked:
            assert (10 ** log[np.searchsorted(values, each)]).sum() == pytest.approx(1, abs=1e-9)


def test_held_out_texts_beat_the_baseline(spark):
    got = op.score(table(spark, "/root/testdata/sf0.1", "documents")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_long_texts_in_parts(monkeypatch):
    """A text that is read in parts gives what it gives as a whole: its sum, words and each unusual gram once with its number."""
    text = b"abc" * 700 + b" abd" * 300
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": pa.array([text, b"", b"abc"], pa.binary())})
    known = np.sort(np.array([int.from_bytes(b"bcabca", "big"), int.from_bytes(b"abcabc", "big")], np.uint64))
    head, common = SimpleNamespace(value=(op.Lookup(known), np.array([-0.5, -0.25, 0.0]))), SimpleNamespace(value={b"abd": -1.0})
    whole = pa.Table.from_batches(op._scored(head, common)(iter([batch]))).to_pylist()
    monkeypatch.setattr(op, "_PART", 7)
    assert pa.Table.from_batches(op._scored(head, common)(iter([batch]))).to_pylist() == whole
    grams = Counter(int.from_bytes((b"\xff" * 5 + text + b"\xfe")[i : i + 6], "big") for i in range(len(text) + 1))
    assert whole[0]["score"] == pytest.approx(sum(grams[int(g)] * w for g, w in zip(known, (-0.5, -0.25))))
    unusual = {g["gram"]: g["n"] for g in whole[0]["tail_grams"]}
    assert unusual == {g: n for g, n in grams.items() if g not in set(map(int, known))}
    assert len(whole[0]["tail_grams"]) == len(unusual)


def test_awkward_rows(spark):
    docs = with_clashes(spark.createDataFrame(awkward(), SCHEMA))
    short = [r[:2] for r in awkward() if len(r[1] or "") < 1000]
    compare(spark, short, op.score(docs.where("text is null or length(text) < 1000")), op.RARE)
    assert len(op.score(docs).collect()) == len(awkward())
    assert op.score(docs.limit(0)).collect() == []
    only_held = [(i, "text") for i in range(60) if held(i)]
    got = op.score(spark.createDataFrame(only_held, "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(-5 * math.log10(255)) for r in got)


def test_rare_contexts_count_in_any_corpus(spark, monkeypatch):
    """A word seen once among 1.7 million bytes is learned; its grams reach the scores by broadcast and by join alike."""
    data = [(i, "plain words of a large text stand here again and again " * 60) for i in range(600) if not held(i)]
    first = next(i for i in range(10**6, 10**6 + 99) if held(i))
    data += [next((i, "xylqzwvb") for i in range(2 * 10**6, 2 * 10**6 + 3) if not held(i)), (first, "xylqzwvb"), (first + 7 * 10**6, "never")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    scores = {}
    for share in (op.HEAD, 2.0**-6, 2.0):
        monkeypatch.setattr(op, "HEAD", share)
        scores[share] = {r.doc_id: r.score for r in op.score(docs).collect()}
    model = Brute([t for i, t in data if not held(i)], 0)
    for got in scores.values():
        assert got[first] == pytest.approx(model.score("xylqzwvb"), rel=1e-7)
        assert got[first + 7 * 10**6] == pytest.approx(model.score("never"), rel=1e-7)


def test_groups_of_grams_in_parts(spark, monkeypatch):
    """Groups that span batches stay whole, however few rows are held."""
    monkeypatch.setattr(op, "_GROUPED", 1)
    logs, _ = op.gram_table(spark.createDataFrame([(f"text {i} of {i % 7} words".encode(), i % 3 > 0) for i in range(400)], "text binary, training boolean"))
    small = {r.gram: r.log for r in logs.collect()}
    monkeypatch.setattr(op, "_GROUPED", 1 << 20)
    logs, _ = op.gram_table(spark.createDataFrame([(f"text {i} of {i % 7} words".encode(), i % 3 > 0) for i in range(400)], "text binary, training boolean"))
    assert small == {r.gram: pytest.approx(r.log, rel=1e-12) for r in logs.collect()}
