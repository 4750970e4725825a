import zlib
from collections import Counter

import numpy as np
import pytest

from prevascope.llm import toxicity as op
from prevascope.llm.common import table
from tests.llm.rows import SCHEMA, awkward, with_clashes

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return op.train(table(spark, BIG, "documents"), table(spark, BIG, "labels"))


def test_held_out_accuracy(spark, model):
    """Documents whose labels the model never saw."""
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    got = op.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    tally = Counter((r.toxic, r.predicted) for r in got)
    assert tally[1, 1] / (tally[1, 1] + tally[1, 0]) > 0.8 and tally[0, 1] / (tally[0, 1] + tally[0, 0]) < 0.01
    for r in got[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1


def test_scores_are_the_noisy_or_of_sentences(spark, model):
    docs = table(spark, BIG, "documents")
    for r in op.score(docs, model).limit(3000).collect():
        clean = (1 - model.leak) * np.prod([1 - s.score for s in r.sentences])
        assert r.score == pytest.approx(1 - clean, abs=1e-9) and r.predicted == (r.score >= 0.7)


def test_offending_sentences_are_located(spark, model):
    text = "Ünd this is fine. You moron, pathetic trash! The end of it."
    data = [(1, text), (2, "Nothing of the kind. Fine."), (3, "moron stupid"), (4, None), (5, "")]
    got = {r.doc_id: r for r in op.score(spark.createDataFrame(data, "doc_id long, text string"), model).collect()}
    assert [text[s.at : s.to].strip() for s in got[1].sentences] == ["You moron, pathetic trash!"]
    assert got[1].predicted == 1 and got[3].predicted == 1
    assert got[4].score == got[5].score == pytest.approx(model.leak) and got[2].predicted == 0


def test_copies_of_one_text_teach_no_cue(spark):
    data = [(i, "zorp blim walks along the river each day", 1) for i in range(200)]
    data += [(300 + i, f"a{i} plain b{i} text", 0) for i in range(300)]
    train = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    assert len(op.cue_words(train)) == 0


def test_awkward_rows(spark):
    docs = with_clashes(spark.createDataFrame(awkward(), SCHEMA))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = op.score(docs, op.train(docs, known)).collect()
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in awkward())
        assert all(0 <= r.score <= 1 for r in got)
    assert op.score(docs.limit(0), op.Model()).collect() == []


def weighted_train(spark, n_clean, weight):
    """'vile' is in 80 toxic texts of 200 and in one of ten clean ones, 'foul' in all toxic ones and no clean one."""
    data = [(f"plain{i} vile other{i} foul x{i} word" if i < 80 else f"plain{i} foul x{i} word", 1, 1.0) for i in range(200)]
    data += [(f"clean{i} vile word" if i % 10 == 0 else f"clean{i} word", 0, weight) for i in range(n_clean)]
    return spark.createDataFrame(data, "text string, toxic int, weight double")


def test_cue_words_do_not_depend_on_the_size_of_the_sample(spark):
    """A clean class that is cut to a tenth and weighs ten times as much gives the cue words of the whole class."""
    whole = set(op.cue_words(weighted_train(spark, 2000, 1.0)).tolist())
    assert len(whole) == 1 and set(op.cue_words(weighted_train(spark, 200, 10.0)).tolist()) == whole


def test_one_row_of_each_labelled_document(spark, monkeypatch):
    docs = [(1, f"text number {i % 3}") for i in range(90)] + [(i, "other text") for i in range(2, 12)]
    labels = spark.createDataFrame([(i, 1) for i in range(1, 12)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(op, "fitted", lambda cues, bags: seen.append(bags) or op.Model())
    op.train(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    assert len(seen[0]) == op.sample_of(labels).count()
