import hashlib
from collections import defaultdict

import numpy as np
import pytest

from prevascope.llm import exact_dedup as op
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm.rows import SCHEMA, awkward, rows, with_clashes


def brute(data):
    groups = defaultdict(list)
    for doc_id, text, *_ in data:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text, *_ in data:
        ids = groups[text or ""]
        keep = max(ids, key=lambda i: (i is not None, i))
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_fingerprints_of_parts_combine():
    data = np.random.default_rng(1).integers(0, 256, 1000, dtype=np.uint8)
    whole = op.chunk_fingerprint(data)
    for cut in (0, 1, 499, 1000):
        assert op.combine(op.chunk_fingerprint(data[:cut]), op.chunk_fingerprint(data[cut:]), 1000 - cut) == whole
    assert op.chunk_fingerprint(np.zeros(3, np.uint8)) != op.chunk_fingerprint(np.zeros(4, np.uint8))


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    assert rows(op.exact_duplicates(with_clashes(docs))) == brute(awkward())
    assert rows(op.exact_duplicates(docs.limit(0))) == []


def test_sample(spark):
    docs = table(spark, SAMPLE, "documents")
    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(op.exact_duplicates(docs)) == brute(data)


def test_equal_fingerprints_of_different_texts_are_told_apart(spark, monkeypatch):
    """Fingerprints made to clash: the comparison of chunks alone must separate the texts."""
    honest = op.fingerprints

    def clashing(docs):
        from pyspark.sql import functions as F

        return honest(docs).withColumns({"fp1": F.lit(1).cast("long"), "fp2": F.lit(1).cast("long")})

    monkeypatch.setattr(op, "fingerprints", clashing)
    data = [(i, t) for i, t in enumerate(["aaaa", "bbbb", "aaaa", "cccc", "bbbb", "dddd", None])]
    assert rows(op.exact_duplicates(spark.createDataFrame(data, "doc_id long, text string"))) == brute(data)


@pytest.mark.parametrize("size", [op.CHUNK_BYTES - 1, op.CHUNK_BYTES, op.CHUNK_BYTES + 1, 3 * op.CHUNK_BYTES])
def test_chunk_borders(spark, size):
    data = [(1, "y" * size), (2, "y" * size), (3, "y" * (size - 1) + "z")]
    assert rows(op.exact_duplicates(spark.createDataFrame(data, "doc_id long, text string"))) == brute(data)
