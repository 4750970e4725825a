"""Toxicity as multiple-instance learning: labels of documents teach the scores of sentences.

A sentence scores ``sigmoid(bias + weights of its cue words)``, one without cue words 0. A document is toxic
unless none of its sentences is: ``1 - (1 - leak) * prod(1 - sentence)``. The leak takes up labels that
no sentence explains. Cue words are those found in more toxic texts, in different surroundings, than their
number of texts explains; copies of one text repeat the surroundings and so add nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import ALNUM, Lookup, bounded_batches, held_out, lowered, mixed, row_of, slices, text_bytes, text_key, text_or_empty, word_hashes
from prevascope.session import materialise

MODULUS, HELD_OUT, THRESHOLD = 3, 1, 0.7
#: Labelled documents of each class that the model is fitted on at most, those with the least hash of their id.
SAMPLE = 10_000
#: Cue words at most, their least number of surroundings in toxic texts, and least evidence (log-likelihood ratio).
CUES, LEAST_PLACES, LEAST_EVIDENCE = 1024, 5, 24.0
_STOPS = np.array([b in b".!?\n" for b in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Cue words (hashes), their weights, the bias of a sentence with cues and the leak."""

    cues: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    leak: float = 0.0

    def sentence_scores(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + sums)))


def sample_of(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic, weight) of at most ``size`` documents of each class outside the held-out fold."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id", MODULUS, HELD_OUT))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        .withColumn("weight", F.lit(max(1.0, counts.get(y, 0) / size)))
        for y in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic, place, n): each word of a toxic text with the surroundings where it first stands, else counts of texts."""
    for batch in batches:
        for part in slices(batch, "text"):
            raw, starts = text_bytes(part.column("text"))
            words, at = word_hashes(lowered(raw), starts, ALNUM)
            around = np.concatenate([[np.uint64(1)], words[:-1]]) * _STEP + np.concatenate([words[1:], [np.uint64(2)]]) if len(words) else words
            rows = row_of(at, starts)
            _, first = np.unique(mixed(words + rows.astype(np.uint64) * _STEP), return_index=True)  # once a text
            words, place, toxic = words[first], mixed(around[first]), part.column("toxic").to_numpy()[rows[first]] > 0
            w, p = words[toxic], place[toxic]
            clean, n = np.unique(words[~toxic], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([w, clean]).view(np.int64)), pa.array(np.arange(len(w) + len(clean)) < len(w)),
                 pa.array(np.concatenate([p, np.zeros(len(clean), np.uint64)]).view(np.int64)),
                 pa.array(np.concatenate([np.ones(len(w), np.int64), n]))],
                names=["word", "toxic", "place", "n"],
            )


def cue_words(train: DataFrame) -> np.ndarray:
    """Hashes of the words with the strongest evidence in ``train`` (text, toxic, weight; without weight each row counts one).

    Weights are brought to a mean of one, so that the share of toxic texts is the real one and evidence stays that of the sample.
    """
    rows = train.mapInArrow(_places, "word long, toxic boolean, place long, n long")
    bad = rows.where("toxic").select("word", "place").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("k"))
    bad = materialise(bad, "surroundings")
    good = rows.where("not toxic").groupBy("word").agg(F.sum("n").alias("m"))
    good = materialise(good, "clean-words")
    weight = F.col("weight") if "weight" in train.columns else F.lit(1.0)
    sizes = {r["bad"]: r for r in train.groupBy((F.col("toxic") > 0).alias("bad")).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w")).collect()}
    (n_bad, total_bad), (n_good, total_good) = ((sizes[y]["n"], sizes[y]["w"]) if y in sizes else (0, 0.0) for y in (True, False))
    if not total_bad:
        return np.zeros(0, np.uint64)
    both = bad.where(F.col("k") >= LEAST_PLACES).join(good, "word", "left").fillna(0, ["m"])
    share = total_bad / (total_bad + total_good)
    unit = (n_bad + n_good) / (total_bad + total_good)
    k, m = F.col("k") * F.lit(unit * total_bad / n_bad), F.col("m") * F.lit(unit * total_good / max(n_good, 1))
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(F.lit(0.0))
    evidence = 2 * (term(k, (k + m) * share) + term(m, (k + m) * (1 - share)))
    strong = both.withColumn("evidence", evidence).where((k > (k + m) * (0.5 + share / 2)) & (F.col("evidence") >= LEAST_EVIDENCE))
    best = strong.orderBy(F.desc("evidence"), "word").limit(CUES).select("word").collect()
    return np.array([r["word"] for r in best], np.int64).view(np.uint64)


def cues_in(raw: np.ndarray, starts: np.ndarray, cues: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, sentence, cue) and the byte where each such sentence begins; sentences are numbered over all texts."""
    words, at = word_hashes(lowered(raw), starts, ALNUM)
    cue = cues.find(words)
    at, cue = at[cue >= 0], cue[cue >= 0]
    borders = np.union1d(np.flatnonzero(_STOPS[raw]) + 1, starts) if len(at) else np.zeros(0, np.int64)
    number = np.searchsorted(borders, at, "right") - 1
    pairs = np.unique(np.stack([number, cue.astype(np.int64)]), axis=1) if len(at) else np.zeros((2, 0), np.int64)
    begin = borders[pairs[0]]
    return row_of(begin, starts), pairs[0], pairs[1], begin


def _bags(cues):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document: label, weight, and its sentences' cues as (sentence, cue) pairs."""
        table = Lookup(cues.value)
        for batch in batches:
            for part in slices(batch, "text"):
                raw, starts = text_bytes(part.column("text"))
                rows, sentences, found, _ = cues_in(raw, starts, table)
                cut = np.searchsorted(rows, np.arange(part.num_rows + 1))
                bags = [np.stack([sentences[a:b], found[a:b]], 1).ravel().tolist() for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), part.column("weight"), pa.array(bags, pa.list_(pa.int64()))], names=["toxic", "weight", "bag"]
                )

    return run


def fitted(cues: np.ndarray, bags: list, steps: int = 400, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """The most likely model of the labelled bags, by gradient steps with momentum."""
    y = np.array([b[0] for b in bags], float)
    weight = np.array([b[1] for b in bags], float)
    if not len(y) or not weight.sum():
        return Model()
    doc, sentence, cue = [], [], []
    for i, (_, _, bag) in enumerate(bags):
        pairs = np.array(bag, np.int64).reshape(-1, 2)
        doc.append(np.full(len(pairs), i))
        sentence.append(pairs[:, 0])
        cue.append(pairs[:, 1])
    doc, sentence, cue = (np.concatenate(x).astype(np.int64) for x in (doc, sentence, cue))
    _, one, sentence = np.unique(np.stack([doc, sentence]), axis=1, return_index=True, return_inverse=True)
    sentence, owner, n = sentence.ravel(), doc[one], len(one)
    base = min(max((y * weight).sum() / weight.sum(), 1e-4), 0.5)
    theta = np.concatenate([np.full(len(cues), 2.0), [0.0, np.log(base / (1 - base))]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(theta[-2] + np.bincount(sentence, theta[cue], n))))
        leak = 1 / (1 + np.exp(-theta[-1]))
        clean = np.log1p(-leak) + np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y))
        none = np.exp(clean)
        slope = weight * ((1 - y) - y * none / np.maximum(1 - none, 1e-9)) / weight.sum()  # by the log of being clean
        by_sentence = -p * slope[owner]
        grad = np.concatenate([np.bincount(cue, by_sentence[sentence], len(cues)), [by_sentence.sum(), -(leak * slope).sum()]])
        grad[:-1] -= decay * theta[:-1] * 2 / weight.sum()
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta = theta + rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-10)
    return Model(cues, theta[:-2], float(theta[-2]), float(1 / (1 + np.exp(-theta[-1]))))


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    """A model from the labelled rows outside the held-out fold; without any, one that scores 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sample = materialise(sample_of(labels.select("doc_id", "toxic"), size), "sample")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    # at most twice SAMPLE ids are broadcast
    known = docs.select("doc_id", text).join(F.broadcast(sample), "doc_id")
    # a label is of a document: rows that share its id would not be bounded by the sample
    known = known.groupBy("doc_id", "toxic", "weight").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "text")).alias("one"))
    known = materialise(known.select("one.text", "toxic", "weight"), "labelled")
    cues = cue_words(known)
    # only the sentences with cues reach the driver, of the bounded sample
    bags = known.mapInArrow(_bags(spark.sparkContext.broadcast(cues)), "toxic int, weight double, bag array<long>").collect()
    return fitted(cues, [tuple(b) for b in bags])


_SENTENCES = pa.list_(pa.struct([("at", pa.int64()), ("to", pa.int64()), ("score", pa.float64())]))


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        table = Lookup(m.cues)
        for batch in batches:
            for part in slices(batch, "text"):
                raw, starts = text_bytes(part.column("text"))
                rows, sentences, cues, begin = cues_in(raw, starts, table)
                _, first, inverse = np.unique(sentences, return_index=True, return_inverse=True)
                score = m.sentence_scores(np.bincount(inverse.ravel(), m.weights[cues], len(first))) if len(first) else np.zeros(0)
                owner, begin = rows[first], begin[first]
                clean = np.bincount(owner, np.log1p(-np.minimum(score, 1 - 1e-12)), part.num_rows) + np.log1p(-m.leak)
                found = [[] for _ in range(part.num_rows)]
                for row in np.unique(owner):  # positions of the sentences with cues, in code points
                    text = raw[starts[row] : starts[row + 1]]
                    point = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                    stops = np.append(np.flatnonzero(_STOPS[text]) + 1, len(text))
                    for s, p in zip(begin[owner == row] - starts[row], score[owner == row]):
                        end = stops[np.searchsorted(stops, s, "right")]
                        found[row].append({"at": int(point[s]), "to": int(point[end]), "score": float(p)})
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(-np.expm1(clean)), pa.array(found, _SENTENCES)],
                    names=["doc_id", "text_key", "score", "sentences"],
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Toxicity of every row of ``docs`` (doc_id, text).

    Returns doc_id, held_out, score (0 to 1), predicted (1 from ``THRESHOLD``), sentences, those with cue
    words (start, end in code points and score), and text_key. Null and empty texts score the leak alone; repeated rows
    score alike; an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", text_or_empty().cast("string").alias("text"), text_key().alias("text_key"))
    out = source.mapInArrow(
        _scored(spark.sparkContext.broadcast(model)),
        f"doc_id {kind}, text_key long, score double, sentences array<struct<at:bigint,to:bigint,score:double>>",
    )
    return out.select(
        "doc_id", held_out("doc_id", MODULUS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "sentences", "text_key",
    )
