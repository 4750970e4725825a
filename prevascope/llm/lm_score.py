"""Language-model scores: prediction by partial matching over bytes, next to a word baseline.

The model is a trie of byte contexts of up to ``ORDER`` bytes, counted over all training texts. A context
predicts the bytes seen after it with ``(count - 1/2) / total`` and leaves the rest as escape; after an escape
the next shorter context predicts among the bytes that the longer one did not offer (exclusion). As
a longer context's bytes are always among the shorter one's, the exclusion is a factor that depends
on the context alone, so each node stores its log probability and each context the log of its escape
over what exclusion leaves.

Every context seen in training counts. A score needs the probability of each gram (``DEPTH`` bytes) of a text, so one table
of all distinct grams, partitioned by the last ``LOW`` bytes of their contexts, holds them: a group has all that its
contexts of ``LOW`` to ``ORDER`` bytes need, and at most 2^24 grams. Nodes of up to ``LOW`` bytes, at most 2^24 too, go to all
tasks. Texts look frequent grams up in a broadcast copy and are joined with the table for the others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import LOWER, Lookup, bounded_batches, held_out, lowered, slices, text_bytes
from prevascope.session import materialise

MODULUS, HELD_OUT = 7, 2
ORDER = 5
DEPTH = ORDER + 1
#: Contexts' last bytes that grams are grouped by.
LOW = 3
#: Least share of positions of a node; 0 keeps every one.
RARE = 0.0
#: Least share of positions of a gram, and of tokens of a word, that all tasks know; others are joined.
HEAD, RARE_WORD = 2.0**-22, 2.0**-20
#: Bytes that UTF-8 never has: before the first byte of a text, and its end.
PAD, END = 0xFF, 0xFE
#: Symbols that can follow: all bytes but ``PAD``.
SYMBOLS = 255
_POSITIONS = 8 << 20
_PART = 1 << 20
_FEW_WORDS = 300_000
_GROUPED = 1 << 20


def padded(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, each after ``ORDER`` pads and before an end, more pads last; where each text's pads start."""
    n = len(starts) - 1
    begin = starts + np.arange(n + 1) * (ORDER + 1)
    out = np.full(begin[-1] + 8, PAD, np.uint8)
    out[begin[1:] - 1] = END
    place = np.ones(begin[-1], bool)
    for k in range(ORDER):
        place[begin[:-1] + k] = False
    place[begin[1:] - 1] = False
    out[:-8][place] = raw
    return out, begin


def grams(stream: np.ndarray, low: int, high: int) -> np.ndarray:
    """The ``DEPTH`` bytes from each of the places low to high, as a number."""
    view = np.ndarray((high - low,), ">u8", stream, low, (1,))
    return view.astype(np.uint64) >> np.uint64(8 * (8 - DEPTH))


def text_grams(raw: np.ndarray, starts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and gram of each byte and end of the texts, of at most so many places at a time."""
    stream, begin = padded(raw, starts)
    real = np.ones(begin[-1], bool)
    for k in range(1, ORDER + 1):
        real[begin[1:] - k] = False
    for low in range(0, int(begin[-1]), most):
        high = min(low + most, int(begin[-1]))
        row = np.repeat(np.arange(len(starts) - 1), np.diff(np.clip(begin, low, high)))
        yield row[real[low:high]], grams(stream, low, high)[real[low:high]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, seen, n) of all texts and of the training ones, summed up over many positions at a time."""
    held, size = [], 0

    def summed():
        keys, seen = np.unique(np.concatenate(held), return_counts=True)
        training = (keys & np.uint64(1)).astype(np.int64)
        columns = [(keys >> np.uint64(1)).view(np.int64), seen, seen * training]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "seen", "n"])

    for batch in batches:
        for part in slices(batch, "text", _PART):
            raw, starts = text_bytes(part.column("text"))
            training = part.column("training").to_numpy(zero_copy_only=False).astype(np.uint64)
            for row, gram in text_grams(lowered(raw), starts, _POSITIONS):
                if size + len(gram) > _POSITIONS and held:
                    yield summed()
                    held, size = [], 0
                held.append(gram << np.uint64(1) | training[row])
                size += len(gram)
    if held:
        yield summed()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the training texts."""
    tally: Counter = Counter()

    def summed():
        return pa.RecordBatch.from_arrays([pa.array(list(tally), pa.binary()), pa.array(list(tally.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            tally.update(text.as_buffer().to_pybytes().translate(LOWER).split())
            if len(tally) > _FEW_WORDS:
                yield summed()
                tally.clear()
    if tally:
        yield summed()


def deeper(values: np.ndarray, n: np.ndarray, least: float, shorter: np.ndarray, fallback: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability as nodes (0 for what is none) and log probability of the last byte of each value after the others.

    ``values`` hold all that stands after each of their contexts, once; those with ``n`` below ``least`` are no nodes.
    ``shorter`` and ``fallback`` are the two results for each value without its first byte.
    """
    _, context = np.unique(values >> np.uint64(8), return_inverse=True)
    node = n >= max(least, 1)
    total = np.bincount(context, n)
    prob = np.where(node, (n - 0.5) / np.maximum(total, 1)[context], 0.0)
    left = 1 - np.bincount(context, prob)
    excluded = np.bincount(context, np.where(node, shorter, 0.0))
    has = np.bincount(context, node) > 0
    escape = np.where(has, np.log10(np.maximum(left, 1e-300) / np.maximum(1 - excluded, 1e-300)), 0.0)
    return prob, np.where(node, np.log10(np.where(node, prob, 1.0)), escape[context] + fallback)


def _suffixes(values: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct last ``size`` bytes, the sum of each, and where each value's are."""
    own, place = np.unique(values & np.uint64((1 << 8 * size) - 1), return_inverse=True)
    return own, np.bincount(place, n, len(own)), place


def low_nodes(values: np.ndarray, n: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of ``LOW`` bytes in order, their probability as nodes and their log probability."""
    levels = [(values, n, np.arange(len(values)))]
    for size in range(LOW - 1, 0, -1):
        levels.append(_suffixes(levels[-1][0], levels[-1][1], size))
    bytes_, counts, _ = levels[-1]
    symbols = int((counts >= max(least, 1)).sum())
    zero = np.zeros(len(bytes_))
    prob, log = deeper(bytes_, counts, least, zero, zero - math.log10(max(SYMBOLS - symbols, 1)))
    for k in range(len(levels) - 2, -1, -1):
        place = levels[k + 1][2]
        prob, log = deeper(levels[k][0], levels[k][1], least, prob[place], log[place])
    return values, prob, log


def group_logs(low: tuple[np.ndarray, np.ndarray, np.ndarray], values: np.ndarray, n: np.ndarray, least: float) -> np.ndarray:
    """Log probabilities of distinct grams that hold whole groups by the last ``LOW`` bytes of the context."""
    levels = [(values, n, None)]
    for size in range(ORDER, LOW, -1):
        levels.append(_suffixes(levels[-1][0], levels[-1][1], size))
    place = np.searchsorted(low[0], levels[-1][0] & np.uint64((1 << 8 * LOW) - 1))
    prob, log = low[1], low[2]
    for own, counts, next_place in reversed(levels):
        prob, log = deeper(own, counts, least, prob[place], log[place])
        place = next_place
    return log


def _gram_logs(low, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, -1

        def result(part):
            gram, seen, n = (part[:, k] for k in range(3))
            logs = group_logs(low.value, gram.view(np.uint64), n, least)
            return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(seen), pa.array(logs)], names=["gram", "seen", "log"])

        for batch in batches:
            part = np.stack([batch.column(c).to_numpy() for c in ("gram", "seen", "n")], axis=1)
            groups = (part[:, 0] >> 8) & ((1 << 8 * LOW) - 1)
            if size >= _GROUPED and len(groups):
                ahead = int(np.searchsorted(groups, last, "right"))
                if ahead < len(groups):
                    yield result(np.concatenate([*held, part[:ahead]]))
                    held, size, part = [], 0, part[ahead:]
            if len(groups):
                held.append(part)
                size += len(part)
                last = groups[-1]
        if size:
            yield result(np.concatenate(held))

    return run


def gram_table(texts: DataFrame) -> tuple[DataFrame, int]:
    """(gram, seen, log) for each distinct gram of ``texts`` (text without nulls, training), learned from the training ones, and the sum of seen."""
    counts = texts.mapInArrow(_counted, "gram long, seen long, n long").groupBy("gram").agg(F.sum("seen").alias("seen"), F.sum("n").alias("n"))
    counts = materialise(counts, "grams")
    total, trained = counts.agg(F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    least = RARE * (trained + ORDER * texts.where("training").count()) if RARE else 0.0
    mask = (1 << 8 * LOW) - 1
    # at most 2^24 rows: LOW bytes
    lowest = counts.groupBy(F.col("gram").bitwiseAND(mask).alias("value")).agg(F.sum("n").alias("n")).toArrow()
    values, n = lowest.column("value").to_numpy().astype(np.uint64), lowest.column("n").to_numpy()
    order = np.argsort(values)
    low = texts.sparkSession.sparkContext.broadcast(low_nodes(values[order], n[order], least) if len(values) else (values, n, n))
    grouped = counts.withColumn("part", F.shiftright("gram", 8).bitwiseAND(mask)).repartition("part").sortWithinPartitions("part")
    logs = grouped.select("gram", "seen", "n").mapInArrow(_gram_logs(low, least), "gram long, seen long, log double")
    return materialise(logs, "logs"), total


_TAIL = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def _tail_grams(row: np.ndarray, gram: np.ndarray, rows: int) -> pa.Array:
    """Lists of the distinct grams of each row, each followed by its number."""
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (gram[1:] != gram[:-1]))[: len(row)])
    n = np.diff(np.append(first, len(row)))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=rows))]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(gram[first].view(np.int64)), pa.array(n)], names=["gram", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _scored(head, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (lookup, logs), known = head.value, common.value
        for batch in batches:
            for part in slices(batch, "text", _PART):
                raw, starts = text_bytes(part.column("text"))
                raw = lowered(raw)
                scores, content = np.zeros(part.num_rows), raw.tobytes()
                missed = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
                for row, gram in text_grams(raw, starts, _PART):
                    at = lookup.find(gram)
                    scores += np.bincount(row, logs[at], len(scores))  # -1, an unknown gram, is the zero at the end
                    missed.append((row[at < 0], gram[at < 0]))
                tail_grams = _tail_grams(*(np.concatenate(x) for x in zip(*missed)), part.num_rows)
                tokens, sums, found, tails = [], [], [], []
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                    words = Counter(content[a:b].split())
                    score, seen, tail = 0.0, 0, []
                    for word, n in words.items():
                        log = known.get(word)
                        if log is None:
                            tail.append({"word": word, "n": n})
                        else:
                            score += n * log
                            seen += n
                    tokens.append(sum(words.values()))
                    sums.append(score)
                    found.append(seen)
                    tails.append(tail)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores), pa.array(tokens, pa.int64()), pa.array(sums, pa.float64()),
                     pa.array(found, pa.int64()), pa.array(tails, _TAIL), tail_grams],
                    names=["doc_id", "score", "n_words", "common_score", "common_known", "tail", "tail_grams"],
                )

    return run


def score(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text), learned from the rows outside the held-out fold.

    Returns doc_id, held_out, n_tokens (words and one end), n_known, train_tokens, base_score and score (the log10
    probability of the lower-cased text with its end). Null text is empty: its end alone is scored. Repeated
    rows count each time and score alike. Without training rows every byte is equally likely. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    source = docs.select("doc_id", text)
    binary = source.select(F.col("text").cast("binary").alias("text"), (~held_out("doc_id", MODULUS, HELD_OUT)).alias("training"))
    logs, positions = gram_table(binary)
    training = binary.where("training").select("text")
    # at most 1 / HEAD grams have such a share
    frequent = logs.where(F.col("seen") >= HEAD * positions).select("gram", "log").toArrow()
    head = Lookup(frequent.column("gram").to_numpy().astype(np.uint64)), np.append(frequent.column("log").to_numpy(), 0.0)
    vocabulary = training.mapInArrow(_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    vocabulary = materialise(vocabulary, "vocabulary")
    n_words, n_kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = training.count()
    train_tokens, kinds = n_words + ends, n_kinds + (ends > 0)
    # at most 1 / RARE_WORD words have such a share
    common = {bytes(r["word"]): math.log10(r["c"] + 1) for r in vocabulary.where(F.col("c") >= RARE_WORD * train_tokens).toLocalIterator()}
    parts = source.mapInArrow(
        _scored(spark.sparkContext.broadcast(head), spark.sparkContext.broadcast(common)),
        f"doc_id {kind}, score double, n_words long, common_score double, common_known long, "
        "tail array<struct<word:binary,n:bigint>>, tail_grams array<struct<gram:bigint,n:bigint>>",
    )
    parts = materialise(parts.withColumn("row", F.monotonically_increasing_id()), "scores")
    tail = parts.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    rare = vocabulary.where(F.col("c") < RARE_WORD * train_tokens)
    known = tail.join(rare.hint("shuffle_hash"), "word").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_score"), F.sum("n").alias("tail_known")
    )
    rest = parts.select("row", F.explode("tail_grams").alias("t")).select("row", "t.gram", "t.n")
    unusual = logs.where(F.col("seen") < HEAD * positions).select("gram", "log")
    added = rest.join(unusual.hint("shuffle_hash"), "gram").groupBy("row").agg(F.sum(F.col("n") * F.col("log")).alias("added"))
    whole = parts.drop("tail", "tail_grams").join(known.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    whole = whole.join(added.withColumnRenamed("row", "q"), F.col("row") == F.col("q"), "left")
    n_tokens = F.col("n_words") + 1
    gained = F.col("common_score") + F.coalesce("tail_score", F.lit(0.0)) + F.lit(math.log10(ends + 1))
    return whole.select(
        "doc_id", held_out("doc_id", MODULUS, HELD_OUT).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("common_known") + F.coalesce("tail_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (gained - n_tokens * math.log10(train_tokens + kinds + 1)).alias("base_score"), (F.col("score") + F.coalesce("added", F.lit(0.0))).alias("score"),
    )
