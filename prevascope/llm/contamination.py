"""Benchmark passages in documents by multi-pattern search after Wu and Manber, over words.

Symbols are word hashes. A window of a benchmark item is a pattern. The shift table says for each block of
two words how far the search may move on; where it says zero, the patterns whose last block
hashes alike are compared, first by hashes, then word for word. Many stretches of text are
searched side by side in vectors.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import (
    ALNUM, LOWER, bounded_batches, lowered, mixed, row_of, slices, text_bytes, text_key, text_or_empty, word_bounds, word_hashes,
)
from prevascope.session import materialise, scratch_path

WINDOW = 13
#: Windows of benchmark items that one pass searches for; more items take more passes.
PASS_WINDOWS = 500_000
_LANE = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEPARATE = bytes(b if ALNUM[b] else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER).translate(_SEPARATE).split()


def _blocks(hashes: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """A hash of the block of one or two words that ends at each place."""
    return hashes[ends] if size == 1 else mixed(hashes[ends - 1] * _STEP + hashes[ends])


class Patterns:
    """Patterns of one length in words, with their shift table and suffix buckets."""

    def __init__(self, texts: list[bytes], owners: list[list[str]]):
        raw = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        hashes, _ = word_hashes(raw, starts, ALNUM)
        self.length = len(hashes) // len(texts)
        grid = hashes.reshape(len(texts), self.length)
        self.block = min(2, self.length)
        ends = np.arange(self.block - 1, self.length)
        places = (np.arange(len(texts))[:, None] * self.length + ends).ravel()
        keys = _blocks(hashes, places, self.block).reshape(len(texts), -1)
        self.bits = max(16, int(8 * keys.size).bit_length())
        self.shift = np.full(1 << self.bits, self.length - self.block + 1, np.uint8)
        np.minimum.at(self.shift, self._slot(keys).ravel(), np.tile(self.length - 1 - ends, len(texts)).astype(np.uint8))
        order = np.argsort(keys[:, -1], kind="stable")
        self.suffixes, self.grid = keys[order, -1], grid[order]
        self.texts, self.owners = [texts[i] for i in order], [owners[i] for i in order]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, pattern) where all word hashes agree."""
        n = len(hashes)
        lanes = np.arange(0, n, _LANE)
        at, end = np.maximum(lanes, self.length - 1), np.minimum(lanes + _LANE, n)
        hits, patterns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while True:
            open_ = at < end
            at, end = at[open_], end[open_]
            if not len(at):
                break
            keys = _blocks(hashes, at, self.block)
            move = self.shift[self._slot(keys)]
            zero = move == 0
            if zero.any():
                low = np.searchsorted(self.suffixes, keys[zero], "left")
                count = np.searchsorted(self.suffixes, keys[zero], "right") - low
                ends = np.repeat(at[zero], count)
                which = np.repeat(low, count) + np.arange(len(ends)) - np.repeat(np.cumsum(count) - count, count)
                for t in range(self.length):  # from the first word on, which suffixes leave open
                    same = hashes[ends - self.length + 1 + t] == self.grid[which, t]
                    ends, which = ends[same], which[same]
                hits.append(ends)
                patterns.append(which)
            at = at + np.maximum(move, 1)
        return np.concatenate(hits), np.concatenate(patterns)


def patterns_of(windows: list[bytes], owners: list[list[str]]) -> list[Patterns]:
    """Search tables of distinct windows, those of each length together."""
    by_length = defaultdict(list)
    for text, items in sorted(zip(windows, owners)):
        by_length[text.count(b" ") + 1].append((text, items))
    return [Patterns([t for t, _ in group], [o for _, o in group]) for _, group in sorted(by_length.items())]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, item) for the windows of each item."""
    for batch in batches:
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            first = range(max(1, len(words) - WINDOW + 1)) if words else ()
            own = pa.array([b" ".join(words[i : i + WINDOW]) for i in first], pa.binary())
            yield pa.RecordBatch.from_arrays([own, pa.array([item] * len(own), pa.string())], names=["window", "item"])


def distinct_windows(benchmark: DataFrame, windows: int) -> tuple[str, int]:
    """Path of a table (window, owners) of the benchmark, partitioned into passes, and their number.

    Passes are dealt by the windows' hashes, so that each holds about ``windows`` pairs of a window and an item.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("string").alias("text"))
    pairs = items.mapInArrow(_windows, "window binary, item string")
    owned = materialise(pairs.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("owners")), "windows")
    total = owned.agg(F.sum(F.size("owners"))).head()[0] or 0
    n_passes = max(1, -(-total // windows))
    path = scratch_path(spark, "passes")
    dealt = owned.withColumn("pass", F.pmod(F.xxhash64("window"), F.lit(n_passes)))
    dealt.repartition("pass").write.partitionBy("pass").parquet(path)
    return path, n_passes


def passes(benchmark: DataFrame, windows: int = PASS_WINDOWS) -> Iterator[list[Patterns]]:
    """Patterns of the benchmark, about ``windows`` of them at a time; none for an empty one."""
    path, n_passes = distinct_windows(benchmark, windows)
    table = benchmark.sparkSession.read.schema("window binary, owners array<string>, pass long").parquet(path)
    for k in range(n_passes):
        held = table.where(F.col("pass") == k).select("window", "owners").toArrow()
        yield patterns_of(held.column("window").to_pylist(), held.column("owners").to_pylist())


def occurrences(patterns: list[Patterns], raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Words of each text, hits of every word (above 0), and (row, item) of the windows found."""
    hashes, places = word_hashes(raw, starts, ALNUM)
    rows = row_of(places, starts)
    marks, found = np.zeros(len(hashes) + 1, np.int32), set()
    ends_at = np.concatenate([np.zeros(0, np.int64), *(last for _, last in word_bounds(raw, starts, ALNUM))]) if len(hashes) else places
    known: dict[tuple[bytes, int], bool] = {}
    for group in patterns:
        ends, which = group.candidates(hashes)
        first = ends - group.length + 1
        inside = rows[first] == rows[ends] if len(ends) else np.zeros(0, bool)
        for i, j, p in zip(first[inside].tolist(), ends[inside].tolist(), which[inside].tolist()):
            piece = raw[places[i] : ends_at[j]].tobytes()
            if (piece, p) not in known:
                known[piece, p] = b" ".join(piece.translate(_SEPARATE).split()) == group.texts[p]
            if known[piece, p]:
                marks[i] += 1
                marks[j + 1] -= 1
                found |= {(int(rows[i]), item) for item in group.owners[p]}
        known.clear()
    return np.bincount(rows, minlength=len(starts) - 1), np.cumsum(marks[:-1]), sorted(found)


def _searched(patterns, last: bool):
    """Adds what this pass finds to the hit words (numbers) and items of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                raw, starts = text_bytes(part.column("text"))
                n_words, hits, found = occurrences(patterns.value, lowered(raw), starts)
                first = np.concatenate([[0], np.cumsum(n_words)])
                items = [set(x or ()) for x in part.column("items").to_pylist()]
                for row, item in found:
                    items[row].add(item)
                before = part.column("hit").to_pylist()
                hit = []
                for i in range(part.num_rows):
                    own = np.flatnonzero(hits[first[i] : first[i + 1]])
                    hit.append(own if not before[i] else np.union1d(own, np.array(before[i])))
                lists = [sorted(x) for x in items]
                if not last:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("text_key"), part.column("text"), pa.array([h.tolist() for h in hit], pa.list_(pa.int32())),
                         pa.array(lists, pa.list_(pa.string()))], names=["doc_id", "text_key", "text", "hit", "items"],
                    )
                    continue
                n_hit = np.array([len(h) for h in hit], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n_hit),
                     pa.array([len(x) for x in lists], pa.int64()),
                     pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists], pa.string()),
                     pa.array((n_hit > 0) & (20 * n_hit >= n_words)), part.column("text_key")],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "text_key"],
                )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, windows: int = PASS_WINDOWS) -> DataFrame:
    """How much of every row of ``docs`` (doc_id, text) comes from ``benchmark`` (item_id, text).

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key. An item of fewer than ``WINDOW`` words
    is one window; null and empty texts have no words and give no window; items that share an id count
    once, and a null id counts as the id ``null``. Repeated documents each get their row; empty tables give
    no rows or no hits. Spark finds the distinct windows and deals them into passes of bounded size, each over all
    documents; the driver builds the search tables of one pass at a time.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    none = F.lit(None)
    state = docs.select("doc_id", text_key().alias("text_key"), text_or_empty().cast("string").alias("text"),
                        none.cast("array<int>").alias("hit"), none.cast("array<string>").alias("items"))
    waiting = None
    for patterns in passes(benchmark, windows):
        if waiting is not None:
            between = f"doc_id {kind}, text_key long, text string, hit array<int>, items array<string>"
            state = materialise(state.mapInArrow(_searched(spark.sparkContext.broadcast(waiting), False), between), "searched")
        waiting = patterns
    found = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, text_key long"
    return state.mapInArrow(_searched(spark.sparkContext.broadcast(waiting), True), f"doc_id {kind}, {found}")
