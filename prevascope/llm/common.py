"""What several text operators share: bounded Arrow batches, word hashes, lower-casing, look-ups."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into arrays at once; a longer text is cut at a word boundary.
SEGMENT_BYTES = 1 << 21
#: Rows and bytes of an Arrow batch sent to Python.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = [0x20, *range(0x09, 0x0E)]
#: ``[^\x20\x09-\x0D]+``
NON_SPACE = np.array([b not in _SPACE for b in range(256)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
ALNUM = np.array([b in range(0x30, 0x3A) or b in range(0x61, 0x7B) or b >= 0x80 for b in range(256)])

_random = np.random.default_rng(20240229)
_BYTE_CODE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few enough rows for long texts; a smaller setting of the session stays."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        with suppress(PySparkException, ValueError):
            now = int(str(spark.conf.get(name)).rstrip("b") or 0)
            if now <= 0 or now > most:
                spark.conf.set(name, str(most))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """A 64-bit hash that, with doc_id, tells a row's decision apart from that of other rows with its id."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the rows whose doc_id and text key are in ``rejected`` (doc_id, text_key)."""
    gone = rejected.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (key == gone["gone_key"]), "left_anti")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column end to end, and where each row starts (one more than rows)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes stay."""
    return np.frombuffer(data.tobytes().translate(LOWER), np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalising mix of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SEGMENT_BYTES, 1 << int(n).bit_length()) + 1
    if size not in _powers:
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if size > SEGMENT_BYTES + 1:
            return tables[0], tables[1]
        _powers[size] = tables[0], tables[1]
    return _powers[size]


def word_bounds(data: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the words of many texts, a segment of about ``SEGMENT_BYTES`` at a time."""
    n, at = len(data), 0
    while at < n:
        end = min(at + SEGMENT_BYTES, n)
        while end < n:  # cut between words
            gaps = np.flatnonzero(~kind[data[at:end]])
            border = np.searchsorted(starts, end, "right") - 1
            cut = max(at + gaps[-1] + 1 if len(gaps) else at, starts[border] if border >= 0 else at)
            if cut > at:
                end = cut
                break
            end = min(end + SEGMENT_BYTES, n)
        inside = np.zeros(end - at + 2, bool)
        inside[1:-1] = kind[data[at:end]]
        first = inside[1:-1] & ~inside[:-2]
        last = inside[1:-1] & ~inside[2:]
        heads = starts[np.searchsorted(starts, at, "left") : np.searchsorted(starts, end, "left")] - at
        first[heads] = inside[1:-1][heads]
        tails = heads[heads > 0] - 1
        last[tails] = inside[1:-1][tails]
        yield np.flatnonzero(first) + at, np.flatnonzero(last) + at + 1
        at = end


def word_hashes(data: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of many texts in order, and the position of its first byte."""
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for first, last in word_bounds(data, starts, kind):
        if not len(first):
            continue
        low, high = first[0], last[-1]
        power, inverse = _power_tables(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data[low:high]] * power[: high - low], out=sums[1:])
        hashes.append(mixed((sums[last - low] - sums[first - low]) * inverse[first - low]))
        places.append(first)
    return np.concatenate(hashes), np.concatenate(places)


def row_of(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The row each byte position belongs to."""
    return np.searchsorted(starts, places, "right") - 1


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``most`` bytes of text each, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(lengths), 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, end - at)
        at = end


class Lookup:
    """Distinct 64-bit keys to row numbers by open addressing, in vectors."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("keys repeat")
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        todo = np.arange(len(keys), dtype=np.int32)
        slot = self._home(keys)
        while len(todo):
            free = self.rows[slot] < 0
            self.rows[slot[free]] = todo[free]  # the last writer of a slot wins
            self.keys[slot[free]] = keys[todo[free]]
            lost = self.rows[slot] != todo
            todo, slot = todo[lost], (slot[lost] + 1) & (len(self.keys) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 if absent."""
        slot = self._home(np.asarray(keys, np.uint64))
        rows = self.rows[slot]
        todo = np.flatnonzero((rows >= 0) & (self.keys[slot] != keys))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            at = slot[todo]
            rows[todo] = self.rows[at]
            todo = todo[(self.rows[at] >= 0) & (self.keys[at] != keys[todo])]
        return rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder
