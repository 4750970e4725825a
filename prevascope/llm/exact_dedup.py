"""Exact duplicates by composable polynomial fingerprints.

A text is a number in base ``B`` modulo two primes. The number of a text is put together from those
of its chunks: ``f(xy) = f(x) * B ** len(y) + f(y)``. Chunks are cut in the JVM, so Python never holds
more of a huge text than a batch of chunks. Texts of equal length and fingerprint are then compared
chunk by chunk with the text that stays; one that differs after all leaves its group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import bounded_batches
from prevascope.session import materialise

CHUNK_BYTES = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)

_TABLES = []
for _prime, _base in zip(PRIMES, BASES):
    _row = np.ones(CHUNK_BYTES, np.uint64)
    for _i in range(1, CHUNK_BYTES):
        _row[_i] = int(_row[_i - 1]) * _base % _prime
    _TABLES.append(_row[::-1].copy())  # highest power first

GROUP = ["fp1", "fp2", "n_bytes"]


def chunk_fingerprint(chunk: np.ndarray) -> tuple[int, int]:
    """Fingerprint of at most ``CHUNK_BYTES`` bytes; each byte counts as its value plus one."""
    values = chunk.astype(np.uint64) + np.uint64(1)
    return tuple(int((values * t[CHUNK_BYTES - len(values) :]).sum() % np.uint64(p)) for t, p in zip(_TABLES, PRIMES))


def combine(left: tuple[int, int], right: tuple[int, int], right_bytes: int) -> tuple[int, int]:
    """Fingerprint of two texts end to end."""
    return tuple((a * pow(b, right_bytes, p) + c) % p for a, c, b, p in zip(left, right, BASES, PRIMES))


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text from its chunks, which follow each other."""
    state = (0, 0)
    for batch in batches:
        chunks, numbers, last = batch.column("chunk"), batch.column("chunk_no").to_numpy(), batch.column("last").to_pylist()
        _, offsets, data = chunks.cast(pa.large_binary()).buffers()
        starts = np.frombuffer(offsets, np.int64, len(chunks) + 1)
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        rows, ones, twos = [], [], []
        for i, number in enumerate(numbers):
            piece = raw[starts[i] : starts[i + 1]]
            own = chunk_fingerprint(piece)
            state = combine(state, own, len(piece)) if number else own
            if last[i]:
                rows.append(i)
                ones.append(state[0])
                twos.append(state[1])
        kept = batch.select(["doc_id", "text_sha256", "n_bytes"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(ones, pa.int64()), pa.array(twos, pa.int64())],
            names=["doc_id", "text_sha256", "n_bytes", "fp1", "fp2"],
        )


def in_chunks(docs: DataFrame, *columns: str) -> DataFrame:
    """A row per chunk of the column ``bytes``, an empty one for an empty text."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / CHUNK_BYTES)).cast("int")
    numbered = docs.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), count - 1)))
    return numbered.select(
        *columns,
        "chunk_no",
        F.substring("bytes", F.col("chunk_no") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)).alias("chunk"),
        (F.col("chunk_no") == count - 1).alias("last"),
    )


def _as_bytes(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select("doc_id", raw.alias("bytes")).select(
        "doc_id", "bytes", F.sha2("bytes", 256).alias("text_sha256"), F.octet_length("bytes").cast("long").alias("n_bytes")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, n_bytes, fp1, fp2 of every row of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunks = in_chunks(_as_bytes(docs), "doc_id", "text_sha256", "n_bytes")
    return chunks.mapInArrow(_combined, f"doc_id {kind}, text_sha256 string, n_bytes long, fp1 long, fp2 long")


def _differing(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Members whose text is not that of the row that stays, by comparing chunks."""
    same_row = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_sha256"] == b["text_sha256"])
    once = members.select("doc_id", "text_sha256", *GROUP, "keeper").distinct()
    source = _as_bytes(docs).drop("n_bytes")
    moved = once.join(source, same_row(once, source)).select(
        once["doc_id"], once["text_sha256"], *GROUP, "keeper", "bytes"
    )
    is_keeper = F.struct("doc_id", "text_sha256").eqNullSafe(F.col("keeper"))
    chunks = in_chunks(moved.withColumn("is_keeper", is_keeper), "doc_id", "text_sha256", *GROUP, "is_keeper")
    chunks = materialise(chunks.drop("last"), "chunks")
    kept = chunks.where("is_keeper").select(*GROUP, "chunk_no", F.col("chunk").alias("kept_chunk"))
    kept = materialise(kept.dropDuplicates([*GROUP, "chunk_no"]), "kept")  # a repeated row stays once
    both = chunks.where("not is_keeper").join(kept, [*GROUP, "chunk_no"])
    return both.where("chunk != kept_chunk").select("doc_id", "text_sha256", *GROUP).distinct()


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """The class of every row of ``docs`` (doc_id, text; other columns are ignored).

    Returns doc_id, keep_id (largest doc_id of the equal texts), group_size, kept, text_sha256.
    A null text counts as empty; a null doc_id sorts below every other. Rows that repeat both doc_id
    and text are all counted and share their decision. An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    prints = materialise(fingerprints(docs), "fingerprints")
    settled, todo, round_no = None, prints, 0
    while True:
        row = F.struct("doc_id", "text_sha256")
        groups = todo.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("group_size"), F.max(row).alias("keeper"))
        groups = materialise(groups.where("group_size > 1"), "groups")
        members = todo.join(groups, GROUP)
        members = materialise(members, "members")
        apart = materialise(_differing(docs, members), "apart")
        split = not apart.isEmpty()
        if not split:
            placed = members
        else:  # texts that only share a fingerprint form groups of their own
            on = [members[c].eqNullSafe(apart[c]) for c in ("doc_id", "text_sha256", *GROUP)]
            condition = on[0] & on[1] & on[2] & on[3] & on[4]
            equal = materialise(members.join(apart, condition, "left_anti"), "equal")
            sizes = equal.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("group_size"), F.max("keeper").alias("keeper"))
            placed = equal.drop("group_size", "keeper").join(sizes, GROUP)
            todo = materialise(members.join(apart, condition, "left_semi").drop("group_size", "keeper"), "todo")
        placed = placed.select("doc_id", "text_sha256", "group_size", "keeper").distinct()
        settled = placed if settled is None else settled.unionByName(placed)
        round_no += 1
        if not split:
            break
    settled = settled.where("group_size > 1").select(
        F.col("doc_id").alias("m_id"), F.col("text_sha256").alias("m_sha"), "group_size", F.col("keeper.doc_id").alias("keep_id")
    )
    joined = prints.join(
        settled, prints["doc_id"].eqNullSafe(settled["m_id"]) & (prints["text_sha256"] == settled["m_sha"]), "left"
    )
    single = F.col("m_sha").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(single, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )
