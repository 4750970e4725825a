"""Centroid clustering in exact integers, with heap-ordered bounds.

A vector keeps its cluster while its distance to every other centroid stays above that to its own. The gap between the two nearest
distances shrinks, each time centroids move, by at most the drift of its own centroid and the largest drift of another.
Vectors lie in stored blocks. In each block every cluster has a heap of gaps, each raised by the drift spent when the vector came
in, so that nothing in the heap changes as centroids move: a round pops what lies below the drift spent by now,
rescans these vectors alone, and pushes them into the heaps of their clusters. What moved is summed per block, so that a
round reads counts and sums of changes only.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import bounded_batches
from prevascope.session import materialise

COMPONENTS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
#: Scaled components beyond this would let a squared distance pass 2^63.
LARGEST = 1 << 24
#: Vectors in a block.
BLOCK = 4096
#: Above the rounding error of bounds on distances up to 2^29.
MARGIN = 1e-5

_STATE = "vectors binary, owner binary, gaps binary, members binary, ends binary, counts array<long>, sums array<long>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors in whole numbers."""

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        scaled = np.floor(SCALE * table.column("vector").combine_chunks().flatten().to_numpy())
        if len(scaled) and np.abs(scaled).max() > LARGEST:
            raise ValueError(f"a component is beyond {LARGEST // SCALE}: squared distances would not fit into a long")
        ids = table.column("vec_id").combine_chunks()
        ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays([ids, pa.array([scaled.astype(np.int32).tobytes()], pa.binary())], names=["ids", "vectors"])

    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            if size + part.num_rows > BLOCK:
                yield block(held)
                held, size = [], 0
            held, size = [*held, part], size + part.num_rows
    if size:
        yield block(held)


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of vectors (rows) to centroids (columns)."""
    return (vectors**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * (vectors @ centroids.T)


class Block:
    """Vectors with their clusters and a heap of (gap, vector) for each cluster."""

    def __init__(self, vectors: np.ndarray, clusters: int):
        self.vectors = vectors.astype(np.int64)
        self.owner = np.full(len(vectors), -1, np.int16)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(clusters)]

    def advance(self, centroids: np.ndarray, spent: list[float]) -> tuple[np.ndarray, np.ndarray, int]:
        """Assign anew what may have changed; changes of each cluster's count and sum, and the number of vectors rescanned."""
        todo = list(range(len(self.vectors))) if len(self.owner) and self.owner[0] < 0 else []
        for heap, limit in zip(self.heaps, spent):
            while heap and heap[0][0] <= limit + MARGIN:
                todo.append(heapq.heappop(heap)[1])
        rows = np.array(todo, np.int64)
        squares = _distances(self.vectors[rows], centroids)
        near = squares.argmin(axis=1)  # the first of equal ones
        own = squares[np.arange(len(rows)), near]
        squares[np.arange(len(rows)), near] = np.iinfo(np.int64).max
        gaps = np.sqrt(squares.min(axis=1)) - np.sqrt(own) if len(centroids) > 1 else np.full(len(rows), np.inf)
        for row, cluster, gap in zip(todo, near.tolist(), gaps.tolist()):
            heapq.heappush(self.heaps[cluster], (gap + spent[cluster], row))
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        moved = near != self.owner[rows]
        for cluster, sign in ((self.owner[rows], -1), (near, 1)):
            known = moved & (cluster >= 0)
            np.add.at(counts, cluster[known], sign)
            np.add.at(sums, cluster[known], sign * self.vectors[rows[known]])
        self.owner[rows] = near
        return counts, sums, len(rows)


def _advanced(centroids: np.ndarray, spent: list[float]):
    """Blocks after a round; those without clusters yet are scanned whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names if c != "ids"}
                block = Block(np.frombuffer(row["vectors"], np.int32).reshape(-1, COMPONENTS), len(centroids))
                if row["owner"] is not None:
                    block.owner = np.frombuffer(row["owner"], np.int16).copy()
                    entries = list(zip(np.frombuffer(row["gaps"], np.float64).tolist(), np.frombuffer(row["members"], np.int32).tolist()))
                    ends = np.frombuffer(row["ends"], np.int32).tolist()
                    block.heaps = [entries[a:b] for a, b in zip([0, *ends], ends)]
                counts, sums, _ = block.advance(centroids, spent)
                entries = [e for heap in block.heaps for e in heap]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(at, 1), pa.array([row["vectors"]], pa.binary()), pa.array([block.owner.tobytes()], pa.binary()),
                     pa.array([np.array([e[0] for e in entries], np.float64).tobytes()], pa.binary()),
                     pa.array([np.array([e[1] for e in entries], np.int32).tobytes()], pa.binary()),
                     pa.array([np.cumsum([len(h) for h in block.heaps]).astype(np.int32).tobytes()], pa.binary()),
                     pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([sums.ravel().tolist()], pa.list_(pa.int64()))],
                    names=["ids", "vectors", "owner", "gaps", "members", "ends", "counts", "sums"],
                )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                vectors = np.frombuffer(batch.column("vectors")[at].as_py(), np.int32).reshape(-1, COMPONENTS).astype(np.int64)
                owner = np.frombuffer(batch.column("owner")[at].as_py(), np.int16)
                distance = ((vectors - centroids[owner]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(at, 1).flatten(), pa.array(owner.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
                )

    return run


def _changes(state: DataFrame, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums over all blocks; one row for each number, whatever the number of blocks."""
    both = state.select(F.posexplode(F.concat("counts", "sums")).alias("place", "change"))
    total = np.zeros(clusters * (1 + COMPONENTS), np.int64)
    for row in both.groupBy("place").agg(F.sum("change").alias("change")).collect():
        total[row.place] = row.change
    return total[:clusters], total[clusters:].reshape(clusters, COMPONENTS)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1") -> DataFrame:
    """Clusters of the rows of ``vectors`` (vec_id, embedding) that have ``COMPONENTS`` finite components.

    Returns vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256. Components count as floor(64 * x). The first
    centroids are the vectors with the least sha256 of ``<seed>:<vec_id>``; repeated ids are told apart by their components, a null id
    counts as empty text, and fewer vectors than clusters are all centroids. Ties go to the smaller number, clusters without
    vectors keep their centroid. Rows with another number of components, or with one that is null or not finite, are left
    out; an empty table gives no rows. A component beyond 2^18 raises, as distances would not fit. Other columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = kept.where((F.size("vector") == COMPONENTS) & ~odd)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(key, "vector").limit(clusters).collect()
    centroids = np.array([[math.floor(SCALE * x) for x in row.vector] for row in first], np.int64).reshape(-1, COMPONENTS)
    clusters = len(centroids)

    none = [F.lit(None).cast("binary").alias(c) for c in ("owner", "gaps", "members", "ends")]
    state = kept.mapInArrow(_blocks, f"ids array<{kind}>, vectors binary").select("ids", "vectors", *none)
    spent, counts, sums = [0.0] * clusters, np.zeros(clusters, np.int64), np.zeros((clusters, COMPONENTS), np.int64)
    for turn in range(rounds + 1 if clusters else 0):
        state = materialise(state.mapInArrow(_advanced(centroids, spent), f"ids array<{kind}>, {_STATE}"), "clusters")
        if turn == rounds:
            break
        changes = _changes(state, clusters)
        counts, sums = counts + changes[0], sums + changes[1]
        moved = np.where(counts[:, None] > 0, sums // np.maximum(1, counts)[:, None], centroids)
        drift = [math.sqrt(int(x)) for x in ((moved - centroids) ** 2).sum(axis=1)]
        others = [max([d for j, d in enumerate(drift) if j != c], default=0.0) for c in range(clusters)]
        spent, centroids = [s + d + o for s, d, o in zip(spent, drift, others)], moved

    found = state.where(F.lit(clusters > 0)).select("ids", "vectors", "owner")
    found = found.mapInArrow(_assigned(centroids), f"vec_id {kind}, cluster int, distance long")
    if not clusters:
        blank = [F.lit(None).cast(t).alias(c) for c, t in (("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))]
        return found.select("*", *blank)
    found = materialise(found, "assigned")
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    named = [(i, inertia.get(i, 0), sum(inertia.values()), digests[i]) for i in range(clusters)]
    named = spark.createDataFrame(named, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), F.col("cluster") == F.col("number")).drop("number")
