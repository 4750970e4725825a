"""Near duplicates: minima of many universal hashes, banding, verification, connected components.

Texts with the same set of shingles form a class at once. Classes that agree in a band share a bucket.
Each member of a bucket is checked against the bucket's pivot, first by signature, then on the full sets;
the links found give components. Members of buckets that still hold several components meet in tiles of
bounded size, where all that lie in different components are compared, by signature and then on full sets,
and one link for each two components comes out: no connection is missed, and a group of copies is never
expanded into pairs.

With 28 bands of three minima a pair at the threshold shares no band with a chance of (1 - 0.75**3)**28, about
2 in 10 million; a signature of 84 minima falls short of ``ESTIMATE`` for one in a million such pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import LOWER, NON_SPACE, bounded_batches, lowered, mixed, row_of, slices, text_bytes, word_hashes
from prevascope.llm.components import roots
from prevascope.session import materialise

WORDS, PER_CENT = 5, 75
BANDS, BAND_ROWS = 28, 3
ESTIMATE = 0.52
#: Members of a bucket in a block; two blocks meet in a tile.
BLOCK = 1024

_random = np.random.default_rng(19970611)
_odd = lambda n: _random.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
_PLACE = _odd(WORDS + 1)
_A, _B = _odd(BANDS * BAND_ROWS), _odd(BANDS * BAND_ROWS)
_ONE, _TWO = _odd(1)[0], _odd(1)[0]


def shingle_sets(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, end to end, and where each text's begin."""
    hashes, places = word_hashes(lowered(raw), starts, NON_SPACE)
    first = np.searchsorted(places, starts)  # first word of each text
    n = len(hashes)
    whole = np.zeros(max(0, n - WORDS + 1), np.uint64)
    for t in range(WORDS):
        whole += hashes[t : t + len(whole)] * _PLACE[t]
    whole = mixed(whole)
    sets = []
    for low, high in zip(first[:-1], first[1:]):
        count = high - low
        if count >= WORDS:
            sets.append(np.unique(whole[low : high - WORDS + 1]))
        elif count:
            sized = np.append(hashes[low:high], np.uint64(count)) * np.append(_PLACE[:count], _PLACE[WORDS])
            sets.append(mixed(sized.sum(keepdims=True)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of minima for each set that is not empty; zeros for empty ones."""
    sizes = np.diff(starts)
    out = np.zeros((len(sizes), len(_A)), np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        heads = starts[full]
        for j, (a, b) in enumerate(zip(_A, _B)):
            out[full, j] = (np.minimum.reduceat(values * a + b, heads) >> np.uint64(32)).astype(np.uint32)
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            values, starts = shingle_sets(*text_bytes(part.column("text")))
            sizes = np.diff(starts)
            prints = []
            for key in (_ONE, _TWO):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(values ^ key))])
                prints.append((sums[starts[1:]] - sums[starts[:-1]]).view(np.int64))
            minima = signatures(values, starts)
            raw = pa.array([row.tobytes() for row in minima], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(sizes), *map(pa.array, prints), raw],
                names=["doc_id", "text_key", "n_shingles", "fp1", "fp2", "minima"],
            )


def shingles(text: str | None) -> set:
    """The set of shingles itself."""
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[t:] for t in range(WORDS))))


def alike(left: set, right: set) -> bool:
    both = len(left & right)
    return 100 * both >= PER_CENT * (len(left) + len(right) - both)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in enough minima."""
    for batch in batches:
        if batch.num_rows:
            left, right = (np.frombuffer(text_bytes(batch.column(c))[0].tobytes(), np.uint32).reshape(batch.num_rows, -1) for c in ("left", "right"))
            near = (left == right).mean(axis=1) >= ESTIMATE
            yield batch.select(["a", "b"]).filter(pa.array(near))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are alike."""
    held, known = None, set()
    for batch in batches:
        near = []
        for b, left, right in zip(batch.column("b").to_pylist(), batch.column("left"), batch.column("right")):
            if b != held:
                held, known = b, shingles(right.as_py())
            near.append(alike(shingles(left.as_py()), known))
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


class _Corpus:
    """Classes of a document table, their signatures and, once asked for, the texts of some."""

    def __init__(self, docs: DataFrame):
        bounded_batches(docs.sparkSession)
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        self.docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        sketched = self.docs.mapInArrow(
            _sketched, f"doc_id {kind}, text_key long, n_shingles long, fp1 long, fp2 long, minima binary"
        )
        self.rows = materialise(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
        self.set = ["n_shingles", "fp1", "fp2"]
        classes = self.rows.where("n_shingles > 0").groupBy(*self.set).agg(F.min("row").alias("node"), F.min("doc_id").alias("low"))
        self.classes = materialise(classes, "classes")
        found = self.rows.select("row", "doc_id", "text_key", "n_shingles", "minima").join(
            self.classes.select(F.col("node").alias("row")), "row", "left_semi"
        )
        self.nodes = materialise(found.withColumnRenamed("row", "node"), "nodes")

    def bands(self) -> DataFrame:
        width = BAND_ROWS * 4
        pieces = [F.xxhash64(F.lit(b), F.substring("minima", b * width + 1, width)) for b in range(BANDS)]
        return self.nodes.select("node", F.explode(F.array(*pieces)).alias("key"))

    def texts(self, needed: DataFrame) -> DataFrame:
        """(node, text) of the nodes asked for."""
        place = self.nodes.select("node", "doc_id", "text_key").join(needed, "node", "left_semi")
        same = self.docs["doc_id"].eqNullSafe(place["doc_id"]) & (self.docs["text_key"] == place["text_key"])
        return materialise(self.docs.join(place, same).select("node", "text").dropDuplicates(["node"]), "texts")

    def confirmed(self, pairs: DataFrame, by_signature: bool = True) -> DataFrame:
        """The pairs (a, b) of nodes that are linked, by signature first unless that is done already."""
        near = pairs
        if by_signature:
            for side, name in (("a", "left"), ("b", "right")):
                pairs = pairs.join(self.nodes.select(F.col("node").alias(side), F.col("minima").alias(name)), side)
            near = materialise(pairs.select("a", "b", "left", "right").mapInArrow(_estimated, "a long, b long"), "near")
        texts = self.texts(near.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        full = near.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
        full = full.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        return materialise(full.select("a", "b", "left", "right").mapInArrow(_confirmed, "a long, b long"), "links")


def _open_rows(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(key, node, root) of the buckets whose members are in different components."""
    placed = shared.join(found, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = materialise(placed, "placed")
    open_keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return materialise(placed.join(materialise(open_keys.select("key"), "open"), "key", "left_semi"), "open-rows")


def _pivot_pairs(shared: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, its least node."""
    pivots = materialise(shared.groupBy("key").agg(F.min("node").alias("b")), "pivots")
    return shared.join(pivots, "key").where("node != b").select(F.col("node").alias("a"), "b").distinct()


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows (key, node, root, ...) dealt to the tiles of their bucket, each of two blocks of about ``BLOCK`` members.

    A row of block i goes to the tiles {i, j} of all j, so that every pair of members meets in one task, tasks
    stay small however large the bucket is, and pairs are never rows.
    """
    sizes = materialise(rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "sizes")
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _each_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one tile at a time, from batches sorted by tile."""
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = part if rest is None else pa.concat_tables([rest, part])
        if not part.num_rows:
            continue
        names = [part.column(c).to_numpy() for c in ("key", "i", "j")]
        new = np.zeros(part.num_rows, bool)
        for c in names:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(new)])
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield part.slice(low, high - low)
        rest = part.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _sides(tile: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks of a tile; the same ones twice for a block with itself."""
    own, i, j = (tile.column(c).to_numpy() for c in ("own", "i", "j"))
    return np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])


def _active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) of members whose signature comes near that of one in another component."""
    for tile in _each_tile(batches):
        roots_, nodes = tile.column("root").to_numpy(), tile.column("node").to_numpy()
        minima = np.frombuffer(b"".join(tile.column("minima").to_pylist()), np.uint32).reshape(len(nodes), -1)
        left, right = _sides(tile)
        near = np.zeros(len(nodes), bool)
        for row in left:
            others = right[roots_[right] != roots_[row]]
            hit = others[(minima[others] == minima[row]).mean(axis=1) >= ESTIMATE]
            near[hit] = True
            near[row] |= len(hit) > 0
        if near.any():
            yield pa.RecordBatch.from_arrays([pa.array(tile.column("key").to_numpy()[near]), pa.array(nodes[near])], names=["key", "node"])


def common_counts(values: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of two groups of rows, a slice of the vocabulary at a time."""
    sizes = np.array([len(v) for v in values])
    rows = np.repeat(np.arange(len(values)), sizes)
    _, ids, uses = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = uses[ids] > 1
    rows, ids = rows[shared], np.unique(ids[shared], return_inverse=True)[1]
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for base in range(0, int(ids[-1]) + 1 if len(ids) else 0, 2048):
        low, high = np.searchsorted(ids, [base, base + 2048])
        grid = np.zeros((len(values), 2048), np.float32)
        grid[rows[low:high], ids[low:high] - base] = 1
        out += grid[left] @ grid[right].T
    return out


def _linking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A link (a, b) for each two components of a tile that have one, from the full sets."""
    for tile in _each_tile(batches):
        roots_, nodes = tile.column("root").to_numpy(), tile.column("node").to_numpy()
        values = [np.frombuffer(v, np.uint64) for v in tile.column("shingles").to_pylist()]
        left, right = _sides(tile)
        both = common_counts(values, left, right)
        sizes = np.array([len(v) for v in values], np.float32)
        union = sizes[left][:, None] + sizes[right][None, :] - both
        x, y = np.nonzero((100 * both >= PER_CENT * union) & (roots_[left][:, None] != roots_[right][None, :]))
        x, y = left[x], right[y]
        _, one = np.unique(np.stack([np.minimum(roots_[x], roots_[y]), np.maximum(roots_[x], roots_[y])]), axis=1, return_index=True)
        x, y = nodes[x[one]], nodes[y[one]]
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])


def _set_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            values, starts = shingle_sets(*text_bytes(part.column("text")))
            sets = [values[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])


def _crossing_links(corpus: _Corpus, rows: DataFrame) -> DataFrame:
    """Confirmed links between components in open buckets, at least one for each two components that have any."""
    signed = rows.join(corpus.nodes.select("node", "minima"), "node")
    active = _tiles(signed).mapInArrow(_active, "key long, node long").distinct()
    active = materialise(rows.join(materialise(active, "active"), ["key", "node"]), "active-rows")
    sets = corpus.texts(active.select("node").distinct()).mapInArrow(_set_bytes, "node long, shingles binary")
    found = _tiles(active.join(materialise(sets, "sets"), "node")).mapInArrow(_linking, "a long, b long")
    return corpus.confirmed(materialise(found.distinct(), "crossing"), by_signature=False)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The component of every row of ``docs`` (doc_id, text) under links of 75 % common shingles or more.

    Returns doc_id, n_shingles, component_id (smallest doc_id of the component; null ids count only if all are
    null), kept (doc_id is component_id), text_key. Words are lower-cased runs without white space; a text of fewer than
    five words has one shingle, one without words (or null) none and no links. Repeated rows share their
    component, and rows that repeat the smallest doc_id are all kept. An empty table gives no rows.
    """
    corpus = _Corpus(docs.select("doc_id", "text"))
    bands = corpus.bands()
    shared_keys = materialise(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "buckets")
    shared = materialise(bands.join(shared_keys, "key", "left_semi").select("key", "node"), "shared")
    links = corpus.confirmed(materialise(_pivot_pairs(shared), "pairs"))
    found = materialise(roots(links), "roots")
    more = _crossing_links(corpus, _open_rows(shared, found))
    if not more.isEmpty():  # components that these links join become one
        for side in ("a", "b"):
            more = more.join(found.withColumnsRenamed({"node": side, "root": f"root_{side}"}), side, "left")
        more = more.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        outer = materialise(roots(more), "outer-roots").withColumnsRenamed({"node": "inner", "root": "outer"})
        whole = found.unionByName(outer.select(F.col("inner").alias("node"), F.col("inner").alias("root"))).distinct()
        whole = whole.join(outer, F.col("root") == F.col("inner"), "left")
        found = materialise(whole.groupBy("node").agg(F.min(F.coalesce("outer", "root")).alias("root")), "roots")

    by_class = corpus.classes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = materialise(by_class.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = materialise(by_class.join(lowest, "root").select(*corpus.set, "component_id"), "named")
    rows = corpus.rows.select("doc_id", "text_key", *corpus.set).join(named, corpus.set, "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), "text_key")
