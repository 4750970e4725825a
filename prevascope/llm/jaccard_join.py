"""Joining documents by the Jaccard similarity of their word n-grams, through parity sketches.

A sketch has a bit for each of many slots: the parity of the shingles hashed to it. Two sketches differ in at most as many bits as the
sets differ in shingles, and sets of a and b shingles that are linked differ in at most D = (a + b) / 19 (at 90 %). Sizes are cut into
bands such that linked sets lie in the same or in adjacent ones; every set has a sketch for its own band and one for the
next, so that any two such sets share a layout. A layout has D + 1 segments for the largest D of its band: by the pigeonhole principle
linked sets agree in one of them, and its number and bits are the key under which they meet. Bands of small D, whose
segments hold few shingles in all, combine the segments of two independent sketches, as linked sets agree in a pair of these.
Past the keys a sketch is folded: slots are joined by the parity of both, which keeps the bound at a quarter of the bits.

Texts with the same set form a class at once, and only sets of at least ten shingles can differ and be linked. The members of a bucket are
checked against its least one, by folded sketch and then on the full sets; the links give components. Buckets that hold several components are
dealt to tiles of two blocks, where members of different components are compared, and one link for each two components
comes out: no pairs within a group are ever rows, and no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import LOWER, NON_SPACE, bounded_batches, lowered, mixed, slices, text_bytes, word_hashes
from prevascope.llm.components import roots
from prevascope.session import materialise

WORDS, PER_CENT = 3, 90
#: Up to this D the segments of two sketches are combined.
COMBINED = 3
#: Shingles of a block of a bucket's members, each member counted as ``LEAST`` at least.
BLOCK_SHINGLES, LEAST = 1 << 22, 256
#: Bits of the table that thins out documents before texts move, for each text asked for and in all.
MARKS_EACH, MARKS = 64, 1 << 26
#: No document has more shingles.
MOST_SHINGLES = 1 << 40

_random = np.random.default_rng(20110829)
_odd = lambda n: _random.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
_PLACE, _SEED = _odd(WORDS + 1), _odd(4)
_HALF, _LAYOUT_BITS = np.uint64(32), np.uint64(9)
#: The bits of a bitmap of Spark.
_BITMAP_BITS = 15


def _band_starts() -> np.ndarray:
    """Least size of each band; linked sets lie in the same or in adjacent bands."""
    starts = [1]
    while starts[-1] < MOST_SHINGLES:
        starts.append(100 * starts[-1] // PER_CENT + 1)
    return np.array(starts, np.int64)


BANDS = _band_starts()


def most_different(a, b):
    """The most shingles in which linked sets of ``a`` and ``b`` shingles can differ."""
    return (a + b) * (100 - PER_CENT) // (100 + PER_CENT)


def segments(layout: int) -> int:
    """Segments of a layout, one more than linked sets of its largest size differ in."""
    largest = int(BANDS[layout + 1]) - 1
    return int(most_different(largest, largest)) + 1


def band_of(size: int) -> int:
    return int(np.searchsorted(BANDS, size, "right")) - 1


def shingle_sets(raw: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    hashes, places = word_hashes(lowered(raw), starts, NON_SPACE)
    first = np.searchsorted(places, starts)
    whole = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
    for t in range(WORDS):
        whole += hashes[t : t + len(whole)] * _PLACE[t]
    whole = mixed(whole)
    for low, high in zip(first[:-1], first[1:]):
        if high - low >= WORDS:
            yield np.unique(whole[low : high - WORDS + 1])
        else:  # the whole sequence, told apart by its length
            few = hashes[low:high] * _PLACE[: high - low]
            yield mixed(few.sum(keepdims=True) + _PLACE[WORDS] * np.uint64(high - low)) if high > low else few


def sketch(values: np.ndarray, layout: int) -> np.ndarray:
    """Words of the parity sketch of a set: a word for each segment, of two sketches one after the other if D is small."""
    n = segments(layout)
    slots, words = np.uint64(64 * n), []
    for half in (values >> _HALF, values & np.uint64(0xFFFFFFFF))[: 2 if n - 1 <= COMBINED else 1]:
        bits = np.bincount(((half * slots) >> _HALF).astype(np.int64), minlength=64 * n) & 1
        words.append(np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64))
    return np.concatenate(words)


def keys(words: np.ndarray, layout: int) -> np.ndarray:
    """The keys of a sketch: for each segment, or each two segments of two sketches."""
    n = segments(layout)
    hashed = mixed(mixed(words + _SEED[2]) + np.arange(len(words), dtype=np.uint64) * _SEED[0])
    if len(words) > n:
        hashed = mixed((hashed[:n, None] * _SEED[3] + hashed[None, n:]).ravel())
    # the layout is part of a key, so that buckets of different layouts never meet
    return hashed >> _LAYOUT_BITS << _LAYOUT_BITS | np.uint64(layout)


def fold(words: np.ndarray) -> np.ndarray:
    """The sketch with 16 bits for each word: what linked sets differ in at most still bounds the bits that differ."""
    return np.bitwise_xor.reduce(words.view(np.uint16).reshape(-1, 4), axis=1)


def layout_of(key: str = "key") -> Column:
    """The layout that is part of a key."""
    return F.col(key).bitwiseAND(F.lit((1 << int(_LAYOUT_BITS)) - 1)).cast("int")


def _layouts(size: int) -> list[int]:
    """The two layouts of a set of this size; none where linked sets must be equal."""
    return [x for x in (band_of(size), band_of(size) + 1) if size and segments(x) > 1]


def _prints(values: np.ndarray) -> list[int]:
    return [int(np.sum(mixed(values ^ seed), dtype=np.uint64).view(np.int64)) for seed in _SEED[:2]]


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, two fingerprints, folded sketches and keys of the set of each text."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            sizes, prints, first, folds, found, ends = [], [], [], [], [np.zeros(0, np.uint64)], [0]
            for values in shingle_sets(*text_bytes(part.column("text"))):
                sizes.append(len(values))
                prints.append(_prints(values))
                layouts = _layouts(len(values))
                first.append(layouts[0] if layouts else None)
                sketches = [sketch(values, x) for x in layouts]
                folds.append([fold(words).tobytes() for words in sketches])
                own = [np.unique(keys(words, x)) for words, x in zip(sketches, layouts)]
                found += own
                ends.append(ends[-1] + sum(map(len, own)))
            one, two = np.array(prints, np.int64).reshape(-1, 2).T
            keyed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(one), pa.array(two),
                 pa.array(first, pa.int32()), pa.array(folds, pa.list_(pa.binary())), keyed],
                names=["doc_id", "text_key", "n_shingles", "fp1", "fp2", "first", "folds", "keys"],
            )


def shingles(text: str | None) -> set:
    """The set of shingles itself."""
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[t:] for t in range(WORDS))))


def linked(left: set, right: set) -> bool:
    both = len(left & right)
    return bool(both) and 100 * both >= PER_CENT * (len(left) + len(right) - both)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose folded sketches of one layout allow for a link."""
    for batch in batches:
        near = []
        columns = [batch.column(c).to_pylist() for c in ("left", "right", "n_left", "n_right", "layout")]
        for left, right, a, b, layout in zip(*columns):
            left, right = np.frombuffer(left, np.uint16), np.frombuffer(right, np.uint16)
            apart = int(np.bitwise_count(left ^ right).sum())
            near.append(100 * min(a, b) >= PER_CENT * max(a, b) and apart <= most_different(a, b) * (len(left) // segments(layout)))
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are linked."""
    held, known = None, set()
    for batch in batches:
        near = []
        for b, left, right in zip(batch.column("b").to_pylist(), batch.column("left"), batch.column("right")):
            if b != held:
                held, known = b, shingles(right.as_py())
            near.append(linked(shingles(left.as_py()), known))
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def tiles(rows: DataFrame) -> DataFrame:
    """Rows (key, node, root, n_shingles, ...) of buckets dealt to tiles of two blocks.

    Members of a bucket's largest component never meet one another: each goes to the tiles of its block with those of the other
    members, which go to the tiles of their block with every block. Blocks are bounded in shingles, and there are as
    many copies of a row as blocks of those it meets.
    """
    weight = F.greatest(F.col("n_shingles"), F.lit(LEAST))
    shares = rows.groupBy("key", "root").agg(F.sum(weight).alias("weight"))
    sizes = shares.groupBy("key").agg(F.max(F.struct("weight", "root")).alias("major"), F.sum("weight").alias("weight"))
    blocks = lambda w: F.ceil(w / BLOCK_SHINGLES).cast("int")
    sizes = sizes.select("key", F.col("major.root").alias("most"), blocks(F.col("major.weight")).alias("n_major"), blocks(F.col("weight") - F.col("major.weight")).alias("n_minor"))
    dealt = rows.join(materialise(sizes, "tile-sizes"), "key")
    hashed, major = F.xxhash64("node", "key"), F.col("root") == F.col("most")
    own = F.when(major, F.col("n_minor") + F.pmod(hashed, F.col("n_major"))).otherwise(F.pmod(hashed, F.col("n_minor"))).cast("int")
    met = F.when(major, F.col("n_minor")).otherwise(F.col("n_minor") + F.col("n_major"))
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), met - 1)))
    return dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", "most", "n_major", "n_minor")


def _each_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Columns of one tile at a time, from batches sorted by tile, and the rows of its two blocks."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        place = np.stack([rest.column(c).to_numpy() for c in ("key", "i", "j")])
        cuts = np.concatenate([[0], np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1]) if rest.num_rows else []
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield _tile(rest.slice(low, high - low))
        rest = rest.slice(cuts[-1]) if rest.num_rows else None
    if rest is not None:
        yield _tile(rest)


def _tile(table: pa.Table) -> dict:
    tile = {c: table.column(c).to_numpy() for c in ("key", "node", "root", "n_shingles", "own", "i", "j", "layout")}
    words = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16)
    tile["sketch"] = words.reshape(table.num_rows, -1)
    tile["left"], tile["right"] = np.flatnonzero(tile["own"] == tile["i"][0]), np.flatnonzero(tile["own"] == tile["j"][0])
    if "shingles" in table.column_names:
        tile["shingles"] = table.column("shingles")
    return tile


def _near_rows(tile: dict) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of the left block with the rows of the right one in other components that may be linked to it."""
    words, sizes, root = tile["sketch"], tile["n_shingles"], tile["root"]
    sketches = words.shape[1] // segments(int(tile["layout"][0]))
    for row in tile["left"]:
        others = tile["right"][root[tile["right"]] != root[row]]
        low, high = np.minimum(sizes[others], sizes[row]), np.maximum(sizes[others], sizes[row])
        others = others[100 * low >= PER_CENT * high]
        apart = np.bitwise_count(words[others] ^ words[row]).sum(axis=1, dtype=np.int64)
        others = others[apart <= sketches * most_different(sizes[others], sizes[row])]
        if len(others):
            yield row, others


def _active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) of members that may be linked to one in another component."""
    for tile in _each_tile(batches):
        near = np.zeros(len(tile["node"]), bool)
        for row, others in _near_rows(tile):
            near[row] = True
            near[others] = True
        if near.any():
            yield pa.RecordBatch.from_arrays([pa.array(tile["key"][near]), pa.array(tile["node"][near])], names=["key", "node"])


def _linking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A link (a, b) for each two components of a tile that have one, from the full sets."""
    for tile in _each_tile(batches):
        sets: dict[int, np.ndarray] = {}
        joined, found = set(), []
        for row, others in _near_rows(tile):
            for other in others:
                pair = tuple(sorted((tile["root"][row], tile["root"][other])))
                if pair in joined:
                    continue
                for x in (row, other):
                    if x not in sets:
                        sets[x] = np.frombuffer(tile["shingles"][int(x)].as_py(), np.uint64)
                both = len(np.intersect1d(sets[row], sets[other], assume_unique=True))
                if 100 * both >= PER_CENT * (len(sets[row]) + len(sets[other]) - both):
                    joined.add(pair)
                    found.append(sorted((int(tile["node"][row]), int(tile["node"][other])), reverse=True))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])


def _set_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            sets = [values.tobytes() for values in shingle_sets(*text_bytes(part.column("text")))]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])


def marked(docs: DataFrame, place: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text key is in ``place``, and a few others.

    Text keys are marked in a broadcast table of bits, so that other texts do not move. It has a bounded size: where very
    many are marked it lets more pass, never fewer.
    """
    n = min(MARKS, 1 << max(_BITMAP_BITS, (MARKS_EACH * place.count()).bit_length()))
    slot = F.pmod("text_key", F.lit(n))
    part, at = F.shiftright(slot, _BITMAP_BITS).alias("part"), F.pmod(slot, F.lit(1 << _BITMAP_BITS))
    bits = place.groupBy(part).agg(F.bitmap_construct_agg(at).alias("bits"))
    byte = F.hex(F.substring("bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1)))
    told = docs.withColumn("part", part).join(F.broadcast(bits), "part")
    return told.where(F.getbit(F.conv(byte, 16, 10).cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1).select(*docs.columns)


class _Corpus:
    """Classes of a document table, their sketches and, once asked for, the texts of some."""

    def __init__(self, docs: DataFrame):
        bounded_batches(docs.sparkSession)
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        self.docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        sized = self.docs.mapInArrow(
            _sized, f"doc_id {kind}, text_key long, n_shingles long, fp1 long, fp2 long, first int, folds array<binary>, keys array<long>"
        )
        self.rows = materialise(sized.withColumn("row", F.monotonically_increasing_id()), "sketches")
        self.set = ["n_shingles", "fp1", "fp2"]
        groups = self.rows.where("n_shingles > 0").groupBy(*self.set).agg(F.min("row").alias("node"), F.min("doc_id").alias("low"))
        self.classes = materialise(groups, "classes")

    def shared(self) -> DataFrame:
        """(key, node, b) for every key of several classes, b the least node of them.

        Keys are dealt out once, for both the buckets and their members.
        """
        keyed = self.rows.where(F.size("keys") > 0).select(F.col("row").alias("node"), "keys")
        keyed = keyed.join(self.classes.select("node"), "node", "left_semi").select(F.explode("keys").alias("key"), "node").repartition("key")
        buckets = keyed.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("high")).where("b != high")
        return materialise(keyed.join(buckets.select("key", "b"), "key"), "shared")

    def sketch(self, rows: DataFrame, node: str = "node") -> DataFrame:
        """``rows`` (layout, node, ...) with n_shingles and the folded sketch of the layout."""
        sized = self.rows.where("first IS NOT NULL").select(F.col("row").alias(node), "n_shingles", "first", "folds")
        own = F.element_at("folds", F.col("layout") - F.col("first") + 1)
        return rows.join(sized, node).withColumn("sketch", own).drop("first", "folds")

    def texts(self, needed: DataFrame) -> DataFrame:
        """(node, text) of the nodes asked for."""
        place = self.rows.select(F.col("row").alias("node"), "doc_id", "text_key").join(needed, "node", "left_semi")
        place = materialise(place, "places")
        docs = marked(self.docs, place)
        same = docs["doc_id"].eqNullSafe(place["doc_id"]) & (docs["text_key"] == place["text_key"])
        return materialise(docs.join(place, same).select("node", "text").dropDuplicates(["node"]), "texts")

    def confirmed(self, pairs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
        """The pairs (a, b) of nodes that are linked by their full sets; ``texts`` has those of the nodes, if at hand."""
        if texts is None:
            texts = self.texts(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        full = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
        full = full.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        return materialise(full.select("a", "b", "left", "right").mapInArrow(_confirmed, "a long, b long"), "links")


def _open_rows(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(key, layout, node, root) of the buckets whose members are in different components, one for each set of members.

    Documents that differ little share many buckets, often with the same others, and comparing them once is enough.
    """
    placed = shared.join(found, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = materialise(placed, "placed")
    open_keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    rows = materialise(placed.join(materialise(open_keys.select("key"), "open"), "key", "left_semi"), "open-rows")
    prints = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"print{seed}") for seed in (1, 2)]
    members = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *prints)
    first = members.groupBy("size", "print1", "print2").agg(F.min("key").alias("key")).select("key")
    return materialise(rows.join(materialise(first, "open-sets"), "key", "left_semi").withColumn("layout", layout_of()), "open-rows")


def _first_links(corpus: _Corpus, shared: DataFrame) -> DataFrame:
    """Confirmed links of members of buckets with the least node of theirs."""
    pairs = shared.where("node != b").groupBy(F.col("node").alias("a"), "b").agg(F.min(layout_of()).alias("layout"))
    pairs = materialise(pairs, "pairs")
    for side, name in (("a", "left"), ("b", "right")):
        pairs = corpus.sketch(pairs, side).withColumnsRenamed({"sketch": name, "n_shingles": f"n_{name}"})
    near = pairs.select("a", "b", "left", "right", "n_left", "n_right", "layout").mapInArrow(_estimated, "a long, b long")
    return corpus.confirmed(materialise(near, "near"))


def _in_tiles(rows: DataFrame) -> DataFrame:
    return tiles(rows).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _crossing_links(corpus: _Corpus, rows: DataFrame) -> DataFrame:
    """Confirmed links between components in open buckets, at least one for each two components that have any."""
    active = _in_tiles(corpus.sketch(rows)).mapInArrow(_active, "key long, node long").distinct()
    active = materialise(rows.join(materialise(active, "active"), ["key", "node"]), "active-rows")
    texts = corpus.texts(active.select("node").distinct())
    sets = texts.mapInArrow(_set_bytes, "node long, shingles binary")
    full = corpus.sketch(active).join(materialise(sets, "sets"), "node")
    return corpus.confirmed(materialise(_in_tiles(full).mapInArrow(_linking, "a long, b long").distinct(), "crossing"), texts)


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after ``links`` between components of ``found`` (node, root)."""
    for side in ("a", "b"):
        links = links.join(found.withColumnsRenamed({"node": side, "root": f"root_{side}"}), side, "left")
    outer = materialise(roots(links.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))), "outer")
    outer = outer.withColumnsRenamed({"node": "inner", "root": "outer"})
    whole = found.unionByName(outer.select(F.col("inner").alias("node"), F.col("inner").alias("root"))).distinct()
    whole = whole.join(outer, F.col("root") == F.col("inner"), "left")
    return materialise(whole.groupBy("node").agg(F.min(F.coalesce("outer", "root")).alias("root")), "roots")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """The component of every row of ``docs`` (doc_id, text) under links of 90 % common three-word shingles or more.

    Returns doc_id, n_shingles, component_id (smallest doc_id of the component; null ids count only if all are null). Words are
    lower-cased runs without white space; a text of fewer than three words has one shingle, one without words (or null) none
    and no links, its component is its own id. Repeated rows share their component; an empty table gives no rows. Other
    columns are not read.
    """
    corpus = _Corpus(docs.select("doc_id", "text"))
    shared = corpus.shared()
    found = materialise(roots(_first_links(corpus, shared)), "roots")
    more = _crossing_links(corpus, _open_rows(shared, found))
    if not more.isEmpty():
        found = _joined(found, more)

    by_class = corpus.classes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = materialise(by_class.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = materialise(by_class.join(lowest, "root").select(*corpus.set, "component_id"), "named")
    rows = corpus.rows.select("doc_id", *corpus.set).join(named, corpus.set, "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"))
