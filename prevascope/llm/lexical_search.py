"""Ranked lexical search over bags of words that occur in the items.

Every document is restricted to the vocabulary of the items. Documents with the same term frequencies and the same
length measure score alike for every item, so they form a class: found by a hash of the two, verified against the
class's head, and hashed anew with another seed where they differ from it. A class is scored once against all
items, and only the classes that win a place are expanded into their members by ascending doc_id.

Items are taken in blocks whose vocabulary is bounded, so what tasks hold of them is, too. A task keeps the best classes
of each item it has seen. A class outside an item's ``most`` best by score and least doc_id cannot place a
member: as many classes each have a member before its best one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prevascope.llm.common import ALNUM, Lookup, bounded_batches, lowered, row_of, slices, text_bytes, text_or_empty, word_hashes
from prevascope.session import materialise

MOST = 20
#: Distinct (item, term) rows of a block of items; an item with more is a block of its own.
BLOCK_TERMS = 1_000_000
#: Products of a class's terms with items that a task expands at once.
EXPANDED = 1 << 21
STEP = 1_000_000_000


class Vocabulary:
    """Terms by number, found in texts by hash and confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.data = np.frombuffer(b" ".join(terms), np.uint8)
        self.length = np.array([len(t) for t in terms], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.length + 1)])[: len(terms)]
        hashes, _ = word_hashes(self.data, np.array([0, len(self.data)]), ALNUM)
        self.numbers = Lookup(hashes)

    def bags(self, raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; and row, term and frequency of the terms found, by row and term."""
        hashes, places = word_hashes(raw, starts, ALNUM)
        rows = row_of(places, starts)
        words = np.bincount(rows, minlength=len(starts) - 1)
        term = self.numbers.find(hashes).astype(np.int64)
        hit = np.flatnonzero(term >= 0)
        hit = hit[self._confirmed(raw, places[hit], starts[rows[hit] + 1], term[hit])]
        pairs, counts = np.unique(rows[hit] * max(1, len(self.length)) + term[hit], return_counts=True)
        row, term = np.divmod(pairs, max(1, len(self.length)))
        return words, row, term, counts

    def _confirmed(self, raw: np.ndarray, places: np.ndarray, row_ends: np.ndarray, term: np.ndarray) -> np.ndarray:
        length = self.length[term]
        ends = places + length
        good = ends <= row_ends
        inner = good & (ends < row_ends)
        good[inner] &= ~ALNUM[raw[ends[inner]]]
        some = np.flatnonzero(good)
        if len(some):
            length = length[some]
            first = np.cumsum(length) - length
            step = np.arange(length.sum()) - np.repeat(first, length)
            same = raw[np.repeat(places[some], length) + step] == self.data[np.repeat(self.at[term[some]], length) + step]
            good[some] = np.logical_and.reduceat(same, first)
        return good


def _restricted(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms.value)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                raw, starts = text_bytes(part.column("text"))
                words, row, term, counts = vocabulary.bags(lowered(raw), starts)
                offsets = pa.array(np.searchsorted(row, np.arange(len(words) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64)))],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, term, uses) of every item."""
    for batch in batches:
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            raw = lowered(np.frombuffer((text or "").encode(), np.uint8))
            words = np.where(ALNUM[raw], raw, 0x20).astype(np.uint8).tobytes().split()
            terms, uses = np.unique(np.array(words, object), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(terms), pa.int64()), pa.array([t.decode() for t in terms], pa.string()), pa.array(uses.astype(np.int64))],
                names=["item", "term", "uses"],
            )


class Postings:
    """For each term the items that use it and what an occurrence gains there."""

    def __init__(self, n_terms: int, term: np.ndarray, item: np.ndarray, gain: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.item, self.gain = item[order], gain[order]
        self.ends = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.items = int(item.max()) + 1 if len(item) else 0

    def scores(self, m: np.ndarray, starts: np.ndarray, term: np.ndarray, tf: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Scores of bags by item, some bags at a time with the number of the first."""
        uses = self.ends[term + 1] - self.ends[term]
        impact = (STEP * tf) // (1000 * tf + 12 * np.repeat(m, np.diff(starts)))
        before = np.concatenate([[0], np.cumsum(uses)])
        rows, at = len(m), 0
        while at < rows:
            fit = int(np.searchsorted(before[starts], before[starts[at]] + EXPANDED, "right")) - 1
            end = min(rows, max(at + 1, min(fit, at + max(1, 2 * EXPANDED // max(1, self.items)))))
            low, high = starts[at], starts[end]
            many = uses[low:high]
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            place = np.repeat(self.ends[term[low:high]], many) + step
            row = np.repeat(np.repeat(np.arange(end - at), np.diff(starts[at : end + 1])), many)
            out = np.zeros((end - at) * self.items, np.int64)
            np.add.at(out, row * self.items + self.item[place], np.repeat(impact[low:high], many) * self.gain[place])
            yield at, out.reshape(end - at, self.items)
            at = end


def _first_of_each(table: pa.Table, most: int) -> pa.Table:
    """The ``most`` best rows of each item, by score and then least doc_id."""
    table = table.take(pc.sort_indices(table, [("item", "ascending"), ("score", "descending"), ("low", "ascending"), ("node", "ascending")]))
    item = table.column("item").to_numpy()
    return table.filter(pa.array(np.arange(len(item)) - np.searchsorted(item, item) < most))


def _best(postings, most: int):
    """The best classes (node) of each item among those of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, floor = postings.value, None, None
        for batch in batches:
            if not batch.num_rows or not known.items:
                continue
            floor = np.zeros(known.items, np.int64) if floor is None else floor
            terms, tfs = batch.column("terms"), batch.column("tfs")
            starts = terms.offsets.to_numpy().astype(np.int64)
            starts, term = starts - starts[0], terms.flatten().to_numpy().astype(np.int64)
            for at, scores in known.scores(batch.column("m").to_numpy(), starts, term, tfs.flatten().to_numpy()):
                if len(scores) > most:
                    near = np.maximum(floor, np.partition(scores, len(scores) - most, axis=0)[len(scores) - most])
                else:
                    near = floor
                row, item = np.nonzero((scores >= near) & (scores > 0))
                rows = pa.array(at + row)
                found = pa.table(
                    {"item": pa.array(item), "score": pa.array(scores[row, item]), "node": batch.column("node").take(rows), "low": batch.column("low").take(rows)}
                )
                held = _first_of_each(found if held is None else pa.concat_tables([held, found]), most)
                full = held.column("item").to_numpy()
                last = np.arange(len(full)) - np.searchsorted(full, full) == most - 1
                floor[full[last]] = held.column("score").to_numpy()[last]
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return run


def _bag_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "m", "terms", "tfs")


def classes(bags: DataFrame, key=_bag_key) -> tuple[DataFrame, DataFrame]:
    """Classes (node, m, terms, tfs, low) of ``bags`` (row, doc_id, m, terms, tfs), and (node, doc_id) of classes of several.

    ``low`` is the least doc_id of a class. Members are compared with their class's head; those that differ share its hash alone
    and are hashed once more with the next seed, until none are left.
    """
    heads_of_all, members_of_all, seed, rest = [], [], 0, bags
    while True:
        keyed = rest.withColumn("bag", key(seed))
        groups = materialise(keyed.groupBy("bag").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("size")), "bag-groups")
        shared = groups.where("size > 1")
        first = keyed.join(shared.select(F.col("node").alias("row")), "row", "left_semi")
        first = first.select("bag", F.col("row").alias("node"), *[F.col(c).alias(f"head_{c}") for c in ("m", "terms", "tfs")])
        first = materialise(first, "bag-heads")
        same = F.expr("m = head_m and terms = head_terms and tfs = head_tfs")
        checked = materialise(keyed.join(first, "bag").select("row", "doc_id", "node", same.alias("same")), "bag-members")
        members = checked.where("same").select("node", "doc_id")
        lows = materialise(members.groupBy("node").agg(F.min("doc_id").alias("low")), "bag-lows")
        alone = keyed.join(shared.select("bag"), "bag", "left_anti").select(F.col("row").alias("node"), "m", "terms", "tfs", F.col("doc_id").alias("low"))
        several = first.join(lows, "node").select("node", *[F.col(f"head_{c}").alias(c) for c in ("m", "terms", "tfs")], "low")
        heads_of_all.append(alone.unionByName(several))
        members_of_all.append(members)
        odd = checked.where("not same").select("row")
        if odd.isEmpty():
            break
        rest, seed = materialise(rest.join(odd, "row", "left_semi"), "bag-rest"), seed + 1
    union = lambda parts: parts[0] if len(parts) == 1 else union([parts[0].unionByName(parts[1]), *parts[2:]])
    return union(heads_of_all), union(members_of_all)


def _blocks(terms: DataFrame, most: int) -> tuple[Column, int]:
    """A block for each item such that a block has at most ``most`` of the rows, or one item."""
    n = 1 + terms.count() // most
    while True:
        block = F.pmod(F.xxhash64(F.lit(n), F.col("item")), F.lit(n)).cast("int")
        sizes = terms.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("rows"), F.min("item").alias("a"), F.max("item").alias("b"))
        if sizes.where((F.col("rows") > most) & (F.col("a") != F.col("b"))).isEmpty():
            return block, n
        n *= 2


def _ranked(docs: DataFrame, used: pa.Table, most: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items of one block, given by their terms."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    terms = pc.unique(used.column("term")).to_pylist()
    terms = sorted(t.encode() for t in terms)
    number = {t: i for i, t in enumerate(terms)}
    own, item = np.unique(used.column("item").to_numpy(), return_inverse=True)

    restricted = docs.select("doc_id", text_or_empty().cast("string").alias("text")).mapInArrow(
        _restricted(spark.sparkContext.broadcast(terms)), f"doc_id {kind}, n long, terms array<int>, tfs array<long>"
    )
    rows = materialise(restricted.withColumn("row", F.monotonically_increasing_id()), "restricted")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    found = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    frequency = np.zeros(len(terms), np.int64)
    frequency[found.column("term").to_numpy()] = found.column("df").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * total.documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)

    term = np.array([number[t.encode()] for t in used.column("term").to_pylist()], np.int64)
    postings = Postings(len(terms), term, item, weight[term] * used.column("uses").to_numpy() if len(term) else term)
    # as (25 * n * documents) div words, the documents of an empty corpus have no terms
    m = F.expr(f"75L + (25L * n * {total.documents}L) div {max(1, total.words)}L")
    bags = rows.where(F.size("terms") > 0).select("row", "doc_id", m.alias("m"), "terms", "tfs")
    heads, members = classes(bags)
    best = heads.mapInArrow(_best(spark.sparkContext.broadcast(postings), most), f"item long, score long, node long, low {kind}")

    by_score = [F.desc("score"), F.asc_nulls_last("low"), F.asc("node")]
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(*by_score))).where(F.col("place") <= most)
    best = materialise(best.select("item", "score", "node", "low"), "best-classes")
    wanted = members.join(best.select("node").distinct(), "node", "left_semi")
    in_class = Window.partitionBy("node").orderBy(F.asc_nulls_last("doc_id"))
    wanted = wanted.withColumn("place", F.row_number().over(in_class)).where(F.col("place") <= most).select("node", "doc_id", F.lit(True).alias("several"))
    placed = best.join(wanted, "node", "left").select("item", F.when(F.col("several"), F.col("doc_id")).otherwise(F.col("low")).alias("doc_id"), "score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = placed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(own)], "number long, item long") if len(own) else None
    return ranked if names is None else ranked.withColumnRenamed("item", "number").join(names, "number").select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, most: int = MOST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``most`` best documents of ``docs`` (doc_id, text) for every row of ``items`` (item_id, text).

    Returns item_id, rank, doc_id, score. Words are runs of ASCII letters and digits and of other characters beyond ASCII, A-Z
    in lower case. Null and empty texts have no words: such an item gets no rows, such a document is in none. Equal scores rank
    by doc_id, null last. Repeated documents each take a place, repeated items are ranked each by itself, and
    empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = items.select("item_id", text_or_empty().cast("string").alias("text")).withColumn("item", F.monotonically_increasing_id())
    numbered = materialise(numbered, "items")
    terms = materialise(numbered.select("item", "text").mapInArrow(_item_terms, "item long, term string, uses long"), "item-terms")
    block, n = _blocks(terms, block_terms)
    parts = [_ranked(docs, terms.where(block == b).toArrow(), most) for b in range(n)]
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionByName(part)
    out = ranked.join(numbered.select("item", "item_id"), "item")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), F.col("doc_id").cast(kind).alias("doc_id"), "score")
