"""From raw documents to pieces: toxicity, exact and near duplicates, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; ``docs`` has the columns of
``documents``. Decisions are made by doc_id and text, so rows that share an id only are told apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.llm import contamination, exact_dedup, near_dedup, pieces, toxicity
from prevascope.llm.common import table, without
from prevascope.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic by a model of the labelled ones."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return without(docs, toxicity.score(docs, model).where("predicted = 1"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id; a row that repeats it wholly stays once."""
    decided = materialise(exact_dedup.exact_duplicates(docs), "exact")
    lost = decided.where("not kept").select("doc_id", F.col("text_sha256").alias("lost_sha"))
    sha = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"), 256)
    left = docs.join(lost, docs["doc_id"].eqNullSafe(lost["doc_id"]) & (sha == lost["lost_sha"]), "left_anti")
    twice = decided.where("kept and group_size > 1").groupBy("doc_id", "text_sha256").count().where("count > 1")
    return left if twice.isEmpty() else left.dropDuplicates(["doc_id", "text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id; if several have it, one of them."""
    decided = materialise(near_dedup.near_duplicates(docs), "near")
    lost = decided.where("not kept").select("doc_id", "text_key")
    kept = decided.where("kept and n_shingles > 0").groupBy("component_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("text_key").alias("first_key")
    )
    several = materialise(kept.where("n > 1"), "several")
    if not several.isEmpty():
        extra = decided.where("kept").join(several, decided["component_id"].eqNullSafe(several["component_id"]))
        lost = lost.unionByName(extra.where("text_key != first_key").select("doc_id", "text_key"))
        return without(docs, lost).dropDuplicates(["doc_id", "text"])
    return without(docs, lost)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark passages."""
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of what is left, as digests that have been decoded again."""
    return pieces.encode(docs, digest=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pieces", encode),
]
#: No SQL scores texts or draws segmentations; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
