"""The latest row of each entity, kept up to date batch by batch.

Entities are dealt to buckets. The rows of a bucket after some merge are a part, a partition of the table ``<name>__parts``, and a
merge writes new parts for the buckets its batch touches and reads the old parts of these alone. The view ``<name>`` lists the
parts that are current, so that readers see the state before a merge or after it, and a merge that fails changes nothing
they see. Merging a batch again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.operators.dedupe import latest_per_entity
from prevascope.session import materialise
from prevascope.sources.raw_table import aligned

BUCKETS = 256
PART = "_part"


def parts_of(name: str) -> str:
    """Name of the table that holds the parts of ``name``."""
    return f"{name}__parts"


def current_parts(spark: SparkSession, name: str) -> dict[int, str]:
    """The current part of each bucket that has rows."""
    if not spark.catalog.tableExists(name):
        return {}
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    state = next((r.value for r in found if r.key == "current"), "{}")
    return {int(bucket): part for bucket, part in json.loads(state).items()}


def _buckets(spark: SparkSession, name: str, buckets: int) -> int:
    """The number of buckets the table was made with."""
    if spark.catalog.tableExists(parts_of(name)):
        found = spark.sql(f"SHOW TBLPROPERTIES {parts_of(name)}").collect()
        return next((int(r.value) for r in found if r.key == "buckets"), buckets)
    return buckets


def _rows_of(spark: SparkSession, name: str, parts: Sequence[str]) -> DataFrame:
    return spark.table(parts_of(name)).where(F.col(PART).isin(list(parts)))


def merge_batch(
    batch: DataFrame,
    name: str,
    key: str,
    loaded_at: str = "loaded_at",
    source_file: str = "source_file",
    tie_break: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merge ``batch`` into the current table ``name`` and return it as it is then.

    An entity's row is that of its latest load, as :func:`~prevascope.operators.dedupe.latest_per_entity` has it; an older row
    that comes later is left out. Rows without a key are kept, once each, beside one another. Columns that are new are
    added and null in earlier rows. The number of buckets is fixed by the first merge; at most that many names reach the driver. Parts that
    the merge before this one has replaced are dropped, so that a frame outlives one merge. One merge at a time.
    """
    spark = batch.sparkSession
    buckets = _buckets(spark, name, buckets)
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    batch = materialise(batch.withColumn("_bucket", bucket), "batch")
    touched = sorted(r[0] for r in batch.select("_bucket").distinct().collect())
    before, run = current_parts(spark, name), uuid.uuid4().hex[:12]
    if not spark.catalog.tableExists(parts_of(name)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.drop("_bucket").schema.fields)
        spark.sql(
            f"CREATE TABLE {parts_of(name)} ({columns}, {PART} string) USING parquet PARTITIONED BY ({PART}) TBLPROPERTIES ('buckets' = '{buckets}')"
        )
    old = _rows_of(spark, name, [before[b] for b in touched if b in before])
    known = old.drop(PART).withColumn("_bucket", bucket)
    keyed = known.unionByName(batch, allowMissingColumns=True)
    latest = latest_per_entity(keyed.where(F.col(key).isNotNull()), key, loaded_at, source_file, tie_break)
    merged = latest.unionByName(keyed.where(F.col(key).isNull()).distinct())
    merged = merged.withColumn(PART, F.format_string(f"b%05d-{run}", "_bucket")).drop("_bucket")
    # a bucket is written by the task that has merged it
    aligned(merged.repartition(PART), parts_of(name)).write.insertInto(parts_of(name))
    _show(spark, name, {**before, **{b: f"b{b:05d}-{run}" for b in touched}})
    _retire(spark, name, set(before.values()))
    return spark.table(name)


def _show(spark: SparkSession, name: str, parts: dict[int, str]) -> None:
    columns = ", ".join(f"`{c}`" for c in spark.table(parts_of(name)).columns if c != PART)
    listed = ", ".join(f"'{p}'" for p in sorted(parts.values()))
    where = f"{PART} IN ({listed})" if parts else "false"
    state = json.dumps(parts)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('current' = '{state}') AS SELECT {columns} FROM {parts_of(name)} WHERE {where}")


def _retire(spark: SparkSession, name: str, before: set[str]) -> None:
    """Drop the parts that neither the state now nor the one before shows."""
    kept = before | set(current_parts(spark, name).values())
    present = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {parts_of(name)}").collect()]
    gone = [p for p in present if p not in kept]
    if gone:
        dropped = ", ".join(f"PARTITION ({PART} = '{p}')" for p in gone)
        spark.sql(f"ALTER TABLE {parts_of(name)} DROP IF EXISTS {dropped}")
