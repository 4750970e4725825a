"""Latest load per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_entity(
    df: DataFrame,
    key: str,
    loaded_at: str = "loaded_at",
    source_file: str = "source_file",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Keep each entity's row from its latest load; rows without a key are kept as they are.

    Ranks above one are dropped inside each task before the shuffle, so an entity with very many
    copies sends one row per task. A row without a key is a group of its own, in the same scan.
    """
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    newest = Window.partitionBy(key, alone).orderBy(
        F.col(loaded_at).desc_nulls_last(),
        F.col(source_file).desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in tie_break],
    )
    return df.withColumn("_newest", F.row_number().over(newest)).where(F.col("_newest") == 1).drop("_newest")
