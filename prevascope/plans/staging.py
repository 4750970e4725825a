"""Typed staging of the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.config import KEY_COLUMNS, MEASURE_COLUMNS, METADATA_COLUMNS, POPULATION_COLUMNS
from prevascope.functions.casts import BLANK_NULL, text_to_int, text_to_measure, to_instant
from prevascope.operators.dedupe import latest_per_entity


def stage(raw: DataFrame, cast_mode: str = BLANK_NULL, dedupe: bool = False, parse_extracted_at: bool = True) -> DataFrame:
    """Select, rename and type the raw columns; rows without state or county name are left out.

    Raw columns beyond the named ones are never read; metadata columns the table lacks are null.
    ``dedupe`` first keeps the latest load of each entity, which undoes repeated loads of the same
    file; an entity whose latest load lacks the state is left out, not replaced by an older load. No order is imposed: readers sort where they need to.
    """
    if dedupe:
        raw = latest_per_entity(raw, "countyfips")
    raw = raw.where(F.col("stateabbr").isNotNull() & F.col("countyname").isNotNull())
    metadata = {
        out: F.col(c) if c in raw.columns else F.lit(None).cast("string") for c, out in METADATA_COLUMNS.items()
    }
    if parse_extracted_at and "extracted_at" in raw.columns:
        metadata["extracted_at"] = to_instant(F.col("extracted_at"))
    return raw.select(
        *[F.col(c).alias(out) for c, out in KEY_COLUMNS.items()],
        *[text_to_int(F.col(c), cast_mode).alias(out) for c, out in POPULATION_COLUMNS.items()],
        *[text_to_measure(F.col(c), cast_mode).alias(out) for c, out in MEASURE_COLUMNS.items()],
        *[c.alias(out) for out, c in metadata.items()],
    )
