"""Choices made from a schema alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that ``df`` has, or None."""
    return next((c for c in candidates if c in df.columns), None)
