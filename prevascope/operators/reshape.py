"""Wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.config import LONG_LABELS, MEASURE_COLUMNS, PRIORITY_MEASURES


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    labels: Mapping[str, str] = LONG_LABELS,
    name: str = "health_measure",
    value: str = "prevalence_percent",
) -> DataFrame:
    """One row per entity and non-null measure, in a single scan of ``df``.

    The measures get their labels as column names first, so the label column needs no lookup.
    """
    wide = df.select(*ids, *[F.col(c).alias(label) for c, label in labels.items()])
    return wide.unpivot(list(ids), list(labels.values()), name, value).where(F.col(value).isNotNull())


def measure_filter(df: DataFrame, labels: Sequence[str] | None, name: str = "health_measure") -> DataFrame:
    """Keep the given measures of a long table; ``None`` keeps all."""
    return df if labels is None else df.where(F.col(name).isin(list(labels)))


def labels_of_codes(
    codes: Sequence[str] = PRIORITY_MEASURES, labels: Mapping[str, str] = LONG_LABELS
) -> dict[str, str]:
    """Staged measure -> label for source codes such as ``DIABETES``.

    A measure without a label in ``labels`` keeps its staged column name as label.
    """
    staged = [MEASURE_COLUMNS[f"{code.lower()}_crudeprev"] for code in codes]
    return {column: labels.get(column, column) for column in staged}
