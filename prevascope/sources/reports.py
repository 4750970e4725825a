"""Quality reports on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prevascope.operators.quality import CHECK_FIELDS, summary_columns

SUMMARY_FIELDS = {"total_checks": "bigint", "passed": "bigint", "failed": "bigint", "status": "string"}


def _struct(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"{name}:{kind}" for name, kind in fields.items()) + ">"


REPORT_SCHEMA = f"timestamp string, checks array<{_struct(CHECK_FIELDS)}>, summary {_struct(SUMMARY_FIELDS)}"


def nest_report(checks: DataFrame, as_of: str) -> DataFrame:
    """One row ``timestamp, checks[], summary{}`` from a check table.

    The array holds one element per check, a number fixed by the list of checks.
    """
    details = F.struct(*[F.col(c) for c in CHECK_FIELDS])
    numbered = F.array_sort(F.collect_list(F.struct("check_no", details.alias("check"))))
    return checks.agg(numbered.alias("numbered"), *summary_columns()).select(
        F.lit(as_of).alias("timestamp"),
        F.col("numbered.check").alias("checks"),
        F.struct(*SUMMARY_FIELDS).alias("summary"),
    )


def save_report(report: DataFrame, path: str) -> None:
    """Write the one-row report as a single JSON file below ``path``; timestamps become text."""
    texts = {
        f.name: F.col(f.name).cast("string")
        for f in report.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
    }
    report.withColumns(texts).coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a nested report, whether pretty-printed or written by :func:`save_report`."""
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path)


def report_summary(report: DataFrame) -> DataFrame:
    """The summary fields as a flat row."""
    return report.select("summary.*")


def report_checks(report: DataFrame) -> DataFrame:
    """One flat row per check."""
    return report.select(F.inline("checks"))
