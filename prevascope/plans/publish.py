"""Versions of a table behind a view.

A run writes each model into a table of its own, ``<name>__v<run>``, and switches the view ``<name>`` to it once all models
are written and their contracts hold. Frames of an earlier run keep reading that run's tables, and a run that fails changes
nothing that readers see. Versions beyond the newest few are dropped by the run after them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession

from prevascope.operators.contracts import Rule, failure_counts

#: Published versions of a table that stay.
KEEP = 2
MARK = "__v"
#: Property of a version that holds its contract failures.
NOTE = "contract_failures"


def new_run() -> str:
    """A name that sorts by time and belongs to one run."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def version_of(table: str, run: str) -> str:
    return f"{table}{MARK}{run}"


def write_version(df: DataFrame, table: str, run: str) -> DataFrame:
    """Write ``df`` as this run's version of ``table`` and return the written table, whose size Spark then knows."""
    name = version_of(table, run)
    df.write.saveAsTable(name)
    return df.sparkSession.table(name)


def counting(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation | None]:
    """``df`` that counts the rows that break each rule as it is written, None if the column of one is not there."""
    if not rules or not all(r.column in df.columns for r in rules):
        return df, None
    seen = Observation()
    return df.observe(seen, *failure_counts(rules)), seen


def note_counts(spark: SparkSession, version: str, rules: Sequence[Rule], seen: Observation) -> None:
    """Keep what was counted while ``version`` was written as a property of it."""
    note = json.dumps({_text(r): seen.get[f"_{i}"] for i, r in enumerate(rules)}).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{NOTE}' = '{note}')")


def _text(rule: Rule) -> str:
    return f"{rule.rule} {rule.column} {getattr(rule, 'values', '')}"


def noted_counts(spark: SparkSession, version: str, rules: Sequence[Rule]) -> dict[str, int] | None:
    """Rows of a version that break each rule, as counted when it was written; None if one was not counted."""
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {version}").collect()}
    counts = json.loads(properties.get(NOTE, "{}"))
    found = {f"_{i}": counts.get(_text(r)) for i, r in enumerate(rules)}
    return None if None in found.values() else found


def versions(spark: SparkSession, table: str) -> list[str]:
    """Versions of ``table``, oldest first, published or not."""
    space, name = table.rsplit(".", 1)
    found = spark.sql(f"SHOW TABLES IN {space} LIKE '{name.lower()}{MARK}*'").where("not isTemporary").select("tableName").collect()
    return sorted(f"{space}.{r.tableName}" for r in found)


def published(spark: SparkSession, table: str) -> str | None:
    """The version that the view ``table`` shows, None if it is no such view."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return next((r.value for r in rows if r.key == "published"), None)


def publish(spark: SparkSession, tables: Mapping[str, str], keep: int = KEEP) -> None:
    """Switch the view of each table to its version, the last ones named last, and retire older versions.

    ``tables`` maps a table to the version (:func:`version_of`) it shall show. A plain table of that name, as an earlier way of
    writing has left it, is replaced by the view. Unpublished versions older than the published one are retired with it.
    """
    for table, version in tables.items():
        if spark.catalog.tableExists(table) and published(spark, table) is None:
            spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('published' = '{version}') AS SELECT * FROM {version}")
    for table, version in tables.items():
        older = [v for v in versions(spark, table) if v < version.lower()]
        for old in older[: len(older) - (keep - 1)] if keep > 1 else older:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
