"""The append-only raw table and table inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_NAMESPACE = "raw"


def ensure_namespace(spark: SparkSession, name: str = RAW_NAMESPACE) -> None:
    """Create a namespace unless it exists."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def quarantine_of(table: str) -> str:
    """Name of the table that holds what could not be loaded into ``table``."""
    return f"{table}_quarantine"


def append_by_name(df: DataFrame, table: str) -> None:
    """Append to ``table``, matching columns by name; the first load creates the table.

    Columns that the load lacks become null. Columns that are new are added to the table first.
    """
    if not df.sparkSession.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return
    aligned(df, table).write.insertInto(table)


def aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the columns of ``table`` in its order; columns that are new are added to the table."""
    spark = df.sparkSession
    existing = {f.name: f.dataType for f in spark.table(table).schema.fields}
    added = [f for f in df.schema.fields if f.name not in existing]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    target = spark.table(table).schema
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def append_files(df: DataFrame, path: str) -> None:
    """Append a load to a Parquet folder, whose columns Spark matches by name when reading."""
    df.write.mode("append").parquet(path)


def combine_loads(loads: Sequence[DataFrame]) -> DataFrame:
    """Bag union of loads, columns matched by name, missing ones null."""
    return reduce(lambda all_, load: all_.unionByName(load, allowMissingColumns=True), loads)


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name``, ``records``."""
    return reduce(
        DataFrame.union,
        [
            df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
            for name, df in tables.items()
        ],
    )


def record_counts_or_none(spark: SparkSession, tables: Sequence[str]) -> dict[str, int]:
    """Record counts of the raw tables; empty when a table cannot be read."""
    try:
        return {r.table_name: r.records for r in record_counts({t: spark.table(t) for t in tables}).collect()}
    except AnalysisException:
        return {}


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None] | Sequence[str]) -> DataFrame:
    """One row per table: ``table_name``, ``records``, ``status`` (``ok`` or ``missing``).

    ``tables`` are catalog names, or names with their frames (None for a missing table).
    """
    if not isinstance(tables, Mapping):
        tables = {t: spark.table(t) if spark.catalog.tableExists(t) else None for t in tables}
    parts = []
    for name, df in tables.items():
        if df is None:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("records"), F.lit("missing").alias("status"))
        else:
            counted = df.agg(F.count(F.lit(1)).alias("records")).select("records", F.lit("ok").alias("status"))
        parts.append(counted.select(F.lit(name).alias("table_name"), "records", "status"))
    return reduce(DataFrame.union, parts)


def list_tables(spark: SparkSession, namespaces: Sequence[str] | None = None) -> list[str]:
    """Qualified names of the tables and views in the given namespaces (default: the current one), temporary ones left out."""
    names = namespaces or [spark.catalog.currentDatabase()]
    return [f"{ns}.{t.name}" for ns in names for t in spark.catalog.listTables(ns) if not t.isTemporary]
