"""An index over files in the order of some columns: pages, the latest rows and cursors read only the files they meet.

One distributed sort writes the rows to files of a bounded number of rows, in order. A table with a row for each file holds its first
and last key and the number of rows before it. A row's position is that number and its place in the file, which the
reader knows, so that no page sorts or counts anything beyond its own files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prevascope.sources.landing import escaped

ROWS_PER_FILE = 1_000_000
POSITION = "position"


def build_order_index(df: DataFrame, keys: Sequence[str], path: str, rows_per_file: int = ROWS_PER_FILE) -> OrderIndex:
    """Sort ``df`` by ``keys`` (ascending, nulls last) into files below ``path``, which must not exist, and index them.

    Rows that share all keys come in any order, which is fixed once they are written. ``keys`` should end in a unique column,
    as a value that very many rows share cannot be split between tasks.
    """
    keys = list(keys)
    order = [F.col(k).asc_nulls_last() for k in keys]
    df.orderBy(*order).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).parquet(f"{escaped(path)}/rows")
    # the first and last rows of a file are its least and greatest keys
    at = F.col("_metadata.row_index")
    key = F.struct(*keys)
    files = rows.select(F.col("_metadata.file_path").alias("file"), at.alias("at"), key.alias("key")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last")
    )
    # files are numbered by the tasks that wrote them and within a task; the window sees one row for each file
    number = [F.regexp_extract("file", pattern, 1).cast("long") for pattern in (r"/part-(\d+)-[^/]*$", r"-c(\d+)\.[^/]*$")]
    before = F.sum("rows").over(Window.orderBy(*number).rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("before", F.coalesce(before, F.lit(0).cast("long")))
    files.coalesce(1).write.parquet(f"{path}/files")
    return OrderIndex(spark, path, keys, df.schema)


class OrderIndex:
    """Rows in order below ``path``, as :func:`build_order_index` has written them."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema=None):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.schema = schema or spark.read.parquet(f"{escaped(path)}/rows").schema
        self.files = spark.read.parquet(f"{escaped(path)}/files")

    def count(self) -> int:
        """Rows of the table, from the index alone."""
        return self.files.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _read(self, files: list) -> DataFrame:
        """Rows of the given rows of the index, with their position."""
        if not files:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn(POSITION, F.lit(None).cast("long"))
        plain = {r.file: r.before for r in files}
        read = self.spark.read.schema(self.schema).parquet(*[escaped(unquote(f)) for f in plain])
        before = F.create_map(*[F.lit(x) for pair in plain.items() for x in pair])
        return read.withColumn(POSITION, before[F.col("_metadata.file_path")] + F.col("_metadata.row_index") + 1)

    def between(self, first: int, last: int) -> DataFrame:
        """Rows number ``first`` to ``last`` (from 1, both included) with their position, in order."""
        met = self.files.where((F.col("before") < last) & (F.col("before") + F.col("rows") >= first)).collect()  # of the page alone
        return self._read(met).where(F.col(POSITION).between(first, last)).orderBy(POSITION)

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows after the first ``offset``, at most ``limit``."""
        return self.between(offset + 1, offset + limit)

    def last(self, limit: int) -> DataFrame:
        """The last ``limit`` rows of the order, the very last one first."""
        total = self.count()
        return self.between(max(0, total - limit) + 1, total).orderBy(F.desc(POSITION))

    def after(self, key: Mapping[str, Any] | None, limit: int) -> DataFrame:
        """The first ``limit`` rows beyond ``key`` (values of the keys; None for the start), however deep they lie.

        Pages that follow one another by the key of the last row seen cost the same each, and neither skip nor repeat a row
        when keys are unique.
        """
        if key is None:
            return self.page(0, limit)
        values = [F.lit(key[k]).cast(self.schema[k].dataType) for k in self.keys]
        met = self.files.where(_beyond([F.col(f"last.{k}") for k in self.keys], values))
        start = met.agg(F.min("before")).first()[0]
        if start is None:
            return self._read([])
        # the first file may have passed the key up to its last row
        first = self.files.where(F.col("before") == start).agg(F.max("rows")).first()[0]
        met = self.files.where((F.col("before") >= start) & (F.col("before") < start + first + limit)).collect()
        rows = self._read(met).where(_beyond([F.col(k) for k in self.keys], values))
        return rows.orderBy(POSITION).limit(limit)


def _beyond(columns: list[Column], values: list[Column]) -> Column:
    """Whether columns come after values in ascending order, nulls last."""
    cases = []
    for i, (column, value) in enumerate(zip(columns, values)):
        larger = (column > value) | (column.isNull() & value.isNotNull())
        equal = [c.eqNullSafe(v) for c, v in zip(columns[:i], values[:i])]
        cases.append(reduce(lambda a, b: a & b, [*equal, F.coalesce(larger, F.lit(False))]))
    return reduce(or_, cases)
