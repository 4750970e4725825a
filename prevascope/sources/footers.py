"""Counts and bounds of Parquet files from their footers: no data page is read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prevascope.sources.raw_table import record_counts

#: Types whose footer bounds are those of the values; a footer says nothing of NaN, and cuts long text.
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
INSTANTS = (T.TimestampType, T.TimestampNTZType)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer plain aggregates from footers."""
    own = spark.newSession()
    sources = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources if s != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def _aggregate(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    facts = [F.count(F.lit(1)).alias("records")]
    for c in columns:
        facts += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count(c).alias(f"values_{c}")]
    return spark.read.schema(schema).parquet(path).agg(*facts)


def _from_footers(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    """The aggregate with instants read as the microseconds that files hold, whose bounds a footer has."""
    plain = [T.StructField(f.name, T.LongType() if isinstance(f.dataType, INSTANTS) else f.dataType) for f in schema]
    return _aggregate(_footer_session(spark), path, T.StructType(plain), columns)


def _instant(micros: int | None, kind: T.DataType) -> datetime | None:
    if micros is None:
        return None
    start = datetime(1970, 1, 1, tzinfo=timezone.utc if isinstance(kind, T.TimestampType) else None)
    return start + timedelta(microseconds=micros)


def file_bounds(spark: SparkSession, path: str, columns: Sequence[str] = (), uniform: bool = False) -> DataFrame:
    """One row: ``records``, and ``min_<c>``, ``max_<c>``, ``values_<c>`` (those not null) of each column.

    The count comes from the footers. So do the bounds of integers, dates and instants if ``uniform`` states that all files
    have the same columns in the same order, since footers are read by position, and store instants in microseconds
    (``spark.sql.parquet.outputTimestampType`` TIMESTAMP_MICROS); the files of one write have. Otherwise, and for other types
    and footers that lack the bounds, the columns are scanned, which gives the same row. Computed at once, as the
    way of reading is a setting of the session that plans it. Without rows the bounds are null.
    """
    full = spark.read.parquet(path).schema
    kinds = {c: full[c].dataType for c in columns}
    fields = [T.StructField("records", T.LongType())]
    for c, kind in kinds.items():
        fields += [T.StructField(f"min_{c}", kind), T.StructField(f"max_{c}", kind), T.StructField(f"values_{c}", T.LongType())]
    row = None
    if not kinds or (uniform and all(isinstance(k, BOUNDED + INSTANTS) for k in kinds.values())):
        try:
            row = _from_footers(spark, path, full, list(kinds)).first().asDict()
            # sums over no footers of a block are null
            row |= {c: row[c] or 0 for c in ("records", *[f"values_{c}" for c in kinds])}
            for c, kind in kinds.items():
                if isinstance(kind, INSTANTS):
                    row |= {f"{end}_{c}": _instant(row[f"{end}_{c}"], kind) for end in ("min", "max")}
        except (PySparkException, Py4JJavaError):  # a footer without bounds, or instants in the older format
            row = None
    if row is None:
        return _aggregate(spark, path, full, list(kinds))
    return spark.createDataFrame([tuple(row[f.name] for f in fields)], T.StructType(fields))


def record_counts_of_files(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per name: ``table_name``, ``records``, without reading any data."""
    own = _footer_session(spark)
    counted = record_counts({name: own.read.parquet(path) for name, path in paths.items()})
    counts = [(r.table_name, r.records or 0) for r in counted.collect()]
    return spark.createDataFrame(counts, "table_name string, records bigint")
