"""Each landing file exactly once, by a ledger beside the raw table.

``<raw>_files`` names the batch each file belongs to, ``<raw>_batches`` the batches that are loaded. Files are entered before their
batch is written, a batch is entered once all its rows are, and its rows are a partition of the raw table that a repeated
batch replaces: whatever a failed run leaves behind, the next one brings to the same end. Batch names are unique to
the run that planned them. The ledger alone decides what is loaded; a stream's checkpoint only saves listing files again.

A batch's quality facts are taken while its rows are written and entered with it, so that the checks of the raw table
(:func:`quality_report_of_loads`) read the ledger and scan only rows that have come another way.
"""

from __future__ import annotations

import logging
import math
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prevascope.config import LANDING_MARK
from prevascope.operators.observed import combined, load_facts
from prevascope.operators.quality import quality_report_of_table, report_of_facts
from prevascope.session import materialise
from prevascope.sources.landing import (
    AUTO,
    LANDING_SCHEMA,
    Landed,
    escaped,
    listed_files,
    read_landing,
    records_of,
    unreadable,
    with_load_provenance,
)
from prevascope.sources.raw_table import aligned, append_by_name, quarantine_of

log = logging.getLogger(__name__)

#: Column of the raw table and its quarantine that names the batch which added a row.
BATCH = "ingest_batch"
#: What tells a file apart; one that has changed is a new file.
FILE = ["path", "length", "modified"]
LEASE_SECONDS = 6 * 3600


class IngestBusyError(RuntimeError):
    """Another run is loading into the table."""


def files_of(table: str) -> str:
    """Name of the ledger of files planned or loaded into ``table``."""
    return f"{table}_files"


def batches_of(table: str) -> str:
    """Name of the ledger of batches loaded into ``table``."""
    return f"{table}_batches"


def ensure_tables(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Create the raw table, its quarantine (both with a partition for each batch) and the ledger unless they exist."""
    end = f"source_file string, loaded_at timestamp, {BATCH} string"
    raw = T.StructType([*schema.fields, *T.StructType.fromDDL(end).fields])
    lost = T.StructType.fromDDL(f"source_file string, content string, loaded_at timestamp, {BATCH} string")
    files = T.StructType.fromDDL("path string, length long, modified timestamp, batch string")
    batches = T.StructType.fromDDL("batch string, files long, unreadable long, loaded_at timestamp, facts string")
    for name, kind in ((table, raw), (quarantine_of(table), lost), (files_of(table), files), (batches_of(table), batches)):
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet" + (f" PARTITIONED BY ({BATCH})" if BATCH in kind.names else ""))


def _by_batch(spark: SparkSession, table: str) -> bool:
    """Whether a partition of ``table`` is a batch."""
    return any(c.isPartition and c.name == BATCH for c in spark.catalog.listColumns(table))


def _replace_batch(df: DataFrame, table: str, batch: str) -> bool:
    """Make ``df`` the rows of the batch in ``table``, whatever an earlier attempt has left.

    In a table without partitions, which another kind of load has created, rows that are there stay; then nothing is written, which
    the result says.
    """
    spark = df.sparkSession
    df = df.withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(table):
        df.write.partitionBy(BATCH).saveAsTable(table)
        return True
    if _by_batch(spark, table):
        rows = aligned(df, table)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = '{batch}') SELECT * FROM {{rows}}", rows=rows.drop(BATCH))
    elif BATCH in spark.table(table).columns and not spark.table(table).where(F.col(BATCH) == batch).isEmpty():
        log.warning("batch %s is in %s already", batch, table)
        return False
    else:
        append_by_name(df, table)
    return True


@contextmanager
def _turn(spark: SparkSession, table: str, lease: float = LEASE_SECONDS) -> Iterator[None]:
    """One run at a time loads into ``table``; the claim of a run that died ends after ``lease`` seconds."""
    described = spark.sql(f"DESCRIBE EXTENDED {files_of(table)}").where("col_name = 'Location'").first().data_type
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{described}/_turn")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        if fs.exists(path) and time.time() - fs.getFileStatus(path).getModificationTime() / 1000 > lease:
            log.warning("%s: the claim of a run that has not ended is given up", table)
            fs.delete(path, False)
        fs.create(path, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" not in str(error.java_exception):
            raise
        raise IngestBusyError(f"another run is loading into {table}") from None
    try:
        yield
    finally:
        fs.delete(path, False)


def _new_batches() -> str:
    """What the names of a run's batches begin with."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def _plan(files: DataFrame, table: str, most: int) -> None:
    """Enter the files that are new into the ledger, dealt to batches of about ``most`` files."""
    spark = files.sparkSession
    fresh = files.join(spark.table(files_of(table)).select(*FILE), FILE, "left_anti")
    count = fresh.count()
    if count:
        run = _new_batches()
        number = F.pmod(F.xxhash64("path"), F.lit(math.ceil(count / most)))
        fresh.withColumn("batch", F.format_string(f"{run}-%06d", number)).write.insertInto(files_of(table))


def _write_batch(rows: DataFrame, table: str, batch: str) -> str | None:
    """Write a batch's rows; returns their facts, None if they were there."""
    taken = Observation()
    observed = rows.observe(taken, load_facts(rows.columns).alias("facts"))
    return taken.get["facts"] if _replace_batch(observed, table, batch) else None


def _enter(spark: SparkSession, table: str, batch: str, files: int, unreadable: int, facts: str | None) -> None:
    """Enter a batch into the ledger: from here on it is loaded."""
    values = {"batch": batch, "files": files, "unreadable": unreadable, "facts": facts}
    row = spark.range(1).select(*[F.lit(v).alias(c) for c, v in values.items()], F.current_timestamp().alias("loaded_at"))
    append_by_name(row, batches_of(table))


def _load_batch(landed: Landed, schema: T.StructType, table: str, batch: str) -> tuple[int, str | None]:
    """Write a batch's records and, if any value is unreadable, its quarantine; returns the number of such values, and the facts."""
    seen = Observation()
    unread = F.count_if(F.col("records").isNull()).alias("unreadable")
    values = landed.values.observe(seen, unread)
    facts = _write_batch(with_load_provenance(records_of(values, schema)), table, batch)
    lost = seen.get["unreadable"] if facts else landed.values.agg(unread).first().unreadable
    if lost:
        quarantine = materialise(unreadable(landed.values), "quarantine")
        for row in quarantine.groupBy("source_file").count().toLocalIterator():
            log.warning("unreadable: %s (%d values)", row.source_file, row["count"])
        _replace_batch(with_load_provenance(quarantine), quarantine_of(table), batch)
    return lost, facts


def load_files(
    files: DataFrame, table: str, schema: T.StructType = LANDING_SCHEMA, layout: str = AUTO, max_files_per_batch: int = 1000
) -> int:
    """Append the records of those ``files`` (path, length, modified) that the ledger does not know; returns the batches loaded.

    Batches that an earlier run has planned and not loaded come first; of these, files that are gone or have changed since are
    left out (changed ones are new files). What cannot be read goes to the table's quarantine and is logged.
    """
    spark = files.sparkSession
    ensure_tables(spark, table, schema)
    with _turn(spark, table):
        for name in (files_of(table), batches_of(table)):
            spark.catalog.refreshTable(name)
        present = materialise(files, "listing")
        _plan(present, table, max_files_per_batch)
        waiting = spark.table(files_of(table)).join(spark.table(batches_of(table)).select("batch"), "batch", "left_anti")
        waiting = waiting.join(present, FILE, "left_semi")
        batches = sorted(r.batch for r in waiting.select("batch").distinct().collect())
        for batch in batches:
            paths = [r.path for r in waiting.where(F.col("batch") == batch).select("path").collect()]  # of one batch
            landed = read_landing(spark, [escaped(p) for p in paths], schema, layout)
            lost, facts = _load_batch(landed, schema, table, batch)
            _enter(spark, table, batch, len(paths), lost, facts)
    return len(batches)


def load_frame(df: DataFrame, table: str) -> str:
    """Append ``df`` (with its own loaded_at and source_file, if any) to the raw table as a batch; returns the batch's name.

    Nothing tells a frame apart, so a second call appends it again; a call that fails may leave rows of a batch that is not entered.
    """
    spark = df.sparkSession
    ensure_tables(spark, table, T.StructType([f for f in df.schema.fields if f.name not in ("source_file", "loaded_at")]))
    batch = _new_batches() + "-000000"
    with _turn(spark, table):
        _enter(spark, table, batch, 0, 0, _write_batch(df, table, batch))
    return batch


def quality_report_of_loads(spark: SparkSession, table: str, **options) -> DataFrame:
    """:func:`~prevascope.operators.quality.quality_report` of a raw table from the facts of its batches.

    Rows without facts, of loads that did not go through the ledger, are scanned, and nothing else is: those of other partitions,
    or the whole of a table without partitions. Batches whose partition has been dropped do not count. Other ``roles`` than
    those of the raw table take a scan. Rows added to a batch's partition by hand are not seen.
    """
    known = spark.catalog.tableExists(table) and spark.catalog.tableExists(batches_of(table)) and _by_batch(spark, table)
    if not known or "roles" in options or "facts" not in spark.table(batches_of(table)).columns:
        return quality_report_of_table(spark, table, **options)
    raw = spark.table(table)
    there = spark.sql(f"SHOW PARTITIONS {table}").select(F.substring("partition", len(BATCH) + 2, 1 << 20).alias("batch"))
    taken = spark.table(batches_of(table)).where("facts is not null").join(there, "batch", "left_semi").select("batch", "facts")
    others = [r.batch for r in there.join(taken, "batch", "left_anti").collect()]  # names of partitions
    facts = taken.select("facts")
    if others:
        scanned = raw.where(F.col(BATCH).isNull() | F.col(BATCH).isin(others)).agg(load_facts(raw.columns).alias("facts"))
        facts = facts.unionByName(scanned)
    return report_of_facts(combined(facts), raw.columns, **options)


def ingest_new_files(
    spark: SparkSession,
    directory: str,
    table: str,
    checkpoint: str,
    schema: T.StructType = LANDING_SCHEMA,
    layout: str = AUTO,
    max_files_per_batch: int = 1000,
    **trigger,
) -> StreamingQuery:
    """Append the records of new files to ``table`` as a stream; by default what is there, then stop.

    ``trigger`` as for a stream's writer, such as ``processingTime="1 minute"``. The stream finds files, the ledger
    (:func:`load_files`) decides what is new: a checkpoint that is lost, emptied or moved neither loses records nor adds them twice.
    """
    listing = "path string, modificationTime timestamp, length long, content binary"
    found = spark.readStream.format("binaryFile").schema(listing).option("maxFilesPerTrigger", max_files_per_batch)

    def add(files: DataFrame, _: int) -> None:
        load_files(files, table, schema, layout, max_files_per_batch)

    return (
        listed_files(found.load(f"{directory.rstrip('/')}/*{LANDING_MARK}*.json"))
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
