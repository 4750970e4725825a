"""JSON landing files: reading, fault isolation, provenance, writing."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prevascope.config import (
    DATASET_ID,
    KEY_COLUMNS,
    LANDING_MARK,
    LANDING_PREFIX,
    MEASURE_COLUMNS,
    PAGE_SIZE,
    POPULATION_COLUMNS,
    SOURCE_LABEL,
)
from prevascope.session import materialise

log = logging.getLogger(__name__)

AUTO, DOCUMENT, LINES = "auto", "document", "lines"

#: the columns staging reads, all text as landed; other keys of a record are never parsed
LANDING_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in [*KEY_COLUMNS, *POPULATION_COLUMNS, *MEASURE_COLUMNS]]
    + [T.StructField(c, T.StringType()) for c in ["extracted_at", "source", "dataset_id"]]
)


class Landed(NamedTuple):
    """Records that could be read, ``(source_file, content)`` of what could not, and the parsed values that both come from.

    ``values`` has source_file, content and records (null if unreadable), so that one pass over it can serve both.
    """

    records: DataFrame
    quarantine: DataFrame
    values: DataFrame | None = None


def parsed_values(values: DataFrame, schema: T.StructType) -> DataFrame:
    """(source_file, content, records) of JSON values ``(value, source_file)``; records are null if the value cannot be read.

    A value is a list, an envelope ``{"data": [...]}`` or a record. It is parsed once, as the only element of a list, so anything
    after it makes it unreadable rather than being passed over. An envelope whose data is null holds no records. A
    key that a record lacks is null. The generator keeps the parsed value, which expressions above it read many times.
    """
    enveloped = "data" not in schema.names
    wide = T.StructType([*schema.fields, T.StructField("data", T.ArrayType(schema))]) if enveloped else schema
    value, listed = F.col("value"), F.ltrim("value").startswith("[")
    text = F.concat(F.lit("["), value, F.lit("]"))
    parsed = F.struct(
        F.when(listed, F.from_json(text, T.ArrayType(T.ArrayType(schema)))).alias("lists"),
        F.when(~listed, F.from_json(text, T.ArrayType(wide))).alias("objects"),
    )
    stored = values.where(F.trim("value") != "").select("source_file", "value", F.explode(F.array(parsed)).alias("parsed"))
    first, none = F.expr("parsed.objects[0]"), F.array().cast(T.ArrayType(schema))
    own = F.array(first.dropFields("data") if enveloped else first)
    if enveloped:
        keyed = F.expr("""contains(value, '"data"') and array_contains(json_object_keys(value), 'data')""")
        data = F.expr("parsed.objects[0].data")
        own = F.when(data.isNotNull(), data).when(keyed, none).otherwise(own)
    records = F.when(F.expr("size(parsed.lists) = 1"), F.expr("parsed.lists[0]")).when(
        F.expr("size(parsed.objects) = 1 and parsed.objects[0] is not null and startswith(ltrim(value), '{')"), own
    )
    read = stored.select("source_file", F.col("value").alias("content"), records.alias("records"))
    # a list with something else than records in it cannot be read
    return read.withColumn("records", F.expr("if(exists(records, r -> r is null), null, records)"))


def _landed(values: DataFrame, schema: T.StructType) -> Landed:
    """Records and quarantine of parsed values."""
    return Landed(records_of(values, schema), unreadable(values), values)


def records_of(values: DataFrame, schema: T.StructType) -> DataFrame:
    read = values.where(F.col("records").isNotNull()).select("source_file", F.inline("records"))
    return read.select(*schema.names, "source_file")


def unreadable(values: DataFrame) -> DataFrame:
    return values.where(F.col("records").isNull()).select("source_file", "content")


def with_place(lines: DataFrame) -> DataFrame:
    """Lines as a text reader gives them, with their file, the place of their split and a number that grows within it."""
    return lines.select(
        F.ltrim("value", F.lit("\ufeff")).alias("value"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
    )


def _bracketed(value: Column) -> Column:
    """Whether a line starts and ends like an object or a list."""
    text = F.trim(value)
    return (text.startswith("{") & text.endswith("}")) | (text.startswith("[") & text.endswith("]"))


def _is_whole(value: Column) -> Column:
    """Whether a line is an object or list by itself."""
    return _bracketed(value) & (F.json_object_keys(value).isNotNull() | F.json_array_length(value).isNotNull())


def _document_files(lines: DataFrame) -> DataFrame:
    """(source_file) of the files that may be one JSON value over several lines.

    The first line of such a value leaves a bracket open, so it is not whole by itself. If only the last line is, the file is taken
    as lines when most of them look like values, else as a document that ends early.
    """
    place = F.struct("block", "number")
    text = F.col("value")
    by_file = lines.where(F.trim(text) != "").groupBy("source_file").agg(
        F.min_by(text, place).alias("first"), F.max_by(text, place).alias("last"),
        (2 * F.count_if(_bracketed(text)) > F.count(F.lit(1))).alias("mostly"),
    )
    return by_file.where(~_is_whole(F.col("first")) & ~(_is_whole(F.col("last")) & F.col("mostly"))).select("source_file")


def _documents(lines: DataFrame) -> DataFrame:
    """Lines put together as one value for each file."""
    placed = F.array_sort(F.collect_list(F.struct("block", "number", "value")))
    return lines.groupBy("source_file").agg(F.array_join(F.transform(placed, lambda x: x["value"]), "\n").alias("value"))


def landed_lines(lines: DataFrame, schema: T.StructType, layout: str = AUTO) -> Landed:
    """Records and quarantine of files given as lines (:func:`with_place`).

    ``auto`` reads a file line by line if its first line is a JSON value by itself, or its last one and most others are; other files
    as one value. A file that is no value, but whose lines mostly are, counts as lines after all. Names of files
    stay in a table.
    """
    if layout == LINES:
        return _landed(parsed_values(lines, schema), schema)
    if layout == DOCUMENT:
        return _landed(parsed_values(_documents(lines), schema), schema)
    names = materialise(_document_files(lines), "documents")
    if names.isEmpty():
        return _landed(parsed_values(lines, schema), schema)
    whole = materialise(parsed_values(_documents(lines.join(names, "source_file", "left_semi")), schema), "values")
    split = F.filter(F.split("content", "\n"), lambda line: F.trim(line) != "")
    mostly = 2 * F.size(F.filter(split, _is_whole)) > F.size(split)
    # decided once a value has failed as a whole
    mixed = F.when(F.col("records").isNull(), mostly).otherwise(F.lit(False))
    single = whole.where(~mixed)
    loose = whole.where(mixed).select("source_file", F.explode(split).alias("value"))
    rest = lines.join(names, "source_file", "left_anti").select("source_file", "value")
    return _landed(parsed_values(rest.unionByName(loose), schema).unionByName(single), schema)


def escaped(path: str) -> str:
    """A file's address as a path to read, with no character taken for a pattern."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def read_landing(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = LANDING_SCHEMA,
    layout: str = AUTO,
) -> Landed:
    """Read JSON files; what is not among the records is in the quarantine.

    A file holds one list, envelope or record (``document``, read whole) or one such value per line (``lines``, split over tasks,
    so large extracts should use them); ``auto`` tells by each file's lines (:func:`landed_lines`). A file or line that cannot be
    read, or goes on after its value, ends up in the quarantine and the rest still loads. A path that does
    not exist raises.
    """
    return landed_lines(with_place(spark.read.text(path if isinstance(path, str) else list(path))), schema, layout)


def read_landing_directory(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = LANDING_SCHEMA,
    layout: str = AUTO,
    mark: str = LANDING_MARK,
) -> Landed:
    """Read the ``*.json`` entries of a directory whose name contains ``mark``.

    Subdirectories are not searched, but an entry may itself be a directory of part files, as
    :func:`write_extract` leaves it. Other JSON entries are logged and skipped; a missing
    directory or one without matches is logged and yields no rows.
    """
    pattern = f"{directory.rstrip('/')}/*.json"
    try:
        names = spark.read.format("binaryFile").load(pattern).select("path").distinct()
        skipped = names.where(~_entry_name(F.col("path"), directory).contains(mark))
        for row in skipped.toLocalIterator():
            log.warning("skipped %s: its name does not contain %r", row.path, mark)
        return read_landing(spark, f"{directory.rstrip('/')}/*{mark}*.json", schema, layout)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no landing files for %s", pattern)
        records = T.ArrayType(schema)
        values = T.StructType.fromDDL("source_file string, content string").add("records", records)
        return _landed(spark.createDataFrame([], values), schema)


def listed_files(files: DataFrame) -> DataFrame:
    """(path, length, modified) of files as the binary reader lists them; their content is not read."""
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def landing_files(spark: SparkSession, directory: str, mark: str = LANDING_MARK) -> DataFrame | None:
    """The files to load of a directory, None (and a line in the log) without any."""
    try:
        return listed_files(spark.read.format("binaryFile").load(f"{directory.rstrip('/')}/*{mark}*.json"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no landing files in %s", directory)
        return None


def _entry_name(path: Column, directory: str) -> Column:
    """First path element below ``directory``."""
    base = directory.rstrip("/").rsplit("/", 1)[-1]
    return F.element_at(F.split(F.substring_index(path, f"/{base}/", -1), "/"), 1)


def with_load_provenance(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Stamp the load time; the source file comes from the reader."""
    return df.withColumn("loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)


def with_extract_provenance(
    df: DataFrame,
    extracted_at: Column | None = None,
    source: str = SOURCE_LABEL,
    dataset_id: str = DATASET_ID,
) -> DataFrame:
    """Stamp extraction time, source and dataset."""
    return df.withColumns(
        {
            "extracted_at": F.current_timestamp() if extracted_at is None else extracted_at,
            "source": F.lit(source),
            "dataset_id": F.lit(dataset_id),
        }
    )


def write_extract(
    df: DataFrame,
    directory: str,
    at: datetime | None = None,
    prefix: str = LANDING_PREFIX,
    page_size: int = PAGE_SIZE,
) -> str:
    """Write ``df`` as JSON lines to ``<directory>/<prefix>_<yyyymmdd_HHMMSS>.json``; returns the path.

    The entry is a directory of part files with at most ``page_size`` records each, written by the
    tasks that hold them. Nulls are written, so every record shows all keys.
    """
    path = f"{directory.rstrip('/')}/{prefix}_{(at or datetime.now()):%Y%m%d_%H%M%S}.json"
    df.write.option("ignoreNullFields", False).option("maxRecordsPerFile", page_size).json(path)
    return path
