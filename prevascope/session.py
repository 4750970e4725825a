"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # a run has more distinct stages than the default of 100 compiled ones kept for reuse
    "spark.sql.codegen.cache.maxEntries": "1000",
    # plans are built from many small column expressions; recording the call site of each is slow
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "prevascope", master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC time, ANSI casts and adaptive execution; ``settings`` override."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    On a cluster the setting is required, because a folder of one machine is neither visible to
    the other executors nor there after the loss of that machine. A local session without it gets
    a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="prevascope-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


_scopes: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """A folder for the scratch copies of one run, deleted at its end.

    For runs whose results are written by then: a frame that still reads a scratch copy fails afterwards.
    Copies made outside any scope stay, for the shared folder's retention rule.
    """
    folder = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the current scope, else below the shared folder."""
    return f"{_scopes[-1] if _scopes else shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where a result is read several times or where a value such as a row position must not
    change when a lost task is run again. Unlike a cached frame the Parquet copy survives executor
    loss, is pruned to the columns each reader needs, and tells the optimizer its true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
