"""Exact distinct counts per group that a new load brings up to date without reading the earlier ones.

Keys get consecutive numbers when a load first brings them, in the order of their group, and a load becomes bitmaps of
those numbers, one per group and 32,768 numbers. Bitmaps of any loads are united bit by bit, so a key that comes again counts once.
Below the path of an index are two Parquet folders, ``codes`` and ``bitmaps``, with a folder for each load; one counts once its
write is committed, so an ``add`` that died is repeated as a whole or from the codes on. One process at a time adds loads.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.operators.numbering import numbered_by_sort
from prevascope.session import materialise

CODES, BITMAPS = "codes", "bitmaps"


@dataclass(frozen=True)
class DistinctIndex:
    """Distinct values of ``key`` per ``group_cols``, kept below ``path`` (a folder that outlives runs, not scratch)."""

    spark: SparkSession
    path: str
    key: str
    group_cols: tuple[str, ...]

    def loads(self, kind: str = BITMAPS) -> list[str]:
        """Names of the loads that have been added, sorted."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [status.getPath() for status in files.listStatus(folder)]
        committed = [p for p in names if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(p.getName().removeprefix("load=") for p in committed)

    def _read(self, kind: str, names: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{kind}/load={n}" for n in names])

    def _write(self, df: DataFrame, kind: str, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{kind}/load={name}")

    def add(self, load: DataFrame, name: str) -> bool:
        """Add the rows of ``load``; False, and nothing done, if a load of that name has been added.

        Null keys do not count, as in ``count(distinct ...)``; a null group is a group. Other columns are not read.
        """
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
            raise ValueError(f"a load's name is made of letters, digits, '_', '.' and '-', not {name!r}")
        if name in self.loads():
            return False
        columns = [*self.group_cols, self.key]
        pairs = materialise(load.select(*columns).where(F.col(self.key).isNotNull()).distinct(), "pairs")
        if name not in self.loads(CODES):
            self._write(self._new_codes(pairs), CODES, name)
        codes = self._read(CODES, self.loads(CODES))
        bits = (
            pairs.join(codes, self.key)
            .groupBy(*self.group_cols, F.expr("bitmap_bucket_number(_code)").alias("_bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_code))").alias("_bits"))
        )
        self._write(bits, BITMAPS, name)
        return True

    def _new_codes(self, pairs: DataFrame) -> DataFrame:
        """(key, _code) of keys not met before; those of a group lie side by side, so that it has few bitmaps."""
        first = pairs.groupBy(self.key).agg(F.min(F.struct(*self.group_cols)).alias("_group"))
        start, known = 0, self.loads(CODES)
        if known:
            codes = self._read(CODES, known)
            first = first.join(codes.select(self.key), self.key, "left_anti")
            start = codes.agg(F.max("_code")).first()[0] or 0
        numbered = numbered_by_sort(first, [], [F.col("_group"), F.col(self.key)], "_code", keep=[self.key])
        return numbered.withColumn("_code", F.col("_code") + start)

    def counts(self, name: str = "distinct", loads: Sequence[str] | None = None) -> DataFrame:
        """Distinct keys of each group (``name``) over all loads, or over those named."""
        names = self.loads() if loads is None else list(loads)
        if missing := set(names) - set(self.loads()) or not names:
            raise LookupError(f"no such load: {missing}" if names else "no load has been added")
        united = self._read(BITMAPS, names).groupBy(*self.group_cols, "_bucket").agg(
            F.expr("bitmap_or_agg(_bits)").alias("_bits")
        )
        return united.groupBy(*self.group_cols).agg(F.sum(F.expr("bitmap_count(_bits)")).alias(name))


def with_counts(df: DataFrame, counts: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """The rows of ``df`` (one per group) with the columns of ``counts``; null groups meet."""
    right = counts.select(*[F.col(c).alias(f"_{c}") for c in group_cols], *[c for c in counts.columns if c not in group_cols])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group_cols])
    return df.join(right, same, "left").drop(*[f"_{c}" for c in group_cols])
