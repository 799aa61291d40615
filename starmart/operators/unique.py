"""Uniqueness kept up with a month-partitioned table (DQ1, DQ5).

A full check groups every key of the table. Here each month's keys are kept as
64-bit digests with their number of rows. After a merge, only the months it
rewrote are read again; a key is suspect where its digest occurs more than once,
in one month or in several, and only the months that hold a suspect are read to
tell repeated keys from equal digests of different keys. The result equals the
full check.

Digests are grouped with partial aggregation, so a key in a third of all rows is
one row per task and month. The table lies in month folders under a manifest.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import join_small, maybe_among
from ..session import scratch_path
from .incremental import NO_PARTITION, PARTITION_COL, Version, _clean, _commit, _drop_commit, _write, read_table


class UniqueKeys:
    """Digests of ``keys`` per month, kept at ``path``. With ``nulls`` rows whose key
    holds a null count as keys like others (DQ5), without they are left out (DQ1)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], nulls: bool = True):
        self.spark, self.path, self.keys, self.nulls = spark, path.rstrip("/"), tuple(keys), nulls

    def _keyed(self, table: DataFrame) -> DataFrame:
        for c in () if self.nulls else self.keys:
            table = table.filter(F.col(c).isNotNull())
        named = F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")) for c in self.keys])
        return table.withColumn("digest", F.xxhash64(named))

    def _put(self, rows: DataFrame, months: list[str] | None) -> None:
        before, commit = Version.load(self.spark, self.path), uuid.uuid4().hex
        digests = self._keyed(rows).groupBy(PARTITION_COL, "digest").agg(F.count(F.lit(1)).alias("n"))
        try:
            new = _write(self.spark, self.path, digests, commit)
        except BaseException:
            _drop_commit(self.spark, self.path, commit)
            raise
        kept = {} if months is None or before is None else {m: c for m, c in before.months.items() if m not in months}
        number = before.number if before else 0
        _commit(self.spark, self.path, number, Version(number + 1, digests.schema, kept | new, None))
        _clean(self.spark, self.path, 0)

    def build(self, table: DataFrame) -> None:
        """Digest ``table`` (with its month column) as a whole."""
        self._put(table, None)

    def refresh(self, table: DataFrame, months: Sequence[dt.date | None]) -> None:
        """Digest the given months anew (of a merge: ``partitions_rewritten``)."""
        self._put(table.filter(self._in(months)), [NO_PARTITION if m is None else m.isoformat() for m in months])

    @staticmethod
    def _in(months: Sequence[dt.date | None]):
        wanted = F.col(PARTITION_COL).isin([m for m in months if m is not None])
        return wanted | F.col(PARTITION_COL).isNull() if None in months else wanted

    def suspects(self, months: Sequence[dt.date | None] | None = None) -> DataFrame:
        """Digests with several rows; with ``months``, those that occur there."""
        digests = read_table(self.spark, self.path, keep_partition_col=True)
        if digests is None:
            return self.spark.createDataFrame([], "digest long")
        if months is not None:
            here = digests.filter(self._in(months)).select("digest").distinct()
            digests = join_small(digests, here, "digest", "left_semi")
        return digests.groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 1").select("digest")

    def duplicates(self, table: DataFrame, months: Sequence[dt.date | None] | None = None) -> DataFrame:
        """Keys with several rows, and how many (``n_records``), as the full check
        gives them; with ``months``, those with a row in one of them."""
        keyed, path = self._keyed(table), scratch_path(self.spark, "suspects")
        self.suspects(months).write.parquet(path)  # found once, and counted
        suspects = self.spark.read.schema("digest long").parquet(path)
        n, digests = suspects.count(), read_table(self.spark, self.path, keep_partition_col=True)

        def suspected(rows: DataFrame) -> DataFrame:
            return join_small(maybe_among(rows, suspects, "digest", n), suspects, "digest", "left_semi", rows=n)

        # metadata: at most a row per month
        held = [] if digests is None else [r[0] for r in suspected(digests).select(PARTITION_COL).distinct().collect()]
        rows = suspected(keyed.filter(self._in(held)).select(*self.keys, "digest") if held else keyed.limit(0))
        return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
