"""Pre-aggregate that answers exact distinct counts at every coarser grain
(MET4, MET11, AGG10).

Counts of distinct orders or customers do not add up over months or segments, so
each grain usually needs a pass over the fact. Here a group keeps, per integer
key, the set of its values as bitmaps of 32,768 bits, one per block of keys.
Bitmaps of a coarser group are the bitwise or of those of its parts, and their
bits are the distinct count: exact, and merged from small rows. Sums and counts
stand beside them.

The table lies in month folders under a manifest, like the line fact: after a
merge, :meth:`DistinctRollup.refresh` rebuilds the months that the merge rewrote
and commits them together.

At scale: the fact is first reduced to one row per group and key (partial
aggregates before the shuffle); dimensions are joined to those rows, not to
lines; a bitmap is one key's block in one group, so no task gathers a group's
keys, and a hot group is spread over its blocks. Bitmaps pay where the keys of a
group lie close together; where they are strewn, they are mostly zeros, which
compress, but a group of few strewn keys takes more room than the keys would.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import MONEY_SUM
from ..operators.incremental import NO_PARTITION, PARTITION_COL, Version, _clean, _commit, _drop_commit, _read, _write, read_table
from .joins import join_small

#: Grains above the month, as a function of the month.
GRAINS = ("month", "quarter", "year")


class DistinctRollup:
    """``ids``: integer key columns to count; ``sums``: money columns to add up;
    ``dims``: columns to group by, of the fact or of ``lookup``, a dimension table
    with one row per ``lookup_key`` (a fact row without one gets nulls)."""

    def __init__(self, spark: SparkSession, path: str, dims: Sequence[str], ids: Sequence[str], sums: Sequence[str] = (),
                 lookup: DataFrame | None = None, lookup_key: str | None = None, date_col: str = "order_date"):
        self.spark, self.path, self.date_col = spark, path.rstrip("/"), date_col
        self.dims, self.ids, self.sums = tuple(dims), tuple(ids), tuple(sums)
        self.lookup, self.lookup_key = lookup, lookup_key

    def _groups(self, fact: DataFrame) -> DataFrame:
        """Rows (month, dims, id_name, block, bits, rows, sums): bitmaps per key, and
        one row per group with the counts and sums, whose id_name is null."""
        own = [c for c in self.dims if c in fact.columns]
        keys = list(dict.fromkeys([*own, *self.ids, *([self.lookup_key] if self.lookup is not None else [])]))
        month = F.trunc(F.col(self.date_col), "month").alias(PARTITION_COL)
        one = fact.groupBy(month, *keys).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).cast(MONEY_SUM).alias(f"sum_{c}") for c in self.sums])
        if self.lookup is not None:
            found = [c for c in self.dims if c not in own]
            one = join_small(one, self.lookup.select(self.lookup_key, *found), self.lookup_key, "left")
        at = [PARTITION_COL, *self.dims]
        none = [F.lit(None).cast(t).alias(c) for c, t in (("id_name", "string"), ("block", "long"), ("bits", "binary"))]
        out = one.groupBy(*at).agg(F.sum("rows").alias("rows"), *[F.sum(f"sum_{c}").cast(MONEY_SUM).alias(f"sum_{c}") for c in self.sums])
        out = out.select(*at, *none, "rows", *[f"sum_{c}" for c in self.sums])
        for c in self.ids:
            bits = one.filter(F.col(c).isNotNull()).groupBy(*at, F.bitmap_bucket_number(c).alias("block")) \
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(c))).alias("bits"))
            out = out.unionByName(bits.withColumn("id_name", F.lit(c)), allowMissingColumns=True)
        return out

    def build(self, fact: DataFrame) -> None:
        """Replace the whole table."""
        self._put(self._groups(fact), None)

    def refresh(self, fact: DataFrame, months: Sequence[dt.date | None]) -> None:
        """Rebuild ``months`` (of a merge: ``partitions_rewritten``) from ``fact``,
        which is read for these months only if it is partitioned by month."""
        month = F.trunc(F.col(self.date_col), "month")
        if PARTITION_COL in fact.columns:
            month = F.col(PARTITION_COL)
        wanted = month.isin([m for m in months if m is not None])
        if None in months:
            wanted = wanted | month.isNull()
        rows = fact.filter(wanted)
        self._put(self._groups(rows.drop(PARTITION_COL)), [NO_PARTITION if m is None else m.isoformat() for m in months])

    def _put(self, groups: DataFrame, months: list[str] | None) -> None:
        before, commit = Version.load(self.spark, self.path), uuid.uuid4().hex
        try:
            new = _write(self.spark, self.path, groups, commit)
        except BaseException:
            _drop_commit(self.spark, self.path, commit)
            raise
        kept = {} if months is None or before is None else {m: c for m, c in before.months.items() if m not in months}
        number = before.number if before else 0
        _commit(self.spark, self.path, number, Version(number + 1, groups.schema, kept | new, None))
        _clean(self.spark, self.path, 0)

    def query(self, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """Counts, sums and ``distinct_<id>`` by dims and grains (month, quarter,
        year), of the groups that pass ``where`` (on dims and ``order_month``)."""
        unknown = [c for c in by if c not in (*self.dims, *GRAINS)]
        if unknown:
            raise ValueError(f"the rollup has no {', '.join(unknown)}")
        rows = read_table(self.spark, self.path, keep_partition_col=True)
        if rows is None:
            raise ValueError(f"{self.path} holds no rollup")
        rows = rows if where is None else rows.filter(where)
        keys = [F.date_trunc(c, PARTITION_COL).cast("date").alias(c) if c in GRAINS else F.col(c) for c in by]
        plain = [F.sum("rows").alias("rows"), *[F.sum(f"sum_{c}").cast(MONEY_SUM).alias(f"sum_{c}") for c in self.sums]]
        blocks = rows.groupBy(*keys, "id_name", "block").agg(F.bitmap_or_agg("bits").alias("bits"), *plain)
        counts = [F.coalesce(F.sum(F.when(F.col("id_name") == c, F.bitmap_count("bits"))), F.lit(0)).cast("long").alias(f"distinct_{c}")
                  for c in self.ids]
        return blocks.groupBy(*by).agg(*plain, *counts)

    def table(self) -> DataFrame | None:
        version = Version.load(self.spark, self.path)
        return version and _read(self.spark, self.path, version.folders(), version.schema)
