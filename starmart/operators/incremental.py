"""Incremental load of the line fact (INC1-INC6, SNK3) on plain Parquet.

The target lies in folders ``order_month=<month>/commit=<id>``, written once and
never changed; a manifest lists the folders that make up each version, with the
schema (see :mod:`.manifest`). Next to the data lies a key index: per folder, the
distinct values of the column that finds a row's month. A run:

1. INC1 - bound = max(order_date in target) - lookback days, or 1900-01-01 when
   the target is empty (cold start degrades to a full load). One aggregate job;
   the bound comes back to the driver as a literal so it prunes the source scan.
2. builds the changes (source rows at or after the bound),
3. INC3 - refuses duplicate keys in the changes (or, opt-in, keeps one row per
   key by a total order over all columns),
4. INC2 - finds the affected months: those of the incoming rows and those whose
   index holds an incoming key (a key whose date moved leaves its old month); no
   data file is read for that, so it does not matter how keys and dates relate,
5. writes exactly those months anew: target rows there minus incoming keys, plus
   the incoming rows (INC5: new columns are appended, NULL for old rows; a
   column of another type is cast to the stored one, widened on request, or
   refused), into folders of its own, and commits them with one rename. A month
   that the merge empties is not in the new version.

A crash before the commit leaves the old version, one after it the new one; the
next writer removes folders that no version names. Months not affected are
neither read nor written. ``retain`` older versions stay readable for readers
that are still on them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from ..functions.ordered import pick_first
from ..plans.joins import join_small
from ..session import Staged, filesystem, remove
from .manifest import Manifests, children

COLD_START = dt.date(1900, 1, 1)  # fixed value: bound used when the target is empty
LOOKBACK_DAYS = 3                  # fixed value: the line fact's lookback
PARTITION_COL = "order_month"
COMMIT_COL = "commit"
INDEX = "_keys"  # next to the data, hidden from readers of the folder
MAX_SUSPECTS = 1000        # equal digests looked up by value; beyond, all keys are counted
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a date


class DuplicateKeyError(ValueError):
    pass


@dataclass
class MergeResult:
    bound: dt.date | None
    incoming_rows: int
    partitions_rewritten: list
    partitions_removed: list


def _old(path: str) -> str:
    return f"{path.rstrip('/')}.__old"


def _recover(spark: SparkSession, path: str) -> None:
    """Put the previous table back if a swap ended between its two renames."""
    cls, fs = filesystem(spark, path)
    if not fs.exists(cls(path)) and fs.exists(cls(_old(path))):
        fs.rename(cls(_old(path)), cls(path))


@dataclass
class Version:
    """A committed state of a table: the commits whose folders hold each month."""

    number: int
    schema: StructType  # with the month, without the commit
    months: dict[str, list[str]]  # folder name of the month -> commits
    index_on: str | None

    @staticmethod
    def load(spark: SparkSession, path: str) -> Version | None:
        _recover(spark, path)
        number, state = Manifests(spark, path).current()
        return state and Version(number, StructType.fromJson(state["schema"]), state["months"], state["index_on"])

    def folders(self, months=None) -> list[str]:
        return [f"{PARTITION_COL}={m}/{COMMIT_COL}={c}" for m in (self.months if months is None else months) for c in self.months[m]]


def table_exists(spark: SparkSession, path: str) -> bool:
    """A committed table, with or without rows."""
    return Version.load(spark, path) is not None


def _read(spark: SparkSession, base: str, folders: list[str], schema: StructType) -> DataFrame:
    schema = StructType([*schema, StructField(COMMIT_COL, StringType())])
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).drop(COMMIT_COL)


def read_table(spark: SparkSession, path: str, keep_partition_col: bool = False) -> DataFrame | None:
    """Read the newest version; None when it holds no rows (an empty target)."""
    path, version = path.rstrip("/"), Version.load(spark, path)
    if version is None or not version.months:
        return None
    df = _read(spark, path, version.folders(), version.schema)
    return df if keep_partition_col else df.drop(PARTITION_COL)


def newest_partition(spark: SparkSession, path: str) -> dt.date | None:
    """The newest month, from the manifest (no data read)."""
    version = Version.load(spark, path)
    months = [dt.date.fromisoformat(m) for m in (version.months if version else {}) if m != NO_PARTITION]
    return max(months, default=None)


def incremental_bound(target: DataFrame | None, date_col: str = "order_date",
                      lookback_days: int = LOOKBACK_DAYS) -> dt.date:
    """INC1 / J13 / AGG8: max(date) - lookback, or the cold-start date."""
    if target is None:
        return COLD_START
    mx = target.agg(F.max(date_col)).first()[0]
    if mx is None:
        return COLD_START
    return mx - dt.timedelta(days=lookback_days)


def dedupe_by_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """INC3 opt-in: one row per key, the first by a total order over all columns
    (deterministic; identical duplicates make the choice irrelevant). An
    aggregate, so a heavily repeated key is reduced map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    return pick_first(df, keys, [])


#: Buckets of keys that are counted, and how far above the mean the largest may lie.
EVEN_BUCKETS, UNEVEN = 4096, 4.0


def evenly_keyed(df: DataFrame, key: str) -> bool:
    """Whether rows dealt by ``key`` make tasks of about one size: counted over hash
    buckets (only the key is read, a row per bucket and task is shuffled)."""
    sizes = df.groupBy(F.pmod(F.xxhash64(key), F.lit(EVEN_BUCKETS)).alias("b")).count()
    most, rows = sizes.agg(F.max("count"), F.sum("count")).first()
    return not rows or most <= UNEVEN * max(1.0, rows / EVEN_BUCKETS)


def dedupe_for_join(df: DataFrame, key: list[str], on: str) -> DataFrame:
    """:func:`dedupe_by_key` for rows that are joined on ``on``, one of the key's
    columns, afterwards. Rows are dealt by ``on`` at once, so that the join finds
    them in place. Where that would be uneven (a value with many rows), duplicates
    are first reduced map-side, and the join shuffles what is left."""
    return dedupe_by_key(df.repartition(on) if evenly_keyed(df, on) else df, key)


def assert_unique(df: DataFrame, key: str) -> None:
    """Digests are counted first; keys themselves only where a digest comes twice."""
    keyed = df.select(key, F.xxhash64(key).alias("_digest"))
    twice = keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("_digest")
    some = twice.limit(MAX_SUSPECTS + 1).collect()
    if not some:
        return
    if len(some) <= MAX_SUSPECTS:
        df = keyed.filter(F.col("_digest").isin([r[0] for r in some]))
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"merge input has duplicate {key} values, e.g. {dup[0][key]!r}")


def _with_partition(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.trunc(F.col(date_col), "month"))


def _rebalanced(df: DataFrame) -> DataFrame:
    """Shuffle rows to their partition value before a partitioned write. AQE
    coalesces small partitions (few files per month) and splits oversized ones
    (a hot month is written by many tasks)."""
    return df.hint("rebalance", PARTITION_COL)


def _write(spark: SparkSession, path: str, rows: DataFrame, commit: str,
           finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> dict[str, list[str]]:
    """Write ``rows`` into folders of their own; returns the months that have any.
    ``finish`` adds columns that follow from others, once the rows are shuffled."""
    finish(_rebalanced(rows)).withColumn(COMMIT_COL, F.lit(commit)).write.mode("append").partitionBy(PARTITION_COL, COMMIT_COL).parquet(path)
    found = children(spark, f"{path}/{PARTITION_COL}=*/{COMMIT_COL}={commit}")
    return {f.split(f"/{PARTITION_COL}=")[-1].split("/")[0]: [commit] for f in sorted(found)}


def _write_index(spark: SparkSession, path: str, version: Version, folders: list[str], on: str) -> None:
    """The distinct values of ``on`` in each of ``folders``; only that column is read."""
    schema = StructType([version.schema[on], version.schema[PARTITION_COL], StructField(COMMIT_COL, StringType())])
    keys = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders]).distinct()
    _rebalanced(keys).sortWithinPartitions(PARTITION_COL, COMMIT_COL, on) \
        .write.mode("append").partitionBy(PARTITION_COL, COMMIT_COL).parquet(f"{path}/{INDEX}/{on}")


def _indexed(spark: SparkSession, path: str, version: Version, on: str) -> DataFrame:
    """(value of ``on``, month) of all rows, from the index; built here for a
    column that a version has no index on."""
    base = f"{path}/{INDEX}/{on}"
    if version.index_on != on:
        remove(spark, base)
        _write_index(spark, path, version, version.folders(), on)
    return _read(spark, base, version.folders(), StructType([version.schema[on], version.schema[PARTITION_COL]]))


def _commit(spark: SparkSession, path: str, base: int, version: Version) -> None:
    Manifests(spark, path).commit(base, {"schema": json.loads(version.schema.json()), "months": version.months,
                                         "index_on": version.index_on})


def _clean(spark: SparkSession, path: str, retain: int) -> None:
    """Remove folders that no remaining version names."""
    kept = Manifests(spark, path).forget(retain)
    live = {(m, c) for state in kept for m, commits in state["months"].items() for c in commits}
    used = {state["index_on"] for state in kept}
    for base in (path, *children(spark, f"{path}/{INDEX}/*")):
        if base != path and base.rsplit("/", 1)[1] not in used:
            remove(spark, base)
            continue
        for month in children(spark, f"{base}/{PARTITION_COL}=*"):
            name = month.rsplit("=", 1)[1]
            inside = children(spark, f"{month}/*")
            gone = [f for f in inside if (name, f.rsplit("=", 1)[-1]) not in live]
            for f in [month] if len(gone) == len(inside) else gone:
                remove(spark, f)


def _drop_commit(spark: SparkSession, path: str, commit: str) -> None:
    for f in children(spark, f"{path}/{PARTITION_COL}=*/{COMMIT_COL}={commit}"):
        remove(spark, f)


def full_refresh(spark: SparkSession, path: str, rows: DataFrame, key: str, date_col: str = "order_date",
                 dedupe: bool = False, locate_by: str | None = None, retain: int = 0,
                 finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> MergeResult:
    """INC4: rebuild the whole table from all source rows.

    The rows are computed once, written to folders of a new commit, checked for
    duplicate keys there (reading only the key column), indexed, and only then
    made the table's version. A failed check or a crash leaves the table as it
    was. ``locate_by``: see :func:`merge_by_key`; ``finish``: see :func:`_write`."""
    path = path.rstrip("/")
    rows = _with_partition(dedupe_by_key(rows, key) if dedupe else rows, date_col)
    _recover(spark, path)
    base, commit = Manifests(spark, path).current()[0], uuid.uuid4().hex
    version = Version(base + 1, finish(rows).schema, _write(spark, path, rows, commit, finish), locate_by or key)
    if version.months:
        if not dedupe:
            try:
                assert_unique(_read(spark, path, version.folders(), version.schema).select(key), key)
            except DuplicateKeyError:
                _drop_commit(spark, path, commit)
                raise
        _write_index(spark, path, version, version.folders(), version.index_on)
    _commit(spark, path, base, version)
    _clean(spark, path, retain)
    return MergeResult(None, -1, ["*"], [])


def conform_to(changes: DataFrame, stored: StructType) -> DataFrame:
    """Cast columns the table has to its types; new columns stay."""
    types = {f.name: f.dataType for f in stored}
    return changes.select(*[F.col(f.name).try_cast(types[f.name]).alias(f.name)
                            if f.name in types and types[f.name] != f.dataType else F.col(f.name) for f in changes.schema])


def _refuse_lossy(changes: DataFrame, stored: StructType) -> None:
    types = {f.name: f.dataType for f in stored}
    lost = [F.count_if(F.col(f.name).isNotNull() & (F.col(f.name).try_cast(types[f.name]).isNull()
                       | (F.col(f.name).try_cast(types[f.name]).try_cast(f.dataType) != F.col(f.name)))).alias(f.name)
            for f in changes.schema if f.name in types and types[f.name] != f.dataType]
    if lost:
        bad = {c: n for c, n in changes.agg(*lost).first().asDict().items() if n}
        if bad:
            raise ValueError(f"values that the stored type cannot hold: {bad}")


def _wider(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is one of ``new`` and files of ``old`` read as such."""
    whole = (ByteType, ShortType, IntegerType, LongType)
    if isinstance(old, whole) and isinstance(new, whole):
        return whole.index(type(old)) < whole.index(type(new)) and isinstance(new, (IntegerType, LongType))
    if isinstance(old, FloatType):
        return isinstance(new, DoubleType)
    return (isinstance(old, DecimalType) and isinstance(new, DecimalType) and old != new
            and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale)


def widened(stored: StructType, incoming: StructType) -> StructType:
    """``stored`` with the types of ``incoming`` where these are wider."""
    new = {f.name: f.dataType for f in incoming}
    return StructType([StructField(f.name, new[f.name] if f.name in new and _wider(f.dataType, new[f.name]) else f.dataType, f.nullable)
                       for f in stored])


def merge_by_key(spark: SparkSession, path: str, changes: DataFrame, key: str, date_col: str = "order_date",
                 dedupe: bool = False, bound: dt.date | None = None, locate_by: str | None = None,
                 widen: bool = False, retain: int = 0) -> MergeResult:
    """INC2: upsert ``changes`` into the table at ``path`` by ``key``.

    ``locate_by`` names a coarser column whose rows always share one month (for
    the line fact: ``order_key``, since every line of an order lives in the order's
    month); the key index is kept on it. The index is joined with the incoming
    values, and only the months found are read; the rewrite matches on ``key``.
    The number of incoming rows is known, and bounds the broadcasts. ``widen``
    takes over a wider type of an incoming column (int to bigint, float to double,
    a longer decimal): older files stay as they are and are read as that type."""
    path, version = path.rstrip("/"), Version.load(spark, path)
    if version is None or not version.months:
        return full_refresh(spark, path, changes, key, date_col, dedupe, locate_by, retain)
    changes = dedupe_by_key(changes, key) if dedupe else changes
    stored = widened(version.schema, changes.schema) if widen else version.schema
    probe, commit = locate_by or key, uuid.uuid4().hex
    # the changes are computed once; checks, month discovery and rewrite read the copy
    with Staged(changes) as raw:
        _refuse_lossy(raw, stored)
        incoming = _with_partition(conform_to(raw, stored), date_col)
        n = incoming.count()
        if not dedupe:
            assert_unique(incoming, key)
        index = _indexed(spark, path, version, probe)
        wanted = incoming.select(F.col(probe).try_cast(version.schema[probe].dataType).alias(probe)).distinct()
        moved_from = join_small(index, wanted, probe, "left_semi", rows=n).select(PARTITION_COL)
        # the distinct partition values are metadata-sized (one per month touched)
        parts = [r[0] for r in incoming.select(PARTITION_COL).union(moved_from).distinct().collect()]
        if not parts:
            return MergeResult(bound, n, [], [])
        names = {NO_PARTITION if p is None else p.isoformat(): p for p in parts}
        rewritten = incoming
        if here := version.folders([m for m in names if m in version.months]):
            kept = join_small(_read(spark, path, here, stored), incoming.select(key), key, "left_anti", rows=n)
            rewritten = kept.unionByName(incoming, allowMissingColumns=True)
        new = _write(spark, path, rewritten, commit)
        months = {m: c for m, c in version.months.items() if m not in names} | new
        after = Version(version.number + 1, StructType([*stored, *(f for f in rewritten.schema if f.name not in stored.names)]),
                        months, probe)
        if new:
            _write_index(spark, path, after, after.folders(new), probe)
    _commit(spark, path, version.number, after)
    _clean(spark, path, retain)
    removed = [p for m, p in names.items() if m not in new]
    order = lambda p: (p is None, p or dt.date.min)
    return MergeResult(bound, n, sorted(parts, key=order), sorted(removed, key=order))


def load_incremental(spark: SparkSession, path: str, build_changes, key: str = "order_item_key",
                     date_col: str = "order_date", lookback_days: int = LOOKBACK_DAYS,
                     refresh: bool = False, dedupe: bool = False,
                     locate_by: str | None = "order_key", retain: int = 0) -> MergeResult:
    """One incremental run of a fact: ``build_changes(since: date | None)`` returns
    the model rows at or after ``since`` (all rows when None)."""
    if refresh or not table_exists(spark, path):
        rows = build_changes(None)
        return full_refresh(spark, path, rows, key, date_col, dedupe, locate_by if locate_by in rows.columns else None, retain)
    target = read_table(spark, path, keep_partition_col=True)
    newest = newest_partition(spark, path)
    if target is not None and newest is not None:
        # the max date lives in the newest month: partition pruning reads only that month
        target = target.filter(F.col(PARTITION_COL) == F.lit(newest))
    bound = incremental_bound(target, date_col, lookback_days)
    changes = build_changes(bound)
    res = merge_by_key(spark, path, changes, key, date_col, dedupe, bound,
                       locate_by if locate_by in changes.columns else None, retain=retain)
    res.bound = bound
    return res
