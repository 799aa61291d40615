"""Per-key ordered operations that stay distributed when one key is hot.

A window ``partitionBy(key).orderBy(t)`` sends every row of a key to one task;
if one key holds a third of the rows, so does one task. Here the ordering is
done in two levels instead:

1. rows are bucketed by (key, time bucket) - e.g. the month of ``t`` - and the
   window runs inside each bucket (bounded by the bucket width: with at most
   one row per key and day, a month bucket holds at most 31 rows);
2. a one-row-per-bucket summary (first time, last row's values, row count;
   built with aggregates, i.e. partial aggregation map-side) gets a window over
   the key, which is bounded by the number of buckets of a key;
3. the summary is joined back on (key, bucket) to carry values across bucket
   edges and to turn the in-bucket row number into a per-key row number.

The result equals the plain window's ``lag``/``lead``/``row_number`` whenever
``t`` is unique within a key (callers dedupe first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (then by every other column,
    so the pick is total). An aggregate, not a window: each map task keeps one
    candidate per key before the shuffle, so a hot key costs one row per task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                      *[F.col(c).alias(f"_v_{c}") for c in rest])
    best = df.groupBy(*keys).agg(F.min(ranked).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._v_{c}").alias(c) for c in rest]).select(*df.columns)


def _bucket(t: Column, grain: str) -> Column:
    return F.date_trunc(grain, t)


def ordered_neighbors(df: DataFrame, key: str, t: str, lag_cols: Sequence[str] = (), lead_t: bool = False,
                      row_number: bool = False, grain: str = "month") -> DataFrame:
    """Add ``_prev_<c>`` (lag of c), ``_next_<t>`` (lead of t) and ``_rn`` (row
    number from 1) over rows of ``key`` ordered by ``t``, in the two-level form.
    ``t`` must be unique within a key."""
    b = "_bucket"
    x = df.withColumn(b, _bucket(F.col(t), grain))
    w_in = Window.partitionBy(key, b).orderBy(F.col(t))
    inner = [F.lag(c).over(w_in).alias(f"_in_prev_{c}") for c in lag_cols]
    if lead_t:
        inner.append(F.lead(t).over(w_in).alias("_in_next"))
    inner.append(F.row_number().over(w_in).alias("_in_rn"))
    x = x.select("*", *inner)

    summary = x.groupBy(key, b).agg(
        F.min(t).alias("_first_t"),
        F.max_by(F.struct(*[F.col(c).alias(c) for c in lag_cols]) if lag_cols else F.lit(None), F.col(t))
        .alias("_last_vals"),
        F.count(F.lit(1)).alias("_n"))
    w_b = Window.partitionBy(key).orderBy(b)
    summary = summary.select(
        key, b,
        F.lag("_last_vals").over(w_b).alias("_prev_bucket_vals"),
        F.lead("_first_t").over(w_b).alias("_next_bucket_t"),
        (F.sum("_n").over(w_b.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n"))
        .alias("_before"))
    y = x.join(summary, [key, b], "left")
    first_in_bucket = F.col("_in_rn") == F.lit(1)
    out = [F.col(c) for c in df.columns]
    for c in lag_cols:
        out.append(F.when(first_in_bucket, F.col(f"_prev_bucket_vals.{c}")).otherwise(F.col(f"_in_prev_{c}"))
                   .alias(f"_prev_{c}"))
    if lead_t:
        out.append(F.coalesce(F.col("_in_next"), F.col("_next_bucket_t")).alias(f"_next_{t}"))
    if row_number:
        out.append((F.col("_before") + F.col("_in_rn")).cast("bigint").alias("_rn"))
    return y.select(*out)


def running_max(df: DataFrame, key: str, t: str, value: str, grain: str = "month") -> DataFrame:
    """Add ``_max_<value>``: the largest ``value`` of the key's rows up to ``t``, in
    the two-level form."""
    b = "_bucket"
    x = df.withColumn(b, _bucket(F.col(t), grain))
    summary = x.groupBy(key, b).agg(F.max(value).alias("_top")).withColumn(
        "_earlier", F.max("_top").over(Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.max(value).over(Window.partitionBy(key, b).orderBy(t).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return x.withColumn("_inside", inside).join(summary.select(key, b, "_earlier"), [key, b], "left") \
        .select(*[F.col(c) for c in df.columns], F.coalesce("_inside", "_earlier").alias(f"_max_{value}"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union many same-schema frames pairwise (a balanced tree), so each union is
    analyzed over a plan of logarithmic rather than linear depth."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]
