"""Size-checked joins.

``broadcast()`` is only safe for a side whose size is bounded. The bound is
proven in one of three ways, cheapest first:

* the caller knows the number of rows (it counted a written table): rows times
  the width of a row;
* Catalyst's size estimate of the optimized plan, charged for decoding (file
  scans are estimated by their compressed size);
* that estimate multiplies the sides of a join, so a 10-row dimension looked up
  in 25 nations passes for gigabytes. If the tables below the plan are together
  under the bound, the rows of the plan are counted - a job over small inputs
  only - and rows times width decide.

Above the bound the join is left to a shuffle join, which AQE may still demote
to a broadcast at runtime from measured shuffle sizes, and whose skewed
partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
CHECKED_MIN_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for ``df`` (no job runs). None if unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # e.g. Spark Connect: no JVM handle; let AQE decide
        return None
    # py4j hands a Scala BigInt back as a Python int; keep a string fallback
    return size if isinstance(size, int) else int(str(size.toString()))


def broadcast_limit(df: DataFrame, max_bytes: int | None = None) -> int:
    """The bound: explicit, else the session's auto-broadcast threshold kept within
    [10 MB, 64 MB]. A cluster that switches automatic broadcasts off still gets
    the explicit, size-checked ones (25 nations are never worth a shuffle)."""
    if max_bytes is not None:
        return max_bytes
    try:
        conf = int(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "-1").rstrip("bB"))
    except ValueError:
        conf = -1
    return min(max(conf, CHECKED_MIN_BYTES), DEFAULT_MAX_BROADCAST_BYTES)


# For file scans the estimate is the on-disk (compressed) size; decoded rows are
# typically 2-5x larger, so the check charges 4x before comparing with the bound.
DECODED_EXPANSION = 4


# What a value takes in a decoded row, by type (bytes); a row has some besides.
VALUE_BYTES = {"string": 64, "binary": 64}
ROW_BYTES = 32


def row_bytes(df: DataFrame) -> int:
    """Width a row of ``df`` is charged with."""
    return ROW_BYTES + sum(VALUE_BYTES.get(t, 16) for _, t in df.dtypes)


def leaf_bytes(df: DataFrame) -> int | None:
    """Estimated size of all tables the plan reads, together. None if unavailable."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except Exception:  # no JVM handle
        return None


#: On-disk bytes of the tables read per task that holds a hash table over its rows, and
#: those up to which the session's own partitions do.
TASK_BYTES, WHOLE_BYTES = 8 * 1024 * 1024, 32 * 1024 * 1024


def dealt(df: DataFrame, on: str) -> DataFrame:
    """``df`` dealt by ``on`` to as many tasks as the size of the tables it reads calls
    for, for a join on that column with an aggregate of nearly as many groups as rows in
    the same tasks. Left to itself, adaptive execution merges partitions up to 64 MB of
    compressed shuffle, which unpack to over a gigabyte of such groups in a task. A small
    or unknown size leaves ``df`` as it is."""
    size = leaf_bytes(df)
    if size is None or not WHOLE_BYTES < size < 1 << 50:  # an unknown size passes for exabytes
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-size // TASK_BYTES)), on)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None, rows: int | None = None) -> bool:
    """Whether ``df`` is proven to be under the bound; ``rows`` is its number of
    rows (or more), where the caller has counted them."""
    limit = broadcast_limit(df, max_bytes)
    if rows is not None:
        return rows * row_bytes(df) <= limit
    est = estimated_bytes(df)
    if est is not None and est * DECODED_EXPANSION <= limit:
        return True
    leaves = leaf_bytes(df)
    if leaves is None or leaves * DECODED_EXPANSION > limit:
        return False
    most = limit // row_bytes(df)
    return df.limit(most + 1).count() <= most


def join_small(large: DataFrame, small: DataFrame, on: str | list[str] | Column, how: str = "inner",
               max_bytes: int | None = None, rows: int | None = None) -> DataFrame:
    """Join a fact-side frame to a dimension-side frame, broadcasting the dimension
    only when its size is proven to be under the bound."""
    if how in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti") and \
            fits_broadcast(small, max_bytes, rows):
        small = F.broadcast(small)
    return large.join(small, on, how)


#: Bits per key of :func:`maybe_among`, and bits up to which they are broadcast.
KEY_BITS, MAX_KEY_BITS = 8, 1 << 26


def maybe_among(large: DataFrame, keys: DataFrame, on: str, rows: int) -> DataFrame:
    """Rows of ``large`` that a join on ``on`` with ``keys`` (``rows`` of them, counted)
    may need, read without a shuffle of ``large``: exactly these where the keys fit a
    broadcast, else those whose key's hash has its bit set (about one in ten of the
    others pass), else all. The join itself is left to the caller."""
    keys = keys.select(on)
    if fits_broadcast(keys, rows=rows):
        return large.join(F.broadcast(keys), on, "left_semi")
    bits = 1 << (KEY_BITS * rows).bit_length()
    if bits > MAX_KEY_BITS:
        return large
    at = F.pmod(F.xxhash64(on), F.lit(bits))
    bit = (at % 64).cast("int")
    words = keys.groupBy(F.floor(at / 64).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    placed = large.withColumns({"_word": F.floor(at / 64), "_bit": bit})
    return placed.join(F.broadcast(words), "_word").filter(F.getbit("_bits", F.col("_bit")) == 1).select(*large.columns)
