"""Calendar / time spine (GEN1, GEN2) and densification (J11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import day_of_week_sunday0, time_grain

# The spine covers 1990-01-01 up to (not including) 2031-01-01.
SPINE_START = dt.date(1990, 1, 1)
SPINE_END_EXCLUSIVE = dt.date(2031, 1, 1)


def _d(x: dt.date | str) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(x)


def date_spine(spark: SparkSession, start: dt.date | str = SPINE_START,
               end_exclusive: dt.date | str = SPINE_END_EXCLUSIVE) -> DataFrame:
    """GEN1: one row per day. Generated with ``spark.range`` so the rows are
    produced in parallel partitions (no single exploded array)."""
    start, end = _d(start), _d(end_exclusive)
    days = (end - start).days
    return spark.range(0, max(days, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))


def calendar_attributes(day: Column) -> list[Column]:
    dow = day_of_week_sunday0(day)
    return [
        day.alias("date_day"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day_of_month"),
        dow.alias("day_of_week"),
        time_grain(day, "week").alias("week_start"),
        time_grain(day, "month").alias("month_start"),
        time_grain(day, "quarter").alias("quarter_start"),
        time_grain(day, "year").alias("year_start"),
        dow.isin(0, 6).alias("is_weekend"),
    ]


def calendar(spark: SparkSession, start: dt.date | str = SPINE_START,
             end_exclusive: dt.date | str = SPINE_END_EXCLUSIVE) -> DataFrame:
    """GEN2: the 12-column calendar dimension."""
    return date_spine(spark, start, end_exclusive).select(*calendar_attributes(F.col("date_day")))


def densify(agg: DataFrame, cal: DataFrame, date_col: str, fill: dict[str, object],
            start: dt.date | str | None = None, end_inclusive: dt.date | str | None = None,
            keep: list[str] | None = None, within: bool = False) -> DataFrame:
    """J11: calendar left join a per-day aggregate, filling the measure columns.
    ``keep`` lists calendar columns to carry (default: ``date_day`` only).
    ``within`` keeps the days between the aggregate's first and last: a window over
    the joined days, as many as the calendar and the aggregate have.

    Both sides are at day grain (bounded by the calendar length), so the join
    is cheap whatever the fact size; the heavy work is the aggregate before it.
    """
    keep = keep or ["date_day"]
    days = cal.select(*keep)
    if start is not None:
        days = days.filter(F.col("date_day") >= F.lit(_d(start)))
    if end_inclusive is not None:
        days = days.filter(F.col("date_day") <= F.lit(_d(end_inclusive)))
    joined = agg.withColumnRenamed(date_col, "date_day").withColumn("_there", F.lit(True)) \
        .join(days.withColumn("_day", F.lit(True)), "date_day", "full" if within else "right")
    if within:  # the aggregate is read once: its ends come from the joined days, a row each
        whole, there = Window.partitionBy(), F.when(F.col("_there"), F.col("date_day"))
        joined = joined.withColumns({"_lo": F.min(there).over(whole), "_hi": F.max(there).over(whole)}) \
            .filter(F.col("_day") & F.col("date_day").between(F.col("_lo"), F.col("_hi")))
    return joined.select(*keep, *[F.coalesce(F.col(c), F.lit(v).cast(agg.schema[c].dataType)).alias(c)
                                  for c, v in fill.items()])
