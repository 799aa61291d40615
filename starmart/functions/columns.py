"""Column builders shared by every layer. All are native Catalyst expressions
(no Python UDFs), so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

MONEY = "decimal(12,2)"
RATE = "decimal(5,4)"
MONEY_SUM = "decimal(38,2)"
TAX_SUM = "decimal(38,6)"
NULL_SENTINEL = "_null_"
KEY_SEPARATOR = "-"
OPEN_END = "9999-12-31 00:00:00"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnOrName) -> Column:
    """FN1: cast to number(12,2)."""
    return _c(c).cast(MONEY)


def rate(c: ColumnOrName) -> Column:
    """FN1: cast to number(5,4)."""
    return _c(c).cast(RATE)


def as_date(c: ColumnOrName) -> Column:
    """FN2."""
    return _c(c).cast("date")


def net_revenue(price: ColumnOrName, discount: ColumnOrName) -> Column:
    """PRJ3: price * (1 - discount) to cents. Inputs are cast first so the product
    is exact decimal arithmetic, whatever the raw storage type."""
    return (money(price) * (F.lit(1) - rate(discount))).cast(MONEY)


def discount_amount(price: ColumnOrName, discount: ColumnOrName) -> Column:
    """PRJ4."""
    return (money(price) * rate(discount)).cast(MONEY)


def surrogate_key(*cols: ColumnOrName) -> Column:
    """FN19: md5 over the key parts joined by '-'; NULL parts become a sentinel so
    that NULL and '' hash differently."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """FN14: num / nullif(den, 0) as DOUBLE (NULL on a zero or NULL denominator;
    ``try_divide`` never raises under ANSI mode)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    return ratio(num, den) * F.lit(100.0)


def flag_int(cond: Column) -> Column:
    """FN16: case when cond then 1 else 0 end."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def mean(c: ColumnOrName) -> Column:
    """AGG12 as exact sum over count, then one DOUBLE division (engine-independent bits)."""
    return F.try_divide(F.sum(_c(c)).cast("double"), F.count(_c(c)).cast("double"))


def day_of_week_sunday0(c: ColumnOrName) -> Column:
    """FN12: Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_c(c)) - F.lit(1)


GRAINS = ("day", "week", "month", "quarter", "year")


def time_grain(c: ColumnOrName, grain: str) -> Column:
    """FN9 / SEM5: truncate a date to a grain (weeks start on Monday)."""
    grain = grain.lower()
    if grain not in GRAINS:
        raise ValueError(f"unknown time grain {grain!r}; expected one of {GRAINS}")
    if grain == "day":
        return _c(c).cast("date")
    return F.date_trunc(grain, _c(c)).cast("date")


def open_end_ts() -> Column:
    """FN5: the open-ended validity bound 9999-12-31 (timestamp without time zone)."""
    return F.lit(OPEN_END).cast("timestamp_ntz")
