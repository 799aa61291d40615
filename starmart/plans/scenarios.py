"""Stateful scenarios over the driver tables (for registered queries and tests).

SCD2: three snapshot runs of a current-state customer feed, all derived from
the whole ``customer`` table by fixed rules (no sampling):

* run A (1995-01-01): every customer as staged;
* run B (1998-01-01): customers with a negative balance are deleted; nations
  0-4 move to the next market segment; balances above 9000 grow by 100.00;
  nations 10-12 gain a phone (NULL -> value); customers of nation 24 in
  AUTOMOBILE get a twin under key + 10^12 (new keys);
* run C (2000-01-01): everyone is back to run A (deleted keys reappear, changes
  revert, the twins are deleted).

Incremental merge: the fact is first loaded with orders up to 90 days before
the last order date; a second run restates every line's quantity (+1) and
brings all orders; with a 3-day lookback only rows at or after
(last loaded order date - 3 days) take the restatement.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import CUSTOMER_TRACKED

# The scenario's run timestamps and rules.
RUN_TS = ("1995-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
TWIN_OFFSET = 10 ** 12
FEED_COLS = ("customer_key",) + CUSTOMER_TRACKED


def feed_a(customers: DataFrame) -> DataFrame:
    return customers.select(*FEED_COLS)


def _next_segment(c) -> F.Column:
    expr = F.col(c)
    for i, s in enumerate(SEGMENTS):
        expr = F.when(F.col(c) == s, F.lit(SEGMENTS[(i + 1) % len(SEGMENTS)])) if i == 0 else \
            expr.when(F.col(c) == s, F.lit(SEGMENTS[(i + 1) % len(SEGMENTS)]))
    return expr.otherwise(F.col(c))


def feed_b(customers: DataFrame) -> DataFrame:
    a = feed_a(customers).filter(~(F.col("account_balance") < 0))
    changed = a.select(
        "customer_key", "customer_name",
        F.when(F.col("nation_key") < 5, _next_segment("market_segment")).otherwise(F.col("market_segment"))
        .alias("market_segment"),
        F.when(F.col("account_balance") > 9000, (F.col("account_balance") + F.lit(100)).cast("decimal(12,2)"))
        .otherwise(F.col("account_balance")).alias("account_balance"),
        F.when(F.col("nation_key").between(10, 12), F.concat(F.lit("PH-"), F.col("nation_key").cast("string")))
        .otherwise(F.col("phone")).alias("phone"),
        "address", "nation_key")
    twins = a.filter((F.col("nation_key") == 24) & (F.col("market_segment") == "AUTOMOBILE")) \
        .withColumn("customer_key", F.col("customer_key") + F.lit(TWIN_OFFSET))
    return changed.unionByName(twins)


def feed_c(customers: DataFrame) -> DataFrame:
    return feed_a(customers)


def feeds(customers: DataFrame) -> list[tuple[str, DataFrame]]:
    return list(zip(RUN_TS, (feed_a(customers), feed_b(customers), feed_c(customers))))


def dated_feed(customers: DataFrame) -> DataFrame:
    """The same three states as one dated change feed (SCD5 input)."""
    parts = [f.withColumn("effective_date", F.lit(ts[:10]).cast("date")) for ts, f in feeds(customers)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- SQL equivalents for the oracle ----------------------------------------

_SEG_NEXT = "CASE market_segment " + " ".join(
    f"WHEN '{s}' THEN '{SEGMENTS[(i + 1) % len(SEGMENTS)]}'" for i, s in enumerate(SEGMENTS)) + \
    " ELSE market_segment END"

FEED_A_SQL = "SELECT customer_key, customer_name, market_segment, account_balance, phone, address, nation_key " \
             "FROM stg_customers"

FEED_B_SQL = f"""
SELECT customer_key, customer_name,
       CASE WHEN nation_key < 5 THEN {_SEG_NEXT} ELSE market_segment END AS market_segment,
       CASE WHEN account_balance > 9000 THEN CAST(account_balance + 100 AS DECIMAL(12,2))
            ELSE account_balance END AS account_balance,
       CASE WHEN nation_key BETWEEN 10 AND 12 THEN 'PH-' || CAST(nation_key AS VARCHAR) ELSE phone END AS phone,
       address, nation_key
FROM ({FEED_A_SQL}) WHERE NOT (account_balance < 0)
UNION ALL
SELECT customer_key + {TWIN_OFFSET}, customer_name, market_segment, account_balance, phone, address, nation_key
FROM ({FEED_A_SQL}) WHERE NOT (account_balance < 0) AND nation_key = 24 AND market_segment = 'AUTOMOBILE'"""

FEEDS_SQL = f"""
SELECT 1 AS run, TIMESTAMP '{RUN_TS[0]}' AS ts, * FROM ({FEED_A_SQL})
UNION ALL SELECT 2, TIMESTAMP '{RUN_TS[1]}', * FROM ({FEED_B_SQL})
UNION ALL SELECT 3, TIMESTAMP '{RUN_TS[2]}', * FROM ({FEED_A_SQL})"""

_ATTRS = CUSTOMER_TRACKED
_DIFF = " OR ".join(f"g.{c} IS DISTINCT FROM g.p_{c}" for c in _ATTRS)

# Gaps-and-islands form of the three snapshot runs: a version starts where a
# key is present and was absent or different in the previous run; it ends at
# the key's next event (absence or a new start).
SCD2_STATE_SQL = f"""
WITH feeds AS ({FEEDS_SQL}),
runs AS (SELECT DISTINCT run, ts FROM feeds),
keys AS (SELECT DISTINCT customer_key FROM feeds),
grid AS (SELECT k.customer_key, r.run, r.ts FROM keys k CROSS JOIN runs r),
g0 AS (SELECT grid.customer_key, grid.run, grid.ts, f.run IS NOT NULL AS present,
              {", ".join(f"f.{c}" for c in _ATTRS)}
       FROM grid LEFT JOIN feeds f ON f.customer_key = grid.customer_key AND f.run = grid.run),
g AS (SELECT *, lag(present) OVER (PARTITION BY customer_key ORDER BY run) AS p_present,
             {", ".join(f"lag({c}) OVER (PARTITION BY customer_key ORDER BY run) AS p_{c}" for c in _ATTRS)}
      FROM g0),
ev AS (SELECT g.*, (g.present AND (g.p_present IS NOT TRUE OR {_DIFF})) AS is_start FROM g g),
ev2 AS (SELECT *, lead(ts) OVER (PARTITION BY customer_key ORDER BY run) AS next_ts
        FROM ev WHERE is_start OR NOT present)
SELECT customer_key, {", ".join(_ATTRS)},
       md5(concat_ws('-', coalesce(CAST(customer_key AS VARCHAR), '_null_'),
                          coalesce(CAST(ts AS VARCHAR), '_null_'))) AS version_key,
       ts AS updated_at, ts AS valid_from, next_ts AS valid_to
FROM ev2 WHERE is_start"""

HISTORY_SQL = f"""
SELECT version_key AS customer_history_key, customer_key, {", ".join(_ATTRS)}, valid_from, valid_to,
       coalesce(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to_or_max,
       coalesce(valid_to IS NULL, false) AS is_current
FROM ({SCD2_STATE_SQL})"""


def merge_cut(orders: DataFrame) -> dt.date:
    """Initial-load cut: 90 days before the last order date."""
    return orders.agg(F.max("order_date")).first()[0] - dt.timedelta(days=90)
