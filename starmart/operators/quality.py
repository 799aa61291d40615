"""Data-quality checks (DQ1-DQ10) and a suite runner.

Every check is a function ``DataFrame(s) -> DataFrame`` of violating rows; it
passes at zero rows. The suite evaluates many checks and returns one summary
row per check (check_name, table_name, column_name, failing_rows, passed,
status). A check whose table was not given is listed as skipped, never left out:

* row-wise checks of one table (not_null, accepted_values, positive) are folded
  into a single scan of conditional counts, whatever their number;
* set checks (unique, unique_combination) are one ``groupBy`` each, with
  partial aggregation before the shuffle; a hot key only makes its pre-counted
  row larger;
* relationships are ``left_anti`` joins with the parent projected to its key
  (broadcast only when the parent's estimated size is under the bound); the
  suite first counts child rows per key, so only distinct keys are joined, and a
  parent too large to broadcast is looked up as bitmaps of its integer keys.

NULL handling (the checks return failing rows): NULL fails only ``not_null``;
``unique``, ``accepted_values`` and ``relationships`` ignore NULLs, and
``NULL <= 0`` is not true, so ``positive`` never fails a NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from dataclasses import field as dc_field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import union_all
from ..plans.joins import fits_broadcast, join_small

ROW_WISE = ("not_null", "accepted_values", "positive")


# ---------------------------------------------------------------------------
# Single checks, each returning violating rows
# ---------------------------------------------------------------------------

def check_unique(df: DataFrame, col: str) -> DataFrame:
    """DQ1: one row per duplicated value (NULLs ignored)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """DQ2."""
    return df.filter(F.col(col).isNull())


def _not_accepted(col: str, values: Sequence) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def check_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """DQ3: rows whose non-NULL value is outside ``values``."""
    return df.filter(_not_accepted(col, values))


def check_relationships(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """DQ4: child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(field).alias(col)).filter(F.col(col).isNotNull())
    return join_small(df.filter(F.col(col).isNotNull()), keys, col, "left_anti")


def key_blocks(parent: DataFrame, field: str) -> DataFrame:
    """The set of an integer column as bitmaps of 32,768 bits (``block``, ``bits``):
    a row where the column has up to 32,768 keys, so even billions of dense keys
    make a small table. Exact, so nothing needs a second look."""
    return parent.filter(F.col(field).isNotNull()).groupBy(F.bitmap_bucket_number(field).alias("block")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(field))).alias("bits"))


def without_parent(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows of ``child`` (distinct, non-null keys) whose key the parent lacks: an
    anti-join with the parent's keys if these are broadcast, else, for integer keys,
    a lookup in the parent's bitmaps, which are aggregated where the keys are read
    and are the same plan for all children of a parent."""
    keys = parent.select(F.col(field).alias(col))
    whole = all(dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") for df, c in ((child, col), (parent, field)))
    if not whole or fits_broadcast(keys):
        return join_small(child, keys, col, "left_anti")
    at = F.bitmap_bit_position(F.col(col))
    placed = child.withColumns({"block": F.bitmap_bucket_number(col), "_byte": F.floor(at / 8).cast("int"), "_bit": (at % 8).cast("int")})
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.col("_byte") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.coalesce(F.call_function("shiftright", byte, F.col("_bit")).bitwiseAND(F.lit(1)), F.lit(0)) == 1
    return placed.join(key_blocks(parent, field), "block", "left").filter(~there).select(*child.columns)


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ5: one row per duplicated key combination."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def _non_positive(col: str) -> Column:
    return F.col(col) <= F.lit(0)


def check_positive(df: DataFrame, col: str, allow_null: bool = False) -> DataFrame:
    """DQ6: rows with a value <= 0. ``allow_null`` only adds ``is not null``,
    which changes nothing because ``NULL <= 0`` is not true."""
    cond = _non_positive(col)
    if allow_null:
        cond = F.col(col).isNotNull() & cond
    return df.filter(cond)


def check_net_revenue(lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """DQ7: staged net revenue differs from price * (1 - discount) by more than a cent."""
    expected = (F.col("extended_price") * (F.lit(1) - F.col("discount_rate"))).cast("decimal(38,6)")
    variance = F.abs(F.col("net_revenue") - expected).cast("decimal(38,6)")
    return (lines.select("order_key", "line_number", "extended_price", "discount_rate", "net_revenue",
                         expected.alias("expected_net_revenue"), variance.alias("variance"))
            .filter(F.col("variance") > F.lit(tolerance)))


def check_orphaned_lines(line_fact: DataFrame, order_fact: DataFrame) -> DataFrame:
    """DQ8: line-fact rows with no order-fact row (with context columns)."""
    return join_small(line_fact.select("order_item_key", "order_key", "line_number", "customer_key", "net_revenue"),
                      order_fact.select("order_key"), "order_key", "left_anti")


def check_revenue_reconciles(order_fact: DataFrame, line_fact: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """DQ9: order-grain revenue differs from the re-summed line grain, or the order has no lines.

    The line side is aggregated to order grain before the join (no fan-out),
    and both sides are then hash-partitioned on ``order_key``."""
    lines = line_fact.groupBy("order_key").agg(
        F.sum("net_revenue").cast("decimal(38,2)").alias("line_item_grain_net_revenue"))
    joined = order_fact.select("order_key", F.col("net_revenue").alias("order_grain_net_revenue")) \
        .join(lines, "order_key", "left")
    variance = F.abs(F.col("order_grain_net_revenue") - F.col("line_item_grain_net_revenue"))
    return (joined.select("order_key", "order_grain_net_revenue", "line_item_grain_net_revenue",
                          variance.alias("variance"))
            .filter((F.col("variance") > F.lit(tolerance)) | F.col("line_item_grain_net_revenue").isNull()))


def check_one_current(history: DataFrame, key: str = "customer_key") -> DataFrame:
    """DQ10: keys whose number of current versions is not exactly one (a hard
    delete leaves zero, which this reports)."""
    return (history.groupBy(key)
            .agg(F.sum(F.when(F.col("is_current"), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
                 .alias("current_version_count"))
            .filter(F.col("current_version_count") != F.lit(1)))


# ---------------------------------------------------------------------------
# Declared checks and the suite
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    kind: str            # unique | not_null | accepted_values | relationships | unique_combination | positive
    table: str
    columns: tuple[str, ...]
    values: tuple = ()   # accepted values
    parent: str = ""     # relationships: parent table
    field: str = ""      # relationships: parent column
    params: dict = dc_field(default_factory=dict, compare=False, hash=False)

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    @property
    def name(self) -> str:
        return f"{self.kind}__{self.table}__{'__'.join(self.columns)}"

    def violations(self, tables: dict[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        c = self.columns[0]
        if self.kind == "unique":
            return check_unique(df, c)
        if self.kind == "not_null":
            return check_not_null(df, c)
        if self.kind == "accepted_values":
            return check_accepted_values(df, c, self.values)
        if self.kind == "relationships":
            return check_relationships(df, c, tables[self.parent], self.field)
        if self.kind == "unique_combination":
            return check_unique_combination(df, self.columns)
        if self.kind == "positive":
            return check_positive(df, c, self.params.get("allow_null", False))
        if self.kind == "net_revenue_formula":
            return check_net_revenue(df)
        if self.kind == "no_orphans":
            return check_orphaned_lines(df, tables[self.parent])
        if self.kind == "revenue_reconciles":
            return check_revenue_reconciles(df, tables[self.parent])
        if self.kind == "one_current":
            return check_one_current(df, c)
        raise ValueError(f"unknown check kind {self.kind}")

    def failing_condition(self) -> Column:
        """Row-level predicate of a row-wise check."""
        c = self.columns[0]
        if self.kind == "not_null":
            return F.col(c).isNull()
        if self.kind == "accepted_values":
            return _not_accepted(c, self.values)
        if self.kind == "positive":
            return F.coalesce(_non_positive(c), F.lit(False))
        raise ValueError(f"{self.kind} is not row-wise")


# Columns that the whole-table checks read, of the table and of the parent.
_WHOLE = {"net_revenue_formula": (("order_key", "line_number", "extended_price", "discount_rate", "net_revenue"), ()),
          "no_orphans": (("order_item_key", "order_key", "line_number", "customer_key", "net_revenue"), ("order_key",)),
          "revenue_reconciles": (("order_key", "net_revenue"), ("order_key", "net_revenue")),
          "one_current": (("customer_key", "is_current"), ())}


def reads(checks: Sequence[Check]) -> dict[str, tuple[set[str], int]]:
    """Per table, the columns that ``checks`` read and how often they scan it: once
    for all row-wise checks, and once for every other check or parent."""
    columns: dict[str, set[str]] = {}
    scans: dict[str, int] = {}
    for c in checks:
        own, parent = _WHOLE.get(c.kind, (c.columns, (c.field,)))
        columns.setdefault(c.table, set()).update(own)
        if c.parent:
            columns.setdefault(c.parent, set()).update(parent)
        for t in filter(None, (c.table if c.kind not in ROW_WISE else None, c.parent)):
            scans[t] = scans.get(t, 0) + 1
    for t in {c.table for c in checks if c.kind in ROW_WISE}:
        scans[t] = scans.get(t, 0) + 1
    return {t: (columns[t], scans[t]) for t in scans}


def _summary(check: Check, failing: Column) -> Column:
    return F.struct(F.lit(check.name).alias("check_name"), F.lit(check.table).alias("table_name"),
                    F.lit(check.column).alias("column_name"), failing.cast("bigint").alias("failing_rows"))


def run_suite(checks: Sequence[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Evaluate ``checks``; one summary row per check, with status pass, fail, or
    skipped where a table it names was not given."""
    able = [c for c in checks if c.table in tables and (not c.parent or c.parent in tables)]
    skipped = [c for c in checks if c not in able]
    checks = able
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ROW_WISE:
            by_table.setdefault(c.table, []).append(c)
        elif c.kind == "relationships":
            # count child rows per key map-side, then anti-join distinct keys only
            child = tables[c.table].filter(F.col(c.column).isNotNull()).groupBy(c.column) \
                .agg(F.count(F.lit(1)).alias("_n"))
            missing = without_parent(child, c.column, tables[c.parent], c.field)
            parts.append(missing.agg(_summary(c, F.coalesce(F.sum("_n"), F.lit(0))).alias("s")))
        else:
            parts.append(c.violations(tables).agg(_summary(c, F.count(F.lit(1))).alias("s")))
    for table, group in by_table.items():
        # one scan of the table for all its row-wise checks
        counts = tables[table].agg(*[F.count_if(c.failing_condition()).alias(f"c{i}") for i, c in enumerate(group)])
        parts.append(counts.select(F.explode(F.array(*[_summary(c, F.col(f"c{i}")) for i, c in enumerate(group)]))
                                   .alias("s")))
    if not parts:
        raise ValueError("no check applies to the given tables")
    out = union_all(parts).select("s.*")
    if skipped:
        rows = F.array(*[_summary(c, F.lit(None)) for c in skipped])
        out = out.unionByName(out.sparkSession.range(1).select(F.explode(rows).alias("s")).select("s.*"))
    passed = F.col("failing_rows") == F.lit(0)
    status = F.when(passed.isNull(), F.lit("skipped")).when(passed, F.lit("pass")).otherwise(F.lit("fail"))
    return out.select("*", passed.alias("passed"), status.alias("status"))


# Accepted value domains.
ORDER_STATUS = ("O", "F", "P")
ORDER_PRIORITY = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
RETURN_FLAG = ("R", "A", "N")
LINE_STATUS = ("O", "F")
SHIP_INSTRUCTIONS = ("DELIVER IN PERSON", "COLLECT COD", "TAKE BACK RETURN", "NONE")
SHIP_MODE = ("REG AIR", "AIR", "RAIL", "SHIP", "TRUCK", "MAIL", "FOB")
MARKET_SEGMENT = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REGION_NAME = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _u(t, c):
    return [Check("unique", t, (c,)), Check("not_null", t, (c,))]


def _nn(t, *cs):
    return [Check("not_null", t, (c,)) for c in cs]


def _av(t, c, vals):
    return [Check("accepted_values", t, (c,), values=vals)]


def _rel(t, c, parent, f):
    return [Check("relationships", t, (c,), parent=parent, field=f)]


def _pos(t, *cs):
    return [Check("positive", t, (c,)) for c in cs]


def _uc(t, *cs):
    return [Check("unique_combination", t, tuple(cs))]


# The declared column tests per table (131 in all).
DECLARED_CHECKS: tuple[Check, ...] = tuple(
    # sources
    _u("orders", "o_orderkey") + _nn("orders", "o_custkey") + _rel("orders", "o_custkey", "customer", "c_custkey")
    + _nn("lineitem", "l_orderkey") + _rel("lineitem", "l_orderkey", "orders", "o_orderkey")
    + _nn("lineitem", "l_partkey")
    + _u("customer", "c_custkey") + _nn("customer", "c_nationkey")
    + _u("supplier", "s_suppkey") + _u("part", "p_partkey")
    + _uc("partsupp", "ps_partkey", "ps_suppkey")
    + _nn("partsupp", "ps_partkey") + _rel("partsupp", "ps_partkey", "part", "p_partkey")
    + _nn("partsupp", "ps_suppkey") + _rel("partsupp", "ps_suppkey", "supplier", "s_suppkey")
    + _u("nation", "n_nationkey") + _u("region", "r_regionkey")
    # staging
    + _u("stg_orders", "order_key") + _nn("stg_orders", "customer_key")
    + _av("stg_orders", "order_status", ORDER_STATUS) + _av("stg_orders", "order_priority", ORDER_PRIORITY)
    + _nn("stg_orders", "total_price") + _pos("stg_orders", "total_price") + _nn("stg_orders", "order_date")
    + _uc("stg_lineitems", "order_key", "line_number")
    + _nn("stg_lineitems", "order_key", "line_number", "part_key", "supplier_key")
    + _av("stg_lineitems", "return_flag", RETURN_FLAG) + _av("stg_lineitems", "line_status", LINE_STATUS)
    + _av("stg_lineitems", "ship_instructions", SHIP_INSTRUCTIONS) + _av("stg_lineitems", "ship_mode", SHIP_MODE)
    + _pos("stg_lineitems", "quantity", "extended_price") + _nn("stg_lineitems", "discount_rate")
    + _pos("stg_lineitems", "net_revenue")
    + _u("stg_customers", "customer_key") + _nn("stg_customers", "nation_key")
    + _av("stg_customers", "market_segment", MARKET_SEGMENT)
    + _u("stg_suppliers", "supplier_key") + _nn("stg_suppliers", "nation_key")
    + _u("stg_parts", "part_key") + _pos("stg_parts", "retail_price")
    + _uc("stg_part_suppliers", "part_key", "supplier_key")
    + _nn("stg_part_suppliers", "part_key") + _rel("stg_part_suppliers", "part_key", "stg_parts", "part_key")
    + _nn("stg_part_suppliers", "supplier_key")
    + _rel("stg_part_suppliers", "supplier_key", "stg_suppliers", "supplier_key")
    + _pos("stg_part_suppliers", "available_quantity", "supply_cost")
    + _u("stg_nations", "nation_key") + _nn("stg_nations", "region_key")
    + _rel("stg_nations", "region_key", "stg_regions", "region_key")
    + _u("stg_regions", "region_key") + _av("stg_regions", "region_name", REGION_NAME)
    # intermediate
    + _u("order_rollup", "order_key") + _rel("order_rollup", "order_key", "stg_orders", "order_key")
    + _pos("order_rollup", "gross_revenue", "net_revenue")
    # core marts
    + _u("customer_dim", "customer_key")
    + _nn("customer_dim", "nation_key", "region_key", "customer_name")
    + _av("customer_dim", "market_segment", MARKET_SEGMENT) + _nn("customer_dim", "nation_name", "region_name")
    + _u("supplier_dim", "supplier_key")
    + _nn("supplier_dim", "nation_key", "region_key", "supplier_name", "nation_name", "region_name")
    + _u("part_dim", "part_key") + _nn("part_dim", "part_name", "brand") + _pos("part_dim", "retail_price")
    + _u("customer_history", "customer_history_key")
    + _nn("customer_history", "customer_key", "nation_key", "valid_from", "is_current")
    # finance marts
    + _u("order_fact", "order_key") + _nn("order_fact", "customer_key")
    + _rel("order_fact", "customer_key", "customer_dim", "customer_key")
    + _av("order_fact", "order_status", ORDER_STATUS) + _av("order_fact", "order_priority", ORDER_PRIORITY)
    + _nn("order_fact", "order_date")
    + _pos("order_fact", "order_total_price", "line_item_count", "total_quantity", "gross_revenue", "net_revenue")
    + _u("line_fact", "order_item_key") + _nn("line_fact", "order_key")
    + _rel("line_fact", "order_key", "order_fact", "order_key") + _nn("line_fact", "line_number")
    + _nn("line_fact", "customer_key") + _rel("line_fact", "customer_key", "customer_dim", "customer_key")
    + _nn("line_fact", "supplier_key") + _rel("line_fact", "supplier_key", "supplier_dim", "supplier_key")
    + _nn("line_fact", "part_key") + _rel("line_fact", "part_key", "part_dim", "part_key")
    + _av("line_fact", "return_flag", RETURN_FLAG) + _av("line_fact", "line_status", LINE_STATUS)
    + _av("line_fact", "ship_mode", SHIP_MODE) + _av("line_fact", "ship_instructions", SHIP_INSTRUCTIONS)
    + _pos("line_fact", "net_revenue", "extended_price", "quantity")
    # calendar
    + _u("calendar", "date_day")
)


#: Checks over whole tables: the revenue formula, orphans, reconciliation, one current version.
SINGULAR_CHECKS: tuple[Check, ...] = (
    Check("net_revenue_formula", "stg_lineitems", ("net_revenue",)),
    Check("no_orphans", "line_fact", ("order_key",), parent="order_fact"),
    Check("revenue_reconciles", "order_fact", ("net_revenue",), parent="line_fact"),
    Check("one_current", "customer_history", ("customer_key",)),
)
ALL_CHECKS = DECLARED_CHECKS + SINGULAR_CHECKS


def declared(kind: str | None = None) -> list[Check]:
    return [c for c in DECLARED_CHECKS if kind is None or c.kind == kind]
