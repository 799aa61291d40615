"""Consumer reports (RPT1-RPT4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import MONEY_SUM, flag_int, pct, ratio
from ..functions.ordered import ordered_neighbors
from .joins import join_small


def segment_region_revenue(line_fact: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """RPT4: revenue by customer region and market segment, largest first.

    Lines are first pre-aggregated to one row per (customer, order), so the
    join with the customer dimension (broadcast only under the size bound,
    else a shuffle join) moves order-grain partials, not line rows. The final
    aggregate over 25 groups counts distinct customers and orders over those
    partials; Spark's distinct rewrite dedupes (group, key) pairs in shuffles
    keyed on the pairs, so the few final groups never gather raw rows.
    """
    per_order = line_fact.groupBy("customer_key", "order_key").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("net_revenue").alias("net"),
        F.sum("discount_amount").alias("disc"),
        F.sum(flag_int(F.col("is_returned"))).alias("returned"))
    c = customer_dim.select("customer_key", "region_name", "market_segment")
    joined = join_small(per_order, c, "customer_key", "inner")
    agg = joined.groupBy("region_name", "market_segment").agg(
        F.countDistinct("customer_key").alias("customer_count"),
        F.countDistinct("order_key").alias("order_count"),
        F.sum("lines").alias("line_item_count"),
        F.sum("net").cast(MONEY_SUM).alias("total_net_revenue"),
        F.sum("disc").cast(MONEY_SUM).alias("total_discount_amount"),
        F.sum("returned").alias("returned_item_count"),
    )
    return agg.select(
        "region_name", "market_segment", "customer_count", "order_count", "line_item_count",
        "total_net_revenue", "total_discount_amount",
        ratio("total_net_revenue", "order_count").alias("avg_order_value"),
        pct("returned_item_count", "line_item_count").alias("return_rate_pct"),
    ).orderBy(F.desc("total_net_revenue"))


def shipping_operations(line_fact: DataFrame, supplier_dim: DataFrame, mix_by: str = "ship_mode",
                        transit_col: str = "days_in_transit") -> DataFrame:
    """RPT2: transit time, return rate and the ``mix_by`` mix per supplier region.

    Lines are pre-aggregated per (supplier, mix value) before the supplier
    join. ``mix_share_pct`` is the group's share of its region's line items;
    the window runs over the already-aggregated (region x mix value) rows only.
    """
    per_supplier = line_fact.groupBy("supplier_key", mix_by).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(transit_col).alias("transit_sum"), F.count(transit_col).alias("transit_n"),
        F.sum(flag_int(F.col("is_returned"))).alias("returned"))
    s = supplier_dim.select("supplier_key", F.col("region_name").alias("supplier_region_name"))
    joined = join_small(per_supplier, s, "supplier_key", "left")
    agg = joined.groupBy("supplier_region_name", mix_by).agg(
        F.sum("lines").alias("line_item_count"),
        F.try_divide(F.sum("transit_sum").cast("double"), F.sum("transit_n").cast("double"))
        .alias(f"avg_{transit_col}"),
        F.sum("returned").alias("returned_item_count"),
    )
    region_total = F.sum("line_item_count").over(Window.partitionBy("supplier_region_name"))
    return agg.select(
        "supplier_region_name", mix_by, "line_item_count", f"avg_{transit_col}",
        pct("returned_item_count", "line_item_count").alias("return_rate_pct"),
        pct(F.col("line_item_count"), region_total).alias("mix_share_pct"),
    )


def part_revenue(line_fact: DataFrame, part_dim: DataFrame) -> DataFrame:
    """J12: what each brand and part category sold. Lines are summed per part
    before the part dimension joins; parts unknown to it group under NULL."""
    per_part = line_fact.groupBy("part_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"), F.sum("net_revenue").alias("net"),
        F.sum(flag_int(F.col("is_returned"))).alias("returned"))
    joined = join_small(per_part, part_dim.select("part_key", "brand", "part_category"), "part_key", "left")
    agg = joined.groupBy("brand", "part_category").agg(
        F.count("part_key").alias("part_count"), F.sum("lines").alias("line_item_count"),
        F.sum("quantity").cast(MONEY_SUM).alias("quantity"), F.sum("net").cast(MONEY_SUM).alias("net_revenue"),
        F.sum("returned").alias("returned_item_count"))
    return agg.select("brand", "part_category", "part_count", "line_item_count", "quantity", "net_revenue",
                      pct("returned_item_count", "line_item_count").alias("return_rate_pct"))


def segment_changes(history: DataFrame, key: str = "customer_key", attr: str = "market_segment") -> DataFrame:
    """RPT3: when and how ``attr`` changed, one row per change (first versions excluded).

    Previous value and version number come from the bucketed two-level lag /
    row number: the versions of a key gather by month, and of a key with a very
    long history only one row per month meets in one task."""
    n = ordered_neighbors(history.select(key, "valid_from", attr), key, "valid_from", lag_cols=[attr],
                          row_number=True, grain="month")
    return (n.filter((F.col("_rn") > 1) & ~F.col(attr).eqNullSafe(F.col(f"_prev_{attr}")))
            .select(key, F.col("valid_from").alias("changed_at"), F.col(f"_prev_{attr}").alias(f"previous_{attr}"),
                    F.col(attr).alias(f"new_{attr}"), F.col("_rn").alias("version_number")))
