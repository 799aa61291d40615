"""Staging layer (PRJ1-PRJ12): rename, cast and derive, one function per source.

Each function is a single ``select`` over a conformed source DataFrame, so it
is a lazy view: Catalyst collapses it into whatever reads it, prunes unused
columns down to the Parquet scan and pushes filters through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_date, discount_amount, money, net_revenue, rate
from ..sources import read_source


def stage_orders(orders: DataFrame) -> DataFrame:
    """PRJ1."""
    return orders.select(
        F.col("o_orderkey").cast("bigint").alias("order_key"),
        F.col("o_custkey").cast("bigint").alias("customer_key"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_clerk").alias("clerk"),
        F.col("o_shippriority").cast("int").alias("ship_priority"),
        F.col("o_comment").alias("comment"),
        money("o_totalprice").alias("total_price"),
        as_date("o_orderdate").alias("order_date"),
    )


def stage_lineitems(lineitem: DataFrame) -> DataFrame:
    """PRJ2-PRJ6."""
    return lineitem.select(
        F.col("l_orderkey").cast("bigint").alias("order_key"),
        F.col("l_linenumber").cast("int").alias("line_number"),
        F.col("l_partkey").cast("bigint").alias("part_key"),
        F.col("l_suppkey").cast("bigint").alias("supplier_key"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_shipinstruct").alias("ship_instructions"),
        F.col("l_shipmode").alias("ship_mode"),
        F.col("l_comment").alias("comment"),
        money("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("extended_price"),
        rate("l_discount").alias("discount_rate"),
        rate("l_tax").alias("tax_rate"),
        net_revenue("l_extendedprice", "l_discount").alias("net_revenue"),
        discount_amount("l_extendedprice", "l_discount").alias("discount_amount"),
        as_date("l_shipdate").alias("ship_date"),
        as_date("l_commitdate").alias("commit_date"),
        as_date("l_receiptdate").alias("receipt_date"),
        F.datediff(as_date("l_receiptdate"), as_date("l_shipdate")).alias("days_in_transit"),
        F.coalesce(F.col("l_returnflag") == F.lit("R"), F.lit(False)).alias("is_returned"),
    )


def stage_customers(customer: DataFrame) -> DataFrame:
    """PRJ7."""
    return customer.select(
        F.col("c_custkey").cast("bigint").alias("customer_key"),
        F.col("c_nationkey").cast("int").alias("nation_key"),
        F.col("c_name").alias("customer_name"),
        F.col("c_address").alias("address"),
        F.col("c_phone").alias("phone"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("c_comment").alias("comment"),
        money("c_acctbal").alias("account_balance"),
    )


def stage_suppliers(supplier: DataFrame) -> DataFrame:
    """PRJ8."""
    return supplier.select(
        F.col("s_suppkey").cast("bigint").alias("supplier_key"),
        F.col("s_nationkey").cast("int").alias("nation_key"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_address").alias("address"),
        F.col("s_phone").alias("phone"),
        F.col("s_comment").alias("comment"),
        money("s_acctbal").alias("account_balance"),
    )


def stage_parts(part: DataFrame) -> DataFrame:
    """PRJ9: the type string splits on spaces into category / finish / material
    (1st / 2nd / 3rd token; a missing token is '')."""
    return part.select(
        F.col("p_partkey").cast("bigint").alias("part_key"),
        F.col("p_name").alias("part_name"),
        F.col("p_mfgr").alias("manufacturer"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("part_type"),
        F.col("p_container").alias("container"),
        F.col("p_comment").alias("comment"),
        F.col("p_size").cast("int").alias("size"),
        money("p_retailprice").alias("retail_price"),
        *[F.split_part(F.col("p_type"), F.lit(" "), F.lit(i)).alias(name)
          for i, name in ((1, "part_category"), (2, "part_finish"), (3, "part_material"))],
    )


def stage_part_suppliers(partsupp: DataFrame) -> DataFrame:
    """PRJ10."""
    return partsupp.select(
        F.col("ps_partkey").cast("bigint").alias("part_key"),
        F.col("ps_suppkey").cast("bigint").alias("supplier_key"),
        F.col("ps_availqty").cast("int").alias("available_quantity"),
        money("ps_supplycost").alias("supply_cost"),
        F.col("ps_comment").alias("comment"),
    )


def stage_nations(nation: DataFrame) -> DataFrame:
    """PRJ11."""
    return nation.select(
        F.col("n_nationkey").cast("int").alias("nation_key"),
        F.col("n_regionkey").cast("int").alias("region_key"),
        F.col("n_name").alias("nation_name"),
        F.col("n_comment").alias("comment"),
    )


def stage_regions(region: DataFrame) -> DataFrame:
    """PRJ12."""
    return region.select(
        F.col("r_regionkey").cast("int").alias("region_key"),
        F.col("r_name").alias("region_name"),
        F.col("r_comment").alias("comment"),
    )


STAGERS = {
    "orders": stage_orders,
    "lineitem": stage_lineitems,
    "customer": stage_customers,
    "supplier": stage_suppliers,
    "part": stage_parts,
    "partsupp": stage_part_suppliers,
    "nation": stage_nations,
    "region": stage_regions,
}


def staged(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    """Read + conform + stage one source table."""
    return STAGERS[table](read_source(spark, data_dir, table))
