"""Source contracts: the raw columns each staging function reads.

A column is *required* when a mart or check cannot be built without it and
*optional* when the marts only carry it through. Readers fill an absent
optional column with a typed NULL and raise on an absent required one, so a
narrower extract (fewer attributes) still builds the whole star schema.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Col:
    name: str
    dtype: str          # Spark SQL type name used for the NULL fill
    required: bool = True


def _opt(name: str, dtype: str) -> Col:
    return Col(name, dtype, required=False)


# The eight TPC-H source tables and the raw columns staging uses.
CONTRACTS: dict[str, tuple[Col, ...]] = {
    "orders": (
        Col("o_orderkey", "bigint"), Col("o_custkey", "bigint"), Col("o_orderstatus", "string"),
        Col("o_totalprice", "decimal(12,2)"), Col("o_orderdate", "date"), Col("o_orderpriority", "string"),
        _opt("o_clerk", "string"), _opt("o_shippriority", "int"), _opt("o_comment", "string"),
    ),
    "lineitem": (
        Col("l_orderkey", "bigint"), Col("l_linenumber", "int"), Col("l_partkey", "bigint"),
        Col("l_suppkey", "bigint"), Col("l_quantity", "decimal(12,2)"), Col("l_extendedprice", "decimal(12,2)"),
        Col("l_discount", "decimal(5,4)"), Col("l_tax", "decimal(5,4)"), Col("l_returnflag", "string"),
        Col("l_linestatus", "string"), Col("l_shipdate", "date"),
        _opt("l_commitdate", "date"), _opt("l_receiptdate", "date"), _opt("l_shipinstruct", "string"),
        _opt("l_shipmode", "string"), _opt("l_comment", "string"),
    ),
    "customer": (
        Col("c_custkey", "bigint"), Col("c_nationkey", "int"), Col("c_name", "string"),
        Col("c_mktsegment", "string"), Col("c_acctbal", "decimal(12,2)"),
        _opt("c_address", "string"), _opt("c_phone", "string"), _opt("c_comment", "string"),
    ),
    "supplier": (
        Col("s_suppkey", "bigint"), Col("s_nationkey", "int"), Col("s_name", "string"),
        Col("s_acctbal", "decimal(12,2)"),
        _opt("s_address", "string"), _opt("s_phone", "string"), _opt("s_comment", "string"),
    ),
    "part": (
        Col("p_partkey", "bigint"), Col("p_name", "string"), Col("p_brand", "string"), Col("p_type", "string"),
        Col("p_size", "int"), Col("p_retailprice", "decimal(12,2)"),
        _opt("p_mfgr", "string"), _opt("p_container", "string"), _opt("p_comment", "string"),
    ),
    "partsupp": (
        Col("ps_partkey", "bigint"), Col("ps_suppkey", "bigint"), Col("ps_availqty", "int"),
        Col("ps_supplycost", "decimal(12,2)"), _opt("ps_comment", "string"),
    ),
    "nation": (
        Col("n_nationkey", "int"), Col("n_name", "string"), Col("n_regionkey", "int"),
        _opt("n_comment", "string"),
    ),
    "region": (
        Col("r_regionkey", "int"), Col("r_name", "string"), _opt("r_comment", "string"),
    ),
}

# Fixed value: the feed the SCD2 snapshot reads (one row per customer, current state).
CUSTOMER_FEED_SCHEMA = (
    "customer_key int, customer_name string, market_segment string, account_balance decimal(12,2), "
    "phone string, address string, nation_key int, effective_date date"
)
