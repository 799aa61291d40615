import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

D = Decimal


def d(s):
    return dt.date.fromisoformat(s)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from starmart.session import DEFAULT_CONF

    b = (SparkSession.builder.master("local[2]").appName("starmart-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt"))))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def workdir(tmp_path):
    return str(tmp_path)


# Full-width source fixtures (FIXTURES.md section 1), a handful of rows each.

ORDERS_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(12,2), "
                 "o_orderdate date, o_orderpriority string, o_clerk string, o_shippriority int, o_comment string")
LINES_SCHEMA = ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity decimal(12,2), "
                "l_extendedprice decimal(12,2), l_discount decimal(5,4), l_tax decimal(5,4), l_returnflag string, "
                "l_linestatus string, l_shipdate date, l_commitdate date, l_receiptdate date, "
                "l_shipinstruct string, l_shipmode string, l_comment string")
CUSTOMER_SCHEMA = ("c_custkey bigint, c_nationkey int, c_name string, c_address string, c_phone string, "
                   "c_mktsegment string, c_comment string, c_acctbal decimal(12,2)")
SUPPLIER_SCHEMA = ("s_suppkey bigint, s_nationkey int, s_name string, s_address string, s_phone string, "
                   "s_comment string, s_acctbal decimal(12,2)")
PART_SCHEMA = ("p_partkey bigint, p_name string, p_mfgr string, p_brand string, p_type string, p_container string, "
               "p_comment string, p_size int, p_retailprice decimal(12,2)")
PARTSUPP_SCHEMA = "ps_partkey bigint, ps_suppkey bigint, ps_availqty int, ps_supplycost decimal(12,2), ps_comment string"
NATION_SCHEMA = "n_nationkey int, n_regionkey int, n_name string, n_comment string"
REGION_SCHEMA = "r_regionkey int, r_name string, r_comment string"


@pytest.fixture
def raw(spark):
    orders = spark.createDataFrame([
        (1, 10, "F", D("100.00"), d("1996-01-02"), "1-URGENT", "Clerk#1", 0, "c"),
        (2, 11, "O", D("200.00"), d("1996-01-05"), "2-HIGH", "Clerk#2", 0, "c"),
        (3, 10, "P", D("50.00"), d("1996-02-01"), "3-MEDIUM", "Clerk#3", 0, "c"),  # no lines
    ], ORDERS_SCHEMA)
    lines = spark.createDataFrame([
        (1, 1, 100, 1000, D("2.00"), D("10.00"), D("0.0500"), D("0.1000"), "R", "F", d("1996-01-03"),
         d("1996-01-04"), d("1996-01-08"), "NONE", "AIR", "x"),
        (1, 2, 101, 1000, D("1.00"), D("0.05"), D("0.1000"), D("0.0000"), None, "F", d("1996-01-03"),
         d("1996-01-04"), None, "COLLECT COD", "RAIL", "x"),
        (2, 1, 100, 1001, D("5.00"), D("20.00"), D("0.0000"), D("0.0800"), "N", "O", d("1996-01-06"),
         d("1996-01-07"), d("1996-01-06"), "TAKE BACK RETURN", "SHIP", "x"),
        (9, 1, 100, 1001, D("5.00"), D("20.00"), D("0.0000"), D("0.0800"), "A", "O", d("1996-01-06"),
         d("1996-01-07"), d("1996-01-09"), "NONE", "MAIL", "orphan"),
    ], LINES_SCHEMA)
    customers = spark.createDataFrame([
        (10, 1, "Customer#10", "addr", "11-111", "BUILDING", "c", D("711.56")),
        (11, 99, "Customer#11", "addr", "22-222", "MACHINERY", "c", D("-5.00")),  # unknown nation
    ], CUSTOMER_SCHEMA)
    suppliers = spark.createDataFrame([
        (1000, 1, "Supplier#1000", "a", "p", "c", D("1.00")),
        (1001, 2, "Supplier#1001", "a", "p", "c", D("2.00")),
    ], SUPPLIER_SCHEMA)
    parts = spark.createDataFrame([
        (100, "part a", "Manufacturer#1", "Brand#1", "ECONOMY ANODIZED STEEL", "SM BOX", "c", 7, D("901.00")),
        (101, "part b", "Manufacturer#2", "Brand#2", "PROMO", "LG CASE", "c", 3, D("902.00")),
    ], PART_SCHEMA)
    partsupp = spark.createDataFrame([(100, 1000, 5, D("1.50"), "c"), (100, 1000, 6, D("0.00"), "dup"),
                                      (102, 1000, 1, D("1.00"), "no part")], PARTSUPP_SCHEMA)
    nations = spark.createDataFrame([(1, 0, "FRANCE", "c"), (2, 1, "JAPAN", "c")], NATION_SCHEMA)
    regions = spark.createDataFrame([(0, "EUROPE", "c"), (1, "ASIA", "c")], REGION_SCHEMA)
    return dict(orders=orders, lineitem=lines, customer=customers, supplier=suppliers, part=parts,
                partsupp=partsupp, nation=nations, region=regions)


@pytest.fixture
def staged(raw):
    from starmart.operators.staging import STAGERS
    from starmart.sources import conform
    return {t: STAGERS[t](conform(df, t)) for t, df in raw.items()}
