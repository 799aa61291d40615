"""Readers for source tables and seeds (SRC1, SRC2, SRC4)."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import union_all
from .contracts import CONTRACTS, CUSTOMER_FEED_SCHEMA


class MissingColumnError(ValueError):
    pass


def conform(df: DataFrame, table: str) -> DataFrame:
    """Fill absent optional contract columns with typed NULLs; raise on absent required ones.

    Only adds columns, never reads more: the staging ``select`` afterwards lets
    Catalyst prune every raw column that no mart uses from the Parquet scan.
    """
    present = {c.lower() for c in df.columns}
    missing_required = [c.name for c in CONTRACTS[table] if c.required and c.name not in present]
    if missing_required:
        raise MissingColumnError(f"{table}: missing required columns {missing_required}")
    fills = {c.name: F.lit(None).cast(c.dtype) for c in CONTRACTS[table] if c.name not in present}
    return df.withColumns(fills) if fills else df


def source_path(data_dir: str, table: str) -> str:
    return f"{data_dir.rstrip('/')}/{table}.parquet"


def source_exists(spark: SparkSession, data_dir: str, table: str) -> bool:
    """Whether an extract ships ``table`` (a file-system check, no scan)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(source_path(data_dir, table))
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_source(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    """SRC1: scan one named source table and conform it to its contract."""
    return conform(spark.read.parquet(source_path(data_dir, table)), table)


def read_seed(spark: SparkSession, path: str, schema: str = CUSTOMER_FEED_SCHEMA) -> DataFrame:
    """SRC2: a CSV seed read with declared column types (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def row_counts(spark: SparkSession, data_dir: str, tables: list[str]) -> DataFrame:
    """SRC4: one row per source table with its row count (a single job, one scan each)."""
    parts = [spark.read.parquet(source_path(data_dir, t)).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in tables]
    return union_all(parts)
