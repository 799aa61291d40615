"""Tables stored by order key, so that joins and aggregates on it need no shuffle
(J3, J4, J6, AGG1).

A :class:`Colocated` table is bucketed and sorted on one key, one file per bucket.
Two of them with the same number of buckets join file by file, and an aggregate by
the key runs where its rows lie. Writing pays one shuffle, once, for all readers.

A bucket is one task, which Spark cannot split. So the rows per bucket are counted
on the written files (from their names; only row counts are read), and a table
whose largest bucket holds more than ``UNEVEN`` times the mean, as where one key
holds a third of the rows, is read as plain files: joins shuffle it then, and
adaptive execution splits the hot partition.

A version is committed by one rename (see :mod:`.manifest`); the table it replaces
goes with the next write.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import MONEY_SUM, TAX_SUM, flag_int, mean
from ..session import remove
from .manifest import Manifests, children

UNEVEN = 4.0


class Colocated:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def write(self, df: DataFrame) -> DataFrame:
        """Replace the table, and read it."""
        manifests, folder = Manifests(self.spark, self.path), f"rows-{uuid.uuid4().hex}"
        number, name = manifests.current()[0], self._name(folder)
        # dealt as the buckets are, so that each is one file
        df.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key) \
            .option("path", f"{self.path}/{folder}").format("parquet").saveAsTable(name)
        bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_([0-9]+)\.c[0-9]+", 1)
        held = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").groupBy(bucket).count().agg(F.max("count"), F.sum("count")).first()
        even = not held[1] or held[0] <= UNEVEN * max(1.0, held[1] / self.buckets)
        manifests.commit(number, {"folder": folder, "schema": json.loads(df.schema.json()), "key": self.key, "buckets": self.buckets, "even": even})
        manifests.forget(0)
        for f in children(self.spark, f"{self.path}/rows-*"):
            if not f.endswith(folder):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(f.rsplit('/', 1)[1])}")
                remove(self.spark, f)
        return self.read()

    @staticmethod
    def _name(folder: str) -> str:
        return "colocated_" + folder.split("-")[1]

    @property
    def even(self) -> bool:
        return Manifests(self.spark, self.path).current()[1]["even"]

    def read(self) -> DataFrame | None:
        """The newest version; in a session that does not know it, its bucketing is
        declared from the manifest."""
        state = Manifests(self.spark, self.path).current()[1]
        if state is None:
            return None
        schema, name = StructType.fromJson(state["schema"]), self._name(state["folder"])
        if not state["even"]:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{state['folder']}")
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{state['key']}`) SORTED BY (`{state['key']}`) "
                           f"INTO {state['buckets']} BUCKETS LOCATION '{self.path}/{state['folder']}'")
        return self.spark.table(name)


def order_rollup_in_place(lines: DataFrame) -> DataFrame:
    """AGG1-AGG4 as :func:`.marts.order_rollup`, for lines stored by order: one read
    and one aggregate. A part or supplier counts where it comes up first in its
    order, which sorts inside the task show; an Expand, as several distinct counts
    in one aggregate get, would shuffle three rows to a line."""
    for c in ("part_key", "supplier_key"):
        first = F.row_number().over(Window.partitionBy("order_key", c).orderBy(c)) == 1
        lines = lines.withColumn(f"_new_{c}", (first & F.col(c).isNotNull()).cast("int"))
    return lines.groupBy("order_key").agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("_new_part_key").cast("bigint").alias("distinct_part_count"),
        F.sum("_new_supplier_key").cast("bigint").alias("distinct_supplier_count"),
        F.sum("extended_price").cast(MONEY_SUM).alias("gross_revenue"),
        F.sum("net_revenue").cast(MONEY_SUM).alias("net_revenue"),
        F.sum("discount_amount").cast(MONEY_SUM).alias("total_discount_amount"),
        F.sum(F.col("net_revenue") * F.col("tax_rate")).cast(TAX_SUM).alias("total_tax_amount"),
        F.sum("quantity").cast(MONEY_SUM).alias("total_quantity"),
        F.min("ship_date").alias("first_ship_date"),
        F.max("ship_date").alias("last_ship_date"),
        F.max("receipt_date").alias("last_receipt_date"),
        mean("days_in_transit").alias("avg_days_in_transit"),
        F.sum(flag_int(F.col("is_returned"))).cast("bigint").alias("returned_item_count"),
        F.max(flag_int(F.col("is_returned"))).alias("has_any_return"))
