"""The star schema as lazy DataFrames over one data directory (E1 without writes).

``Star(spark, dir)`` resolves each model on first use and memoizes the lazy
DataFrame (not its data): every consumer composes the same logical plan, so
Catalyst prunes and pushes down per query. Use :mod:`starmart.plans.build` to
materialize the marts as tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts
from ..operators.calendar import calendar
from ..operators.colocated import Colocated, order_rollup_in_place
from ..operators.staging import staged
from .joins import dealt


class Star:
    """``colocated`` names a folder and a number of buckets: orders and lines are
    stored there by order key (:meth:`store_by_order`), and every mart and check
    that joins or groups them by it runs without a shuffle of either."""

    def __init__(self, spark: SparkSession, data_dir: str, colocated: tuple[str, int] | None = None):
        self.spark = spark
        self.data_dir = data_dir
        self.by_order = {name: Colocated(spark, f"{colocated[0]}/{name}", "order_key", colocated[1])
                         for name in ("orders", "lines")} if colocated else {}

    def store_by_order(self) -> None:
        """Write orders and lines by order key, from the sources as they are now."""
        for name, table in (("orders", "orders"), ("lines", "lineitem")):
            self.by_order[name].write(staged(self.spark, self.data_dir, table))
            self.__dict__.pop(name, None)

    # staging (views)
    @cached_property
    def orders(self) -> DataFrame:
        return self._stored("orders") if self.by_order else staged(self.spark, self.data_dir, "orders")

    def _stored(self, name: str) -> DataFrame:
        found = self.by_order[name].read()
        if found is None:
            raise ValueError(f"{name} are not stored by order yet: call store_by_order()")
        return found

    @cached_property
    def lines(self) -> DataFrame:
        return self._stored("lines") if self.by_order else staged(self.spark, self.data_dir, "lineitem")

    @cached_property
    def customers(self) -> DataFrame:
        return staged(self.spark, self.data_dir, "customer")

    @cached_property
    def suppliers(self) -> DataFrame:
        return staged(self.spark, self.data_dir, "supplier")

    @cached_property
    def parts(self) -> DataFrame:
        return staged(self.spark, self.data_dir, "part")

    @cached_property
    def nations(self) -> DataFrame:
        return staged(self.spark, self.data_dir, "nation")

    @cached_property
    def regions(self) -> DataFrame:
        return staged(self.spark, self.data_dir, "region")

    def part_suppliers(self) -> DataFrame:
        return staged(self.spark, self.data_dir, "partsupp")

    # marts
    @cached_property
    def customer_dim(self) -> DataFrame:
        return marts.customer_dim(self.customers, self.nations, self.regions)

    @cached_property
    def supplier_dim(self) -> DataFrame:
        return marts.supplier_dim(self.suppliers, self.nations, self.regions)

    @cached_property
    def part_dim(self) -> DataFrame:
        return marts.part_dim(self.parts)

    @cached_property
    def order_rollup(self) -> DataFrame:
        if self.by_order and self.by_order["lines"].even:
            return order_rollup_in_place(self.lines)
        return marts.order_rollup(self.lines)

    @cached_property
    def order_fact(self) -> DataFrame:
        return marts.order_fact(self.orders, self.order_rollup)

    @cached_property
    def line_fact(self) -> DataFrame:
        return marts.line_fact(self.lines, self.orders)

    @cached_property
    def line_fact_by_order(self) -> DataFrame:
        """The line fact for an aggregate by order: as many tasks as its size calls for."""
        return self.line_fact if self.by_order else marts.line_fact(dealt(self.lines, "order_key"), self.orders)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar(self.spark)
