"""Semantic layer: measures, dimensions and entities over marts, and metric queries.

A metric query (SEM3) compiles to plain DataFrame operations:

1. per semantic model that owns a requested measure, take its mart,
2. when a dimension is reached through an entity (``customer__market_segment``),
   pre-aggregate the fact to (local keys, entity key, distinct columns) first,
   then join foreign -> primary only (never primary -> foreign, which would
   fan out) as a size-checked broadcast or shuffle left join,
3. ``groupBy`` the requested dimensions (``order_date__month`` truncates to the
   grain) and aggregate all measures in one pass (partial aggregation before
   the shuffle),
4. if the metrics live in several models, aggregate each separately and
   null-safe full-outer-join the (small) aggregates on the group keys (SEM9),
5. compute derived metrics on the aggregated rows and order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from ..functions import GRAINS, mean, pct, ratio, time_grain
from .joins import join_small

AGGS = ("sum", "count", "count_distinct", "average", "min", "max")


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str  # a Spark SQL expression over the model's mart

    def __post_init__(self):
        if self.agg not in AGGS:
            raise ValueError(f"measure {self.name}: unknown agg {self.agg!r}")


@dataclass(frozen=True)
class Dimension:
    name: str
    type: str = "categorical"  # or "time"
    expr: str | None = None

    @property
    def column(self) -> Column:
        return F.expr(self.expr) if self.expr else F.col(self.name)


@dataclass(frozen=True)
class Entity:
    name: str
    type: str  # "primary" | "foreign" | "unique"
    expr: str


@dataclass(frozen=True)
class SemanticModel:
    name: str
    mart: str
    measures: tuple[Measure, ...]
    dimensions: tuple[Dimension, ...]
    entities: tuple[Entity, ...]
    default_time: str | None = None

    def measure(self, name: str) -> Measure | None:
        return next((m for m in self.measures if m.name == name), None)

    def dimension(self, name: str) -> Dimension | None:
        return next((d for d in self.dimensions if d.name == name), None)

    def entity(self, name: str) -> Entity | None:
        return next((e for e in self.entities if e.name == name), None)

    @property
    def primary(self) -> Entity | None:
        return next((e for e in self.entities if e.type in ("primary", "unique")), None)


@dataclass(frozen=True)
class Metric:
    name: str
    type: str  # "simple" | "derived"
    measure: str | None = None
    inputs: tuple[str, ...] = ()
    compute: Callable[[dict[str, Column]], Column] | None = field(default=None, compare=False)


# ---------------------------------------------------------------------------
# Declarations. Names, aggregations and expressions of the
# measures, dimensions, entities and metrics the project defines.
# ---------------------------------------------------------------------------

ORDER_ITEMS = SemanticModel(
    name="order_items", mart="line_fact", default_time="order_date",
    measures=(
        Measure("net_revenue", "sum", "net_revenue"),
        Measure("gross_revenue", "sum", "extended_price"),
        Measure("discount_amount", "sum", "discount_amount"),
        Measure("quantity", "sum", "quantity"),
        Measure("order_count", "count_distinct", "order_key"),
        Measure("line_item_count", "count", "1"),
        Measure("avg_discount_rate", "average", "discount_rate"),
        Measure("avg_days_in_transit", "average", "days_in_transit"),
        Measure("returned_item_count", "sum", "case when is_returned then 1 else 0 end"),
    ),
    dimensions=(
        Dimension("order_date", "time"), Dimension("ship_date", "time"),
        Dimension("order_status"), Dimension("order_priority"), Dimension("ship_mode"),
        Dimension("return_flag"), Dimension("is_returned"),
    ),
    entities=(
        Entity("order_item", "primary", "order_item_key"), Entity("order", "foreign", "order_key"),
        Entity("customer", "foreign", "customer_key"), Entity("supplier", "foreign", "supplier_key"),
        Entity("part", "foreign", "part_key"),
    ),
)

CUSTOMERS = SemanticModel(
    name="customers", mart="customer_dim", default_time="customer_created_date",
    measures=(
        Measure("customer_count", "count_distinct", "customer_key"),
        Measure("total_account_balance", "sum", "account_balance"),
    ),
    dimensions=(
        Dimension("customer_created_date", "time"), Dimension("market_segment"),
        Dimension("nation_name"), Dimension("region_name"),
    ),
    entities=(Entity("customer", "primary", "customer_key"),),
)

METRICS: dict[str, Metric] = {m.name: m for m in (
    Metric("total_net_revenue", "simple", "net_revenue"),
    Metric("total_gross_revenue", "simple", "gross_revenue"),
    Metric("total_discount_amount", "simple", "discount_amount"),
    Metric("total_orders", "simple", "order_count"),
    Metric("line_item_count", "simple", "line_item_count"),
    Metric("returned_item_count", "simple", "returned_item_count"),
    Metric("avg_order_value", "derived", inputs=("total_net_revenue", "total_orders"),
           compute=lambda m: ratio(m["total_net_revenue"], m["total_orders"])),
    Metric("discount_rate_pct", "derived", inputs=("total_discount_amount", "total_gross_revenue"),
           compute=lambda m: pct(m["total_discount_amount"], m["total_gross_revenue"])),
    Metric("return_rate", "derived", inputs=("returned_item_count", "line_item_count"),
           compute=lambda m: pct(m["returned_item_count"], m["line_item_count"])),
    Metric("avg_days_in_transit", "simple", "avg_days_in_transit"),
    Metric("customer_count", "simple", "customer_count"),
    Metric("avg_account_balance", "derived", inputs=("total_account_balance", "customer_count"),
           compute=lambda m: ratio(m["total_account_balance"], m["customer_count"])),
    Metric("total_account_balance", "simple", "total_account_balance"),
)}

MODELS: tuple[SemanticModel, ...] = (ORDER_ITEMS, CUSTOMERS)


class MetricQueryError(ValueError):
    pass


# ---------------------------------------------------------------------------
# Compilation
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class _GroupKey:
    alias: str             # output column name, the group_by string itself
    model: SemanticModel   # model holding the dimension
    via: Entity | None     # entity used to reach it (None = local)
    dim: Dimension
    grain: str | None


def _widen_sum(total: Column, df: DataFrame, measure: Measure) -> Column:
    """Sum result type: DECIMAL(38, scale) for decimals, BIGINT for integers."""
    dtype = df.select(F.expr(measure.expr).alias("x")).schema["x"].dataType
    if isinstance(dtype, DecimalType):
        return total.cast(f"decimal(38,{dtype.scale})")
    if isinstance(dtype, IntegralType):
        return total.cast("bigint")
    return total


def _aggregate(measure: Measure, df: DataFrame) -> Column:
    e = F.expr(measure.expr)
    if measure.agg == "count":
        out = F.count(e).cast("bigint")
    elif measure.agg == "count_distinct":
        out = F.countDistinct(e).cast("bigint")
    elif measure.agg == "average":
        out = mean(e)
    elif measure.agg in ("min", "max"):
        out = getattr(F, measure.agg)(e)
    else:  # sum: exact, widened to the oracle-stable result type
        out = _widen_sum(F.sum(e), df, measure)
    return out.alias(measure.name)


class SemanticLayer:
    """Semantic models bound to their mart DataFrames. ``dealt`` names, by mart and
    column, the same rows dealt by that column: distinct counts of it read these."""

    def __init__(self, marts: dict[str, DataFrame], models: Sequence[SemanticModel] = MODELS,
                 metrics: dict[str, Metric] | None = None, dealt: dict[tuple[str, str], DataFrame] | None = None):
        self.marts = marts
        self.dealt = dealt or {}
        self.models = tuple(models)
        self.metrics = dict(METRICS if metrics is None else metrics)

    # -- resolution -----------------------------------------------------
    def _owner(self, measure: str) -> SemanticModel:
        owners = [m for m in self.models if m.measure(measure)]
        if not owners:
            raise MetricQueryError(f"unknown measure {measure!r}")
        return owners[0]

    def _primary_model(self, entity: str) -> SemanticModel | None:
        return next((m for m in self.models if m.primary and m.primary.name == entity), None)

    def _measures_for(self, name: str) -> list[str]:
        metric = self.metrics.get(name)
        if metric is None:
            if any(m.measure(name) for m in self.models):  # MSR1: a bare measure
                return [name]
            raise MetricQueryError(f"unknown metric {name!r}")
        if metric.type == "simple":
            return [metric.measure]
        return [x for i in metric.inputs for x in self._measures_for(i)]

    def _resolve_group(self, spec: str, base: SemanticModel) -> _GroupKey:
        parts = spec.split("__")
        grain = None
        if len(parts) > 1 and parts[-1] in GRAINS:
            grain, parts = parts[-1], parts[:-1]
        if parts == ["metric_time"]:
            parts = [base.default_time]
        if len(parts) == 1:
            dim = base.dimension(parts[0])
            if dim is None:
                raise MetricQueryError(f"{spec!r}: {base.name} has no dimension {parts[0]!r}")
            return _GroupKey(spec, base, None, dim, grain)
        if len(parts) != 2:
            raise MetricQueryError(f"cannot parse group-by {spec!r}")
        entity_name, dim_name = parts
        ent = base.entity(entity_name)
        if ent is None:
            raise MetricQueryError(f"{spec!r}: entity {entity_name!r} not reachable from {base.name}")
        if ent.type in ("primary", "unique"):
            dim = base.dimension(dim_name)
            if dim is None:
                raise MetricQueryError(f"{spec!r}: {base.name} has no dimension {dim_name!r}")
            return _GroupKey(spec, base, None, dim, grain)
        target = self._primary_model(entity_name)
        if target is None or target.dimension(dim_name) is None:
            raise MetricQueryError(f"{spec!r}: no model with primary entity {entity_name!r} "
                                   f"and dimension {dim_name!r}")
        return _GroupKey(spec, target, ent, target.dimension(dim_name), grain)

    def _key_column(self, key: _GroupKey, prefix: str = "") -> Column:
        # a joined dimension is computed where it is read, see _reached
        col = F.expr(key.dim.expr) if key.dim.expr and not prefix else F.col(prefix + key.dim.name)
        if key.grain is not None or key.dim.type == "time":
            if key.dim.type != "time":
                raise MetricQueryError(f"{key.alias!r}: a grain needs a time dimension")
            col = time_grain(col, key.grain or "day")
        return col.alias(key.alias)

    def _mart(self, model: SemanticModel, measures: list[str]) -> DataFrame:
        distinct = [m.expr for m in map(model.measure, measures) if m.agg == "count_distinct"]
        return next((self.dealt[model.mart, e] for e in distinct if (model.mart, e) in self.dealt), self.marts[model.mart])

    def _aggregate_model(self, model: SemanticModel, measures: list[str], keys: list[_GroupKey],
                         where: str | Column | None) -> DataFrame:
        """Aggregate one model's measures by ``keys``.

        Dimensions reached through an entity need a join (J8: foreign -> primary,
        left, so unmatched facts group under NULL). Spark does not push an
        aggregate below a join, so we do: the fact is first pre-aggregated to
        (local keys, entity keys, count-distinct columns) with partial sums and
        counts, and only those rows meet the dimension; the raw fact rows are
        never shuffled for the join. The final aggregate merges the partials
        (sums of sums, sums of counts, distinct over the carried column), which
        is exact for every aggregation kind.

        A filter on dimensions reached through an entity is answered on the partials
        too, grouped by what it names; one that also names columns of the fact that
        are no dimensions is answered on the fact's rows.
        """
        named = self._named(where, model)
        late = any(k.via is not None for k in named.values())
        if late:
            try:
                return self._aggregate_rows(self._mart(model, measures), measures, keys, model, named, where)
            except AnalysisException:  # the filter needs more than the partials have
                pass
        fact = self._mart(model, measures)
        if where is not None:
            fact = self._filtered(fact, model, where)
        return self._aggregate_rows(fact, measures, keys, model)

    def _named(self, where: str | Column | None, model: SemanticModel) -> dict[str, _GroupKey]:
        """Names like ``entity__dim`` and ``dim__grain`` in a string filter."""
        if not isinstance(where, str):
            return {}
        bare = re.sub(r"'(?:[^']|'')*'", "''", where)
        return {n: self._resolve_group(n, model) for n in dict.fromkeys(re.findall(r"\b\w+?__\w+\b", bare))}

    def _aggregate_rows(self, fact: DataFrame, measures: list[str], keys: list[_GroupKey], model: SemanticModel,
                        named: dict[str, _GroupKey] | None = None, where: str | None = None) -> DataFrame:
        named = named or {}
        meas = [model.measure(x) for x in dict.fromkeys(measures)]
        joins: dict[str, tuple[Entity, SemanticModel, set[str]]] = {}
        for k in (*keys, *named.values()):
            if k.via is not None:
                joins.setdefault(k.via.name, (k.via, k.model, set()))[2].add(k.dim.name)
        if not joins:
            cols = [self._key_column(k) for k in keys]
            aggs = [_aggregate(m, fact) for m in meas]
            return fact.groupBy(*cols).agg(*aggs) if cols else fact.agg(*aggs)

        local = list({k.alias: self._key_column(k) for k in (*keys, *named.values()) if k.via is None}.values())
        ents = [F.expr(e.expr).alias(f"_ent_{name}") for name, (e, _, _) in joins.items()]
        dcols = [F.expr(m.expr).alias(f"_d_{m.name}") for m in meas if m.agg == "count_distinct"]
        partials = [F.count(F.lit(1)).alias("_rows")]
        for m in meas:
            e = F.expr(m.expr)
            if m.agg in ("sum", "average"):
                partials.append(F.sum(e).alias(f"_s_{m.name}"))
            if m.agg in ("count", "average"):
                partials.append(F.count(e).alias(f"_c_{m.name}"))
            if m.agg in ("min", "max"):
                partials.append(getattr(F, m.agg)(e).alias(f"_m_{m.name}"))
        pre = fact.groupBy(*local, *ents, *dcols).agg(*partials)

        for name, (_, target, dims) in joins.items():
            prefix = f"{name}__"
            pre = join_small(pre, self._reached(target, prefix, dims), F.col(f"_ent_{name}") == F.col(f"{prefix}key"),
                             "left")

        if named:
            wide = pre.withColumns({n: self._key_column(k, f"{k.via.name}__") for n, k in named.items() if k.via is not None})
            wide.select(*named).filter(where)  # refused if it names anything else
            pre = wide.filter(where)
        final_keys = [F.col(k.alias) if k.via is None else self._key_column(k, f"{k.via.name}__") for k in keys]
        aggs = []
        for m in meas:
            if m.agg == "sum":
                aggs.append(_widen_sum(F.sum(f"_s_{m.name}"), fact, m).alias(m.name))
            elif m.agg == "count":
                aggs.append(F.coalesce(F.sum(f"_c_{m.name}"), F.lit(0)).cast("bigint").alias(m.name))
            elif m.agg == "average":
                aggs.append(F.try_divide(F.sum(f"_s_{m.name}").cast("double"),
                                         F.sum(f"_c_{m.name}").cast("double")).alias(m.name))
            elif m.agg == "count_distinct":
                aggs.append(F.countDistinct(f"_d_{m.name}").cast("bigint").alias(m.name))
            else:
                aggs.append(getattr(F, m.agg)(f"_m_{m.name}").alias(m.name))
        return pre.groupBy(*final_keys).agg(*aggs)

    def _reached(self, target: SemanticModel, prefix: str, dims) -> DataFrame:
        """Key and dimensions of a model reached through an entity, under its prefix."""
        columns = [F.expr(target.dimension(w).expr or w).alias(prefix + w) for w in sorted(dims)]
        return self.marts[target.mart].select(F.col(target.primary.expr).alias(f"{prefix}key"), *columns)

    def _filtered(self, fact: DataFrame, model: SemanticModel, where: str | Column) -> DataFrame:
        """Rows of a model that pass ``where``. Names like ``entity__dim`` and
        ``dim__grain`` in a string mean what they mean as group keys. A filter that a
        model of the query cannot answer is an error, never ignored."""
        keys, wide = self._named(where, model), fact
        reached: dict[str, tuple[_GroupKey, set[str]]] = {}
        for k in keys.values():
            if k.via is not None:
                reached.setdefault(k.via.name, (k, set()))[1].add(k.dim.name)
        for name, (k, dims) in reached.items():
            prefix = f"_w_{name}__"
            wide = join_small(wide, self._reached(k.model, prefix, dims), F.expr(k.via.expr) == F.col(f"{prefix}key"), "left")
        for n, k in keys.items():
            wide = wide.withColumn(n, self._key_column(k, f"_w_{k.via.name}__" if k.via else ""))
        try:
            return wide.filter(where).select(*fact.columns)
        except AnalysisException as e:
            raise MetricQueryError(f"{model.name} cannot answer the filter {where!r}: {e.getCondition()}") from e

    # -- public -----------------------------------------------------------
    def query(self, metrics: Sequence[str], group_by: Sequence[str] = (), order: Sequence[str] = (),
              where: str | Column | None = None) -> DataFrame:
        """SEM3: ``metrics`` by ``group_by`` (``entity__dim``, ``dim__grain``), ordered
        by ``order`` (``-name`` = descending). ``where`` filters the measure rows."""
        if not metrics:
            raise MetricQueryError("no metrics requested")
        by_model: dict[str, tuple[SemanticModel, list[str]]] = {}
        for m in metrics:
            for meas in self._measures_for(m):
                owner = self._owner(meas)
                by_model.setdefault(owner.name, (owner, []))[1].append(meas)
        aliases = list(group_by)
        parts = []
        for model, measures in by_model.values():
            keys = [self._resolve_group(g, model) for g in group_by]
            parts.append(self._aggregate_model(model, measures, keys, where))
        result = reduce(lambda a, b: _null_safe_full_join(a, b, aliases), parts)
        values = {c: F.col(c) for c in result.columns}
        out = [F.col(a) for a in aliases]
        for m in metrics:
            metric = self.metrics.get(m)
            if metric is not None and metric.type == "derived":
                out.append(self._derived(metric, values).alias(m))
            elif metric is not None:
                out.append(F.col(metric.measure).alias(m))
            else:
                out.append(F.col(m))
        result = result.select(*out)
        if order:
            result = result.orderBy(*[F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in order])
        return result

    def _derived(self, metric: Metric, values: dict[str, Column]) -> Column:
        inputs = {}
        for i in metric.inputs:
            sub = self.metrics.get(i)
            if sub is None:
                inputs[i] = values[i]
            elif sub.type == "derived":
                inputs[i] = self._derived(sub, values)
            else:
                inputs[i] = values[sub.measure]
        return metric.compute(inputs)


def _null_safe_full_join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """SEM9: combine two model aggregates on their group keys, NULL matching NULL."""
    if not keys:  # two single-row global aggregates: pair them on a constant key
        return (a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one", "full")
                .drop("_one"))
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])
    rest = [c for c in b.columns if c not in keys]
    return a.join(b, cond, "full").select(*[F.coalesce(a[k], b[k]).alias(k) for k in keys],
                                          *[a[c] for c in a.columns if c not in keys], *[b[c] for c in rest])


def metric_query(marts: dict[str, DataFrame], metrics: Sequence[str], group_by: Sequence[str] = (),
                 order: Sequence[str] = (), where: str | Column | None = None,
                 models: Sequence[SemanticModel] = MODELS) -> DataFrame:
    return SemanticLayer(marts, models).query(metrics, group_by, order, where)
