import datetime as dt
from decimal import Decimal as D

import pytest

from starmart.operators import marts
from starmart.plans.metrics import MetricQueryError, SemanticLayer


@pytest.fixture
def layer(staged):
    lf = marts.line_fact(staged["lineitem"], staged["orders"])
    cd = marts.customer_dim(staged["customer"], staged["nation"], staged["region"])
    return SemanticLayer({"line_fact": lf, "customer_dim": cd})


def test_simple_and_derived(layer):
    r = layer.query(["total_net_revenue", "total_orders", "avg_order_value", "line_item_count",
                     "returned_item_count", "return_rate", "discount_rate_pct"]).collect()[0]
    assert r.total_net_revenue == D("29.55") and r.total_orders == 2 and r.line_item_count == 3
    assert r.avg_order_value == pytest.approx(29.55 / 2)
    assert r.return_rate == pytest.approx(100 / 3)
    assert r.discount_rate_pct == pytest.approx(0.51 / 30.05 * 100)


def test_entity_dimension_and_order(layer):
    rows = layer.query(["total_net_revenue"], ["customer__market_segment"], ["-total_net_revenue"]).collect()
    assert [(r.customer__market_segment, r.total_net_revenue) for r in rows] == \
        [("MACHINERY", D("20.00")), ("BUILDING", D("9.55"))]


def test_time_grain(layer):
    rows = layer.query(["line_item_count"], ["order_date__month", "ship_date__week"]).collect()
    got = {(r.order_date__month, r.ship_date__week): r.line_item_count for r in rows}
    # ship dates 1996-01-03 (Wed) and 1996-01-06 (Sat) both fall in the week of Monday 1996-01-01
    assert got == {(dt.date(1996, 1, 1), dt.date(1996, 1, 1)): 3}


def test_metric_time_alias(layer):
    rows = layer.query(["total_orders"], ["metric_time__year"]).collect()
    assert [(r.metric_time__year, r.total_orders) for r in rows] == [(dt.date(1996, 1, 1), 2)]


def test_bare_measures(layer):
    r = layer.query(["quantity", "avg_discount_rate"]).collect()[0]
    assert r.quantity == D("8.00") and r.avg_discount_rate == pytest.approx(0.05)


def test_null_group_key_from_unmatched_dimension(layer):
    rows = layer.query(["line_item_count"], ["customer__region_name"]).collect()
    assert {r.customer__region_name: r.line_item_count for r in rows} == {"EUROPE": 2, None: 1}


def test_cross_model_null_safe(layer):
    rows = layer.query(["total_net_revenue", "customer_count", "avg_account_balance"],
                       ["customer__region_name"]).collect()
    got = {r.customer__region_name: (r.total_net_revenue, r.customer_count) for r in rows}
    assert got == {"EUROPE": (D("9.55"), 1), None: (D("20.00"), 1)}


def test_customer_model_alone(layer):
    r = layer.query(["customer_count", "total_account_balance", "avg_account_balance"]).collect()[0]
    assert r.customer_count == 2 and r.total_account_balance == D("706.56")
    assert r.avg_account_balance == pytest.approx(353.28)


def test_errors(layer):
    with pytest.raises(MetricQueryError):
        layer.query(["nope"])
    with pytest.raises(MetricQueryError):
        layer.query(["total_orders"], ["customer__nope"])
    with pytest.raises(MetricQueryError):  # categorical dims have no grain
        layer.query(["total_orders"], ["order_status__month"])
    with pytest.raises(MetricQueryError):  # customers model cannot reach line-item dimensions
        layer.query(["customer_count"], ["order_status"])


def test_where_filter_and_ascending_order(layer):
    rows = layer.query(["line_item_count", "total_net_revenue"], ["return_flag"], ["return_flag"],
                       where="order_status = 'F'").collect()
    assert [(r.return_flag, r.line_item_count) for r in rows] == [(None, 1), ("R", 1)]
    rows = layer.query(["line_item_count"], ["customer__market_segment"], ["customer__market_segment"],
                       where="is_returned").collect()
    assert [(r.customer__market_segment, r.line_item_count) for r in rows] == [("BUILDING", 1)]


def test_preaggregated_join_matches_direct_aggregation(layer, staged):
    """The pre-aggregated entity join equals aggregating the joined rows directly."""
    from pyspark.sql import functions as F
    lf = marts.line_fact(staged["lineitem"], staged["orders"])
    cd = marts.customer_dim(staged["customer"], staged["nation"], staged["region"])
    direct = (lf.join(cd.select("customer_key", "market_segment"), "customer_key", "left")
              .groupBy(F.col("market_segment").alias("customer__market_segment"),
                       F.date_trunc("month", "ship_date").cast("date").alias("ship_date__month"))
              .agg(F.sum("quantity").cast("decimal(38,2)").alias("quantity"),
                   F.countDistinct("order_key").alias("total_orders"),
                   (F.sum("discount_rate").cast("double") / F.count("discount_rate")).alias("avg_discount_rate")))
    got = layer.query(["quantity", "total_orders", "avg_discount_rate"],
                      ["customer__market_segment", "ship_date__month"])
    cols = ["customer__market_segment", "ship_date__month", "quantity", "total_orders", "avg_discount_rate"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, direct.select(*cols).collect()))


def test_where_reaches_through_an_entity(layer):
    all_rows = {r.customer__region_name: r.line_item_count for r in
                layer.query(["line_item_count"], ["customer__region_name"]).collect()}
    for region, n in all_rows.items():
        if region is not None:
            got = layer.query(["line_item_count"], [], where=f"customer__region_name = '{region}' AND 'a__b' = 'a__b'").first()
            assert got.line_item_count == n


def test_where_that_a_model_cannot_answer_is_an_error(layer):
    with pytest.raises(MetricQueryError, match="cannot answer"):
        layer.query(["total_net_revenue", "customer_count"], ["customer__market_segment"], where="return_flag = 'R'")


def test_a_filter_on_a_reached_dimension_is_answered_on_partials(spark, layer):
    """The fact's rows meet no dimension: they are grouped before any join or shuffle."""
    key, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        where = "customer__region_name IN ('EUROPE', 'ASIA') AND order_date__year >= DATE '1990-01-01'"
        late = layer.query(["line_item_count", "total_orders"], ["customer__market_segment"], where=where)
        plan = late._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joins = [i for i, x in enumerate(plan) if "Join" in x]
        groups = [i for i, x in enumerate(plan) if "Aggregate" in x and "count(1)" in x]
        assert joins and max(groups) > min(joins)  # an aggregate below the first join
        on_rows = layer.query(["line_item_count", "total_orders"], ["customer__market_segment"], where=where + " AND (is_returned OR NOT is_returned)")
        assert sorted(map(tuple, late.collect()), key=str) == sorted(map(tuple, on_rows.collect()), key=str)
    finally:
        spark.conf.set(key, was)
    none = layer.query(["line_item_count", "total_orders"], [], where="customer__region_name = 'NOWHERE'").first()
    assert tuple(none) == (0, 0)


def test_distinct_orders_are_counted_in_as_many_tasks_as_the_lines_need(spark, raw, tmp_path, monkeypatch):
    from starmart.plans import joins, registry

    for t, df in raw.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    names = ("metrics_by_order_priority", "metrics_by_day", "metrics_by_year_segment_region", "metrics_by_month")
    want = {n: registry.QUERIES[n](spark, str(tmp_path)).collect() for n in names}
    monkeypatch.setattr(joins, "WHOLE_BYTES", 0)
    monkeypatch.setattr(joins, "TASK_BYTES", 300)
    for n in names:
        got = registry.QUERIES[n](spark, str(tmp_path))
        assert ("REPARTITION_BY_NUM" in plan(got)) == (n != "metrics_by_month")  # no distinct count: as it was
        assert sorted(map(str, got.collect())) == sorted(map(str, want[n])) and want[n]
