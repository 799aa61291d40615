import datetime as dt
import hashlib

from starmart.operators import marts
from starmart.operators.calendar import calendar, densify
from starmart.functions import surrogate_key
from pyspark.sql import functions as F


def test_customer_dim_keeps_unknown_geography(staged):
    dim = marts.customer_dim(staged["customer"], staged["nation"], staged["region"])
    rows = {r.customer_key: r for r in dim.collect()}
    assert rows[10].nation_name == "FRANCE" and rows[10].region_name == "EUROPE" and rows[10].region_key == 0
    assert rows[11].nation_name is None and rows[11].region_name is None
    assert rows[10].customer_created_date == dt.date(1992, 1, 1)
    assert len(dim.columns) == 11


def test_supplier_and_part_dims(staged):
    s = marts.supplier_dim(staged["supplier"], staged["nation"], staged["region"])
    assert {r.supplier_key: r.region_name for r in s.collect()} == {1000: "EUROPE", 1001: "ASIA"}
    p = marts.part_dim(staged["part"])
    assert "comment" not in p.columns and len(p.columns) == 11


def test_rollup_and_order_fact(staged):
    rollup = marts.order_rollup(staged["lineitem"])
    r = {x.order_key: x for x in rollup.collect()}
    assert r[1].line_item_count == 2 and r[1].distinct_part_count == 2 and r[1].distinct_supplier_count == 1
    assert str(r[1].net_revenue) == "9.55" and r[1].returned_item_count == 1 and r[1].has_any_return == 1
    assert str(r[1].total_tax_amount) == "0.950000"
    assert r[1].avg_days_in_transit == 5.0  # NULL transit ignored
    fact = {x.order_key: x for x in marts.order_fact(staged["orders"], rollup).collect()}
    assert set(fact) == {1, 2, 3}
    assert fact[3].line_item_count is None and fact[3].net_revenue is None  # order without lines kept
    assert fact[1].order_total_price is not None


def test_line_fact_drops_orphans_and_keys(staged):
    lf = marts.line_fact(staged["lineitem"], staged["orders"])
    rows = lf.collect()
    assert {(r.order_key, r.line_number) for r in rows} == {(1, 1), (1, 2), (2, 1)}
    k = {(r.order_key, r.line_number): r.order_item_key for r in rows}
    assert k[(1, 1)] == hashlib.md5(b"1-1").hexdigest()
    assert tuple(lf.columns) == marts.LINE_FACT_COLUMNS


def test_line_fact_since_filters(staged):
    lf = marts.line_fact(staged["lineitem"], staged["orders"], since="1996-01-05")
    assert {r.order_key for r in lf.collect()} == {2}


def test_surrogate_key_null_differs_from_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "a string")
    ks = [r.k for r in df.select(surrogate_key("a").alias("k")).collect()]
    assert ks[0] != ks[1]


def test_calendar(spark):
    cal = calendar(spark)
    assert cal.count() == 14975
    r = {x.date_day: x for x in cal.filter("date_day between '2024-06-15' and '2024-06-17'").collect()}
    sat, sun, mon = r[dt.date(2024, 6, 15)], r[dt.date(2024, 6, 16)], r[dt.date(2024, 6, 17)]
    assert (sat.day_of_week, sun.day_of_week, mon.day_of_week) == (6, 0, 1)
    assert sat.is_weekend and sun.is_weekend and not mon.is_weekend
    assert sun.week_start == dt.date(2024, 6, 10) and mon.week_start == dt.date(2024, 6, 17)
    assert sat.quarter == 2 and sat.quarter_start == dt.date(2024, 4, 1) and sat.week == 24
    mn, mx = cal.agg(F.min("date_day"), F.max("date_day")).first()
    assert (mn, mx) == (dt.date(1990, 1, 1), dt.date(2030, 12, 31))


def test_densify_fills_missing_days(spark):
    agg = spark.createDataFrame([(dt.date(2020, 1, 1), 5), (dt.date(2020, 1, 3), 7)], "d date, n bigint")
    out = densify(agg, calendar(spark), "d", {"n": 0}, "2020-01-01", "2020-01-04").orderBy("date_day").collect()
    assert [r.n for r in out] == [5, 0, 7, 0]


def test_line_fact_changes_broadcasts_counted_recent_orders(staged):
    ch = marts.line_fact_changes(staged["lineitem"], staged["orders"], "1996-01-05")
    assert {r.order_key for r in ch.collect()} == {2}
    assert "BroadcastHashJoin" in ch._jdf.queryExecution().executedPlan().toString()
    over = marts.line_fact_changes(staged["lineitem"], staged["orders"], "1996-01-05", max_broadcast_bytes=0)
    assert {r.order_key for r in over.collect()} == {2}
    full = marts.line_fact_changes(staged["lineitem"], staged["orders"], None)
    assert full.count() == 3


def test_rollup_counts_lines_without_an_order_key(spark, staged):
    lines = staged["lineitem"]
    undated = lines.withColumn("order_key", F.when(F.col("order_key") != 1, F.col("order_key")))
    out = marts.order_rollup(lines.unionByName(undated))
    none = [r for r in out.collect() if r.order_key is None]
    assert len(none) == 1 and (none[0].line_item_count, none[0].distinct_part_count, none[0].distinct_supplier_count) == (2, 2, 1)
    plan = marts.order_rollup(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 5  # three on the order, two on its pairs: none for the joins
