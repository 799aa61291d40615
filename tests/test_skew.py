"""A key holding a third of the rows: joins split it (AQE skew join) and the
ordered operations keep working in bounded window partitions."""

from pyspark.sql import functions as F

from starmart.operators import history, marts
from starmart.functions.ordered import ordered_neighbors

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_customer_as_of_join_is_split(spark):
    old = _with_conf(spark, SKEW_CONF)
    try:
        n = 30000
        # customer 0 places a third of all orders
        facts = spark.range(n).select(F.col("id").alias("order_key"),
                                      F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
                                      .cast("bigint").alias("customer_key"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int"))
                                      .alias("order_date"))
        feed = spark.range(0, 998).select(F.col("id").alias("customer_key"), F.lit("n").alias("customer_name"),
                                          F.lit("BUILDING").alias("market_segment"),
                                          F.lit(1).cast("decimal(12,2)").alias("account_balance"),
                                          F.lit(None).cast("string").alias("phone"),
                                          F.lit(None).cast("string").alias("address"),
                                          F.lit(1).alias("nation_key"))
        state = history.apply_scd2(None, feed, "2024-01-01 00:00:00")
        feed2 = feed.withColumn("market_segment", F.lit("MACHINERY"))
        hist = history.customer_history(history.apply_scd2(state, feed2, "2024-06-01 00:00:00"))
        out = history.as_of_join(facts, hist.repartition(8), columns=["market_segment"])
        got = {r.market_segment: r.n for r in out.groupBy("market_segment").agg(F.count("*").alias("n")).collect()}
        assert sum(got.values()) == n and set(got) == {"BUILDING", "MACHINERY"}
        out.collect()  # runs the DataFrame's own plan, so its final adaptive plan is inspectable
        assert "skew=true" in _final_plan(out)
    finally:
        _restore(spark, old)


def test_hot_order_line_fact_is_split(spark):
    old = _with_conf(spark, SKEW_CONF)
    try:
        lines = spark.range(20000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).cast("bigint").alias("order_key"),
            F.col("id").cast("int").alias("line_number"), F.lit(1).cast("bigint").alias("part_key"),
            F.lit(1).cast("bigint").alias("supplier_key"), *[F.lit(None).cast(t).alias(c) for c, t in (
                ("return_flag", "string"), ("line_status", "string"), ("ship_mode", "string"),
                ("ship_instructions", "string"), ("quantity", "decimal(12,2)"), ("extended_price", "decimal(12,2)"),
                ("discount_rate", "decimal(5,4)"), ("discount_amount", "decimal(12,2)"), ("tax_rate", "decimal(5,4)"),
                ("net_revenue", "decimal(12,2)"), ("ship_date", "date"), ("commit_date", "date"),
                ("receipt_date", "date"), ("days_in_transit", "int"), ("is_returned", "boolean"))])
        orders = spark.range(0, 501).select(F.col("id").alias("order_key"), F.lit(7).cast("bigint").alias("customer_key"),
                                            F.lit("2024-01-01").cast("date").alias("order_date"),
                                            F.lit("O").alias("order_status"), F.lit("1-URGENT").alias("order_priority"))
        lf = marts.line_fact(lines, orders)
        lf.collect()
        assert "skew=true" in _final_plan(lf)
        assert lf.count() == 20000
    finally:
        _restore(spark, old)


def test_hot_key_window_partitions_are_bounded(spark):
    # 3 years of daily versions for one key: no window partition holds more than a month
    df = spark.range(1100).select(F.lit(1).alias("k"),
                                  F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("t"),
                                  F.col("id").alias("v"))
    out = ordered_neighbors(df, "k", "t", lag_cols=["v"], row_number=True)
    assert out.agg(F.max("_rn")).first()[0] == 1100
    assert out.filter(F.col("_prev_v") != F.col("v") - 1).count() == 0


def test_segment_changes_gather_a_key_by_month_only(spark):
    """A hot key with a version a day: the window over the whole key sees one row a month."""
    from starmart.plans import reports

    hist = spark.range(1500).select(F.lit(1).cast("bigint").alias("customer_key"),
                                    F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz").alias("valid_from"),
                                    F.concat(F.lit("S"), F.col("id").cast("string")).alias("market_segment"))
    out = reports.segment_changes(hist)
    assert out.count() == 1499
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("date_trunc" in plan and "month" in plan for _ in windows)
    months = hist.select(F.date_trunc("month", "valid_from")).distinct().count()
    assert months == 50 and hist.groupBy(F.date_trunc("month", "valid_from")).count().agg(F.max("count")).first()[0] == 31
