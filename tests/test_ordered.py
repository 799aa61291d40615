from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.functions.ordered import ordered_neighbors, pick_first


def _data(spark):
    # key 0 is hot (one row per day for ~3 years); keys 1..49 have a few rows each
    hot = spark.range(0, 1100).select(F.lit(0).cast("bigint").alias("k"),
                                      F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("t"),
                                      (F.col("id") % 7).alias("v"))
    cold = spark.range(0, 400).select((F.col("id") % 49 + 1).alias("k"),
                                      F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 13).cast("int"))
                                      .alias("t"), (F.col("id") % 3).alias("v"))
    return hot.unionByName(cold)


def test_two_level_equals_plain_window(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("t")
    plain = df.select("k", "t", F.lag("v").over(w).alias("p"), F.lead("t").over(w).alias("n"),
                      F.row_number().over(w).cast("bigint").alias("rn"))
    two = ordered_neighbors(df, "k", "t", lag_cols=["v"], lead_t=True, row_number=True) \
        .select("k", "t", F.col("_prev_v").alias("p"), F.col("_next_t").alias("n"), F.col("_rn").alias("rn"))
    assert plain.exceptAll(two).count() == 0 and two.exceptAll(plain).count() == 0


def test_pick_first_is_total_and_aggregate(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (1, 1, "z"), (2, None, "x"), (2, 0, "y")],
                               "k int, o int, s string")
    got = {r.k: (r.o, r.s) for r in pick_first(df, ["k"], []).collect()}
    assert got == {1: (1, "z"), 2: (None, "x")}  # NULL sorts first
    got = {r.k: (r.o, r.s) for r in pick_first(df, ["k"], [F.coalesce(-F.col("o"), F.lit(99))]).collect()}
    assert got == {1: (2, "a"), 2: (0, "y")}
    plan = pick_first(df, ["k"], [])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_two_level_property(spark):
    """Random keys / distinct dates per key: bucketed lag/lead/row_number equal
    the plain window."""
    import datetime as dt

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 800), st.integers(-5, 5) | st.none()),
                       min_size=1, max_size=60)

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows_st)
    def check(rows):
        seen, data = set(), []
        for k, day, v in rows:
            if (k, day) not in seen:  # t unique within a key
                seen.add((k, day))
                data.append((k, dt.date(2020, 1, 1) + dt.timedelta(days=day), v))
        df = spark.createDataFrame(data, "k int, t date, v int")
        w = Window.partitionBy("k").orderBy("t")
        plain = df.select("k", "t", F.lag("v").over(w).alias("p"), F.lead("t").over(w).alias("n"),
                          F.row_number().over(w).cast("bigint").alias("rn"))
        two = ordered_neighbors(df, "k", "t", lag_cols=["v"], lead_t=True, row_number=True) \
            .select("k", "t", F.col("_prev_v").alias("p"), F.col("_next_t").alias("n"), F.col("_rn").alias("rn"))
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)

    check()
