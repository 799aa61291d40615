import os

import pytest
from pyspark.sql import functions as F

from starmart.operators import marts, quality
from starmart.operators.colocated import Colocated, order_rollup_in_place
from starmart.plans.star import Star

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    s = Star(spark, SF, colocated=(str(tmp_path_factory.mktemp("by_order")), 4))
    s.store_by_order()
    return s


def equal(a, b):
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, was)


def test_marts_by_order_do_not_shuffle(spark, star, no_broadcast):
    plain = Star(spark, SF)
    checks = [(star.order_rollup, plain.order_rollup), (star.order_fact, plain.order_fact), (star.line_fact, plain.line_fact),
              (quality.check_revenue_reconciles(star.order_fact, star.line_fact), quality.check_revenue_reconciles(plain.order_fact, plain.line_fact)),
              (quality.check_orphaned_lines(star.line_fact, star.order_fact), quality.check_orphaned_lines(plain.line_fact, plain.order_fact))]  # broadcasts few keys
    for stored, other in checks:
        assert "Exchange hash" not in plan(stored) and "Exchange hash" in plan(other)
        equal(stored, other)


def test_one_read_of_the_lines(star):
    assert plan(star.order_rollup).count("FileScan") == 1


def test_null_keys_and_another_session(spark, workdir, no_broadcast):
    lines = Star(spark, SF).lines
    lines = lines.withColumn("order_key", F.when(F.col("order_key") % 7 != 0, F.col("order_key")))
    stored = Colocated(spark, f"{workdir}/lines", "order_key", 4)
    equal(order_rollup_in_place(stored.write(lines)), marts.order_rollup(lines))
    other = spark.newSession()
    spark.sql("DROP TABLE " + Colocated._name(next(f for f in os.listdir(f"{workdir}/lines") if f.startswith("rows-"))))
    again = Colocated(other, f"{workdir}/lines", "order_key", 4).read()
    assert "Exchange" not in plan(again.groupBy("order_key").count()) and again.count() == lines.count()


def test_a_hot_key_is_read_as_plain_files(spark, workdir, no_broadcast):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("order_key"), "id")
    stored = Colocated(spark, f"{workdir}/t", "order_key", 32)
    got = stored.write(rows)
    assert not stored.even and "Exchange" in plan(got.groupBy("order_key").count())
    assert got.count() == 6000


def test_a_new_write_replaces_the_table(spark, workdir):
    stored = Colocated(spark, f"{workdir}/t", "k", 2)
    assert stored.read() is None
    stored.write(spark.range(10).toDF("k"))
    assert stored.write(spark.range(3).toDF("k")).count() == 3
    assert len([f for f in os.listdir(f"{workdir}/t") if f.startswith("rows-")]) == 1
    assert stored.write(spark.range(0).toDF("k")).count() == 0


def test_reading_before_storing_is_an_error(spark, workdir):
    with pytest.raises(ValueError, match="store_by_order"):
        Star(spark, SF, colocated=(workdir, 2)).orders
