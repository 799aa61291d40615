import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import incremental as inc
from starmart.plans.rollup import DistinctRollup

SCHEMA = "k string, order_key long, customer_key long, order_date date, flag string, net_revenue decimal(12,2)"
EDGE = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2 ** 40, None]


def facts(spark, n=500, seed=1):
    rng = random.Random(seed)
    rows = [(f"r{i}", rng.choice([*EDGE, rng.randrange(10 ** 6)]), rng.randrange(30), dt.date(2023, 11, 1) + dt.timedelta(days=rng.randrange(200))
             if i % 50 else None, rng.choice(["A", "R", None]), Decimal(i)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def dim(spark):
    return spark.createDataFrame([(k, f"S{k % 4}") for k in range(25)], "customer_key long, segment string")


def rollup(spark, path):
    return DistinctRollup(spark, path, ["flag", "segment"], ["order_key", "customer_key"], ["net_revenue"], dim(spark), "customer_key")


def same(spark, r, fact, by, where=None):
    wide = fact.join(dim(spark), "customer_key", "left")
    grains = {c: F.date_trunc(c, "order_date").cast("date").alias(c) for c in ("month", "quarter", "year")}
    wide = wide if where is None else wide.filter(where)
    want = wide.groupBy(*[grains.get(c, F.col(c)) for c in by]).agg(
        F.count("*"), F.sum("net_revenue").cast("decimal(38,2)"), F.countDistinct("order_key"), F.countDistinct("customer_key"))
    got = r.query(by, where)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("by", [[], ["month"], ["year"], ["quarter", "flag"], ["segment"], ["month", "flag", "segment"]])
def test_every_grain_is_exact(spark, tmp_path_factory, by):
    path = str(tmp_path_factory.getbasetemp() / "rollup-grains")
    r = rollup(spark, path)
    if r.table() is None:
        r.build(facts(spark))
    same(spark, r, facts(spark), by)


def test_filters_and_unknown_groups(spark, workdir):
    r = rollup(spark, f"{workdir}/r")
    with pytest.raises(ValueError, match="no rollup"):
        r.query()
    r.build(facts(spark, 200))
    same(spark, r, facts(spark, 200), ["year"], F.col("flag") == "A")
    with pytest.raises(ValueError, match="colour"):
        r.query(["colour"])


def test_refresh_follows_a_merge(spark, workdir):
    path, r = f"{workdir}/t", rollup(spark, f"{workdir}/r")
    inc.full_refresh(spark, path, facts(spark, 200), "k")
    r.build(inc.read_table(spark, path))
    before = {f for f in inc.Version.load(spark, r.path).folders()}
    moved = facts(spark, 4, seed=2).withColumn("order_date", F.lit(dt.date(2024, 1, 5)))
    res = inc.merge_by_key(spark, path, moved, "k")
    stored = inc.read_table(spark, path, keep_partition_col=True)
    r.refresh(stored, res.partitions_rewritten)
    for by in ([], ["month"], ["segment"]):
        same(spark, r, inc.read_table(spark, path), by)
    after = inc.Version.load(spark, r.path).folders()
    touched = {"order_month=" + (inc.NO_PARTITION if m is None else m.isoformat()) for m in res.partitions_rewritten}
    assert {f for f in before if f.split("/")[0] not in touched} <= set(after) and len(touched) < len(after)


def test_an_empty_fact(spark, workdir):
    r = rollup(spark, f"{workdir}/r")
    r.build(facts(spark).limit(0))
    with pytest.raises(ValueError, match="no rollup"):
        r.query()
