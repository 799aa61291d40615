import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import incremental as inc
from starmart.operators.quality import check_unique_combination
from starmart.operators.unique import UniqueKeys

SCHEMA = "k string, order_date date, a long, b string"


def rows(spark, n, seed, start=0):
    rng = random.Random(seed)
    data = [(f"r{start + i}", dt.date(2023, 12, 1) + dt.timedelta(days=rng.randrange(150)) if i % 40 else None,
             rng.randrange(60) if i % 11 else None, rng.choice(["x", "y", None])) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def pairs(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("keys,nulls", [(["a", "b"], True), (["a"], False)])
def test_equals_the_full_check_after_every_merge(spark, workdir, keys, nulls):
    path, known = f"{workdir}/t", UniqueKeys(spark, f"{workdir}/u", keys, nulls)
    inc.full_refresh(spark, path, rows(spark, 90, 1), "k")
    stored = inc.read_table(spark, path, keep_partition_col=True)
    known.build(stored)
    for batch in range(3):
        changes = rows(spark, 8, batch + 5, start=batch * 20).filter("order_date IS NULL OR order_date < DATE '2024-02-01'")
        res = inc.merge_by_key(spark, path, changes, "k")
        stored = inc.read_table(spark, path, keep_partition_col=True)
        known.refresh(stored, res.partitions_rewritten)
        full = stored if nulls else stored.filter(" AND ".join(f"{c} IS NOT NULL" for c in keys))
        assert pairs(known.duplicates(stored)) == pairs(check_unique_combination(full, keys))
        here = full.filter(UniqueKeys._in(res.partitions_rewritten)).select(keys).distinct()
        cond = [full[c].eqNullSafe(here[c]) for c in keys]
        assert pairs(known.duplicates(stored, res.partitions_rewritten)) == pairs(check_unique_combination(full.join(here, cond, "left_semi"), keys))


def test_a_refresh_reads_the_rewritten_months_only(spark, workdir):
    path, known = f"{workdir}/t", UniqueKeys(spark, f"{workdir}/u", ["k"])
    inc.full_refresh(spark, path, rows(spark, 60, 1).filter("order_date IS NOT NULL"), "k")
    known.build(inc.read_table(spark, path, keep_partition_col=True))
    new = spark.createDataFrame([("new", dt.date(2024, 1, 5), 1, "x")], SCHEMA)
    res = inc.merge_by_key(spark, path, new, "k")
    assert res.partitions_rewritten == [dt.date(2024, 1, 1)]
    for p in glob.glob(f"{path}/order_month=*/*/*.parquet"):
        if "order_month=2024-01-01" not in p:
            with open(p, "r+b") as f:
                f.write(b"x" * os.path.getsize(p))
    stored = inc.read_table(spark, path, keep_partition_col=True)
    known.refresh(stored, res.partitions_rewritten)
    assert known.duplicates(stored).count() == 0  # no suspect: no file of the table is opened


def test_equal_digests_of_different_keys(spark, workdir, monkeypatch):
    known = UniqueKeys(spark, f"{workdir}/u", ["a"])
    monkeypatch.setattr(UniqueKeys, "_keyed", lambda self, t: t.withColumn("digest", F.lit(7).cast("long")))
    table = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))], "a long, order_month date")
    known.build(table)
    assert pairs(known.duplicates(table)) == [(2, 2)]


def test_a_null_differs_from_nothing_else(spark, workdir):
    known = UniqueKeys(spark, f"{workdir}/u", ["a", "b"])
    table = spark.createDataFrame([(None, "x"), (None, "x"), (42, None), (None, None)], "a long, b string") \
        .withColumn("order_month", F.lit(dt.date(2024, 1, 1)))
    known.build(table)
    assert pairs(known.duplicates(table)) == [(None, "x", 2)]
    empty = UniqueKeys(spark, f"{workdir}/e", ["a"])
    empty.build(table.limit(0))
    assert empty.duplicates(table.limit(0)).count() == 0
