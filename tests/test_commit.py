"""Atomic versions of the line fact, its key index, and the index of source files."""
import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import incremental as inc
from starmart.operators.manifest import ConcurrentCommit, Manifests
from starmart.sources.key_files import KeyFiles

DAY = dt.date(2020, 1, 1)


def lines(spark, pairs, v=1):
    """(order key, day) -> two lines each."""
    data = [(f"{k}-{n}", k, DAY + dt.timedelta(days=d), v) for k, d in pairs for n in (1, 2)]
    return spark.createDataFrame(data, "k string, order_key long, order_date date, v int")


def table(spark, path):
    got = inc.read_table(spark, path)
    return {} if got is None else {r.k: (str(r.order_date), r.v) for r in got.collect()}


def unrelated(n=600, seed=1):
    """Order keys that have nothing to do with their dates."""
    rng = random.Random(seed)
    keys = rng.sample(range(10 ** 6), n)
    return [(k, rng.randrange(360)) for k in keys]


def spoil(paths):
    """Make files unreadable, size and time unchanged."""
    for p in paths:
        st = os.stat(p)
        with open(p, "r+b") as f:
            f.write(b"x" * st.st_size)
        os.utime(p, ns=(st.st_atime_ns, st.st_mtime_ns))
        crc = os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_merge_reads_only_months_that_hold_an_incoming_key(spark, workdir):
    path, orders = f"{workdir}/t", unrelated()
    inc.full_refresh(spark, path, lines(spark, orders), "k", locate_by="order_key")
    newest = [(k, d) for k, d in orders if d >= 350]
    moved = next((k, d) for k, d in orders if 40 < d < 50)
    incoming = lines(spark, [*newest, (moved[0], 355)], 2)
    touched = {"order_month=2020-12-01", "order_month=2020-02-01"}
    others = [p for p in glob.glob(f"{path}/order_month=*/*/*.parquet") if p.split("/")[-3] not in touched]
    assert len(others) >= 9
    spoil(others)
    res = inc.merge_by_key(spark, path, incoming, "k", locate_by="order_key")
    assert {f"order_month={m}" for m in res.partitions_rewritten} == touched
    new = inc.read_table(spark, path, keep_partition_col=True).filter(F.col("order_month").isin([m for m in res.partitions_rewritten]))
    assert {r.k for r in new.filter("v = 2").collect()} == {f"{k}-{n}" for k, _ in [*newest, moved] for n in (1, 2)}
    assert not new.filter(f"order_key = {moved[0]} AND v = 1").count()


def test_index_follows_merges(spark, workdir):
    path, orders = f"{workdir}/t", unrelated(60)
    inc.full_refresh(spark, path, lines(spark, orders), "k")  # indexed on k; the first merge by order_key indexes that
    want = {f"{k}-{n}": (str(DAY + dt.timedelta(days=d)), 1) for k, d in orders for n in (1, 2)}
    rng = random.Random(3)
    for v in range(2, 6):
        batch = [(k, rng.randrange(360)) for k in rng.sample([k for k, _ in orders], 6)] + [(10 ** 7 + v, rng.randrange(360))]
        inc.merge_by_key(spark, path, lines(spark, batch, v), "k", locate_by="order_key")
        want |= {f"{k}-{n}": (str(DAY + dt.timedelta(days=d)), v) for k, d in batch for n in (1, 2)}
        assert table(spark, path) == want
    version = inc.Version.load(spark, path)
    assert version.index_on == "order_key" and os.listdir(f"{path}/_keys") == ["order_key"]
    index = spark.read.parquet(*[f"{path}/_keys/order_key/{f}" for f in version.folders()])
    assert index.count() == len(orders) + 4


@pytest.mark.parametrize("operation", ["merge", "refresh"])
@pytest.mark.parametrize("step", ["_write", "_write_index", "_commit", "_clean"])
def test_a_crash_leaves_one_version(spark, workdir, monkeypatch, step, operation):
    path = f"{workdir}/t"
    inc.full_refresh(spark, path, lines(spark, [(1, 10), (2, 40)]), "k", locate_by="order_key")
    old = table(spark, path)
    changes = lines(spark, [(1, 45), (3, 100)], 2)
    new = {k: v for k, v in old.items() if k[0] == "2"} if operation == "merge" else {}
    new |= {f"{k}-{n}": (str(DAY + dt.timedelta(days=d)), 2) for k, d in ((1, 45), (3, 100)) for n in (1, 2)}

    def run():
        if operation == "merge":
            inc.merge_by_key(spark, path, changes, "k", locate_by="order_key")
        else:
            inc.full_refresh(spark, path, changes, "k", locate_by="order_key")

    real = getattr(inc, step)

    def crash(*a, **b):
        if step != "_clean":
            real(*a, **b) if step != "_commit" else None
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(inc, step, crash)
        with pytest.raises(RuntimeError, match="crash"):
            run()
    assert table(spark, path) == (new if step == "_clean" else old)
    run()  # the rerun heals and leaves no folder behind
    assert table(spark, path) == new
    assert {p.split("commit=")[1] for p in glob.glob(f"{path}/order_month=*/commit=*")} == \
        {p.split("commit=")[1] for p in glob.glob(f"{path}/_keys/*/order_month=*/commit=*")} == \
        {c for cs in inc.Version.load(spark, path).months.values() for c in cs}


def test_a_torn_manifest_is_no_version(spark, workdir):
    path = f"{workdir}/t"
    inc.full_refresh(spark, path, lines(spark, [(1, 10)]), "k")
    with open(f"{path}/_manifests/.half", "w") as f:
        f.write('{"schema"')
    assert len(table(spark, path)) == 2
    with pytest.raises(ConcurrentCommit):
        Manifests(spark, path).commit(0, {})  # another writer was there first
    assert len(table(spark, path)) == 2


def test_retained_versions_stay_readable(spark, workdir):
    path = f"{workdir}/t"
    inc.full_refresh(spark, path, lines(spark, [(1, 10)]), "k")
    reader = inc.read_table(spark, path)
    inc.merge_by_key(spark, path, lines(spark, [(1, 11)], 2), "k", retain=1)
    assert [r.v for r in reader.collect()] == [1, 1] and {v for _, v in table(spark, path).values()} == {2}
    assert len(Manifests(spark, path).versions()) == 2


def test_wider_types_keep_old_files_readable(spark, workdir):
    path = f"{workdir}/t"
    schema = "k string, order_date date, i int, f float, d decimal(8,2)"
    inc.full_refresh(spark, path, spark.createDataFrame([("a", DAY, 1, 1.5, None), ("b", DAY + dt.timedelta(days=60), 2, 2.5, None)], schema), "k")
    old = glob.glob(f"{path}/order_month=2020-01-01/*/*.parquet")
    wide = spark.createDataFrame([("b", DAY + dt.timedelta(days=60), 2 ** 40, 1e300, None)], "k string, order_date date, i long, f double, d decimal(12,3)")
    inc.merge_by_key(spark, path, wide, "k", widen=True)
    got = inc.read_table(spark, path)
    assert [t for _, t in got.dtypes] == ["string", "date", "bigint", "double", "decimal(12,3)"]
    assert {(r.k, r.i, r.f) for r in got.collect()} == {("a", 1, 1.5), ("b", 2 ** 40, 1e300)}
    assert glob.glob(f"{path}/order_month=2020-01-01/*/*.parquet") == old
    with pytest.raises(ValueError, match="cannot hold"):
        inc.merge_by_key(spark, path, wide.withColumn("i", F.lit("x")), "k", widen=True)


# --------------------------------------------------------------- source files

def put(spark, source, name, keys):
    spark.createDataFrame([(k, n) for k in keys for n in (1, 2)], "l_orderkey long, l_linenumber int") \
        .coalesce(1).write.mode("append").parquet(f"{source}/{name}")


def files_of(paths):
    return sorted(p.split("/")[-2] for p in paths)


def test_only_files_with_wanted_keys_are_read(spark, workdir):
    source = f"{workdir}/lineitem.parquet"
    rng = random.Random(4)
    days = [rng.sample(range(10 ** 6), 50) for _ in range(6)]
    for i, keys in enumerate(days[:4]):
        put(spark, source, f"day{i}", keys)
    index = KeyFiles(spark, f"{source}/*", f"{workdir}/index", "l_orderkey")
    wanted = spark.createDataFrame([(k,) for k in (days[1][3], days[3][0], days[3][9], 5)], "order_key long")
    assert index.files() == 4 and len(index.holding(wanted)) == 4  # nothing indexed: all files
    assert index.refresh() == 4 and index.refresh() == 0
    spoil(glob.glob(f"{source}/day[02]/*.parquet"))
    assert files_of(index.holding(wanted, 4)) == ["day1", "day3"]
    assert index.read(wanted, 4).filter(F.col("l_orderkey").isin(days[3][0])).count() == 2
    put(spark, source, "day4", [days[1][3]])  # a late line, in a file of its own
    assert files_of(index.holding(wanted, 4)) == ["day1", "day3", "day4"]
    put(spark, source, "day5", days[5])
    assert files_of(index.holding(wanted, 4)) == ["day1", "day3", "day4", "day5"]  # not indexed yet
    assert index.refresh() == 2 and files_of(index.holding(wanted, 4)) == ["day1", "day3", "day4"]
    for p in glob.glob(f"{source}/day3/*"):
        os.remove(p)
    put(spark, source, "day3", [1])  # rewritten: what was indexed of it no longer counts
    index.refresh()
    assert files_of(index.holding(wanted, 4)) == ["day1", "day4"]
    assert index.read(spark.createDataFrame([(-1,)], "k long")).count() == 0


def test_build_reads_the_lines_of_changed_orders_only(spark, workdir, raw):
    from starmart.plans.build import build_all

    src, out = f"{workdir}/src", f"{workdir}/wh"
    for name, df in raw.items():
        (df.repartition(3, "l_orderkey") if name == "lineitem" else df).write.parquet(f"{src}/{name}.parquet")
    build_all(spark, src, out, run_ts="2024-01-01 00:00:00", run_checks=False)
    first = table_rows(spark, f"{out}/finance/line_fact")
    build_all(spark, src, out, run_ts="2024-01-02 00:00:00", run_checks=False)
    assert table_rows(spark, f"{out}/finance/line_fact") == first
    index = KeyFiles(spark, f"{src}/lineitem.parquet", f"{out}/state/line_files", "l_orderkey")
    assert index.files() > 1 and index.refresh() == 0


def table_rows(spark, path):
    return sorted(map(tuple, inc.read_table(spark, path).collect()), key=str)
