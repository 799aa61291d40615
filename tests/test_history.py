import datetime as dt
import os
from decimal import Decimal as D

import pytest

from starmart.operators import history as h
from starmart.operators.quality import check_one_current

FEED = ("customer_key bigint, customer_name string, market_segment string, account_balance decimal(12,2), "
        "phone string, address string, nation_key int")


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED)


A = [(1, "C1", "BUILDING", D("1.00"), "p1", "a1", 1),
     (2, "C2", "MACHINERY", D("2.00"), None, "a2", 2),
     (3, "C3", "HOUSEHOLD", D("3.00"), "p3", "a3", 3),
     (4, "C4", "FURNITURE", D("4.00"), "p4", "a4", 4)]
# B: 1 changes segment, 2 NULL -> value, 3 unchanged, 4 deleted, 5 new
B = [(1, "C1", "AUTOMOBILE", D("1.00"), "p1", "a1", 1),
     (2, "C2", "MACHINERY", D("2.00"), "p2", "a2", 2),
     (3, "C3", "HOUSEHOLD", D("3.00"), "p3", "a3", 3),
     (5, "C5", "BUILDING", D("5.00"), "p5", "a5", 5)]
T1, T2, T3 = "2024-01-01 00:00:00", "2024-06-15 00:00:00", "2024-09-01 00:00:00"


def versions(state):
    return sorted((r.customer_key, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.market_segment)
                  for r in state.collect())


def test_apply_runs(spark):
    s1 = h.apply_scd2(None, feed(spark, A), T1)
    assert len(versions(s1)) == 4 and all(v[2] is None for v in versions(s1))
    s2 = h.apply_scd2(s1, feed(spark, B), T2)
    v = versions(s2)
    assert (1, "2024-01-01 00:00:00", "2024-06-15 00:00:00", "BUILDING") in v
    assert (1, "2024-06-15 00:00:00", None, "AUTOMOBILE") in v
    assert [x for x in v if x[0] == 2][0][2] == "2024-06-15 00:00:00"  # NULL -> value is a change
    assert [x for x in v if x[0] == 3] == [(3, "2024-01-01 00:00:00", None, "HOUSEHOLD")]
    assert [x for x in v if x[0] == 4] == [(4, "2024-01-01 00:00:00", "2024-06-15 00:00:00", "FURNITURE")]
    assert [x for x in v if x[0] == 5] == [(5, "2024-06-15 00:00:00", None, "BUILDING")]
    # rerun with the same feed changes nothing
    assert versions(h.apply_scd2(s2, feed(spark, B), T3)) == v
    # deleted key reappears -> new version
    s3 = h.apply_scd2(s2, feed(spark, B + [A[3]]), T3)
    assert (4, "2024-09-01 00:00:00", None, "FURNITURE") in versions(s3)
    # keep_missing mode leaves absent keys open
    s_keep = h.apply_scd2(s1, feed(spark, B), T2, close_missing=False)
    assert [x for x in versions(s_keep) if x[0] == 4][0][2] is None


def test_history_view_and_as_of(spark):
    s2 = h.apply_scd2(h.apply_scd2(None, feed(spark, A), T1), feed(spark, B), T2)
    hist = h.customer_history(s2)
    assert hist.columns == ["customer_history_key", "customer_key", "customer_name", "market_segment",
                            "account_balance", "phone", "address", "nation_key", "valid_from", "valid_to",
                            "valid_to_or_max", "is_current"]
    assert hist.filter("customer_key = 1 and is_current").collect()[0].market_segment == "AUTOMOBILE"
    assert str(hist.filter("customer_key = 3").collect()[0].valid_to_or_max) == "9999-12-31 00:00:00"
    # half-open: valid_from is in, valid_to is out
    at_change = {r.customer_key: r.market_segment for r in h.as_of(hist, "2024-06-15").collect()}
    assert at_change[1] == "AUTOMOBILE" and 4 not in at_change
    before = {r.customer_key: r.market_segment for r in h.as_of(hist, "2024-06-14").collect()}
    assert before[1] == "BUILDING" and before[4] == "FURNITURE" and 5 not in before
    # the deleted key leaves no current version: DQ10 reports it
    assert [r.customer_key for r in check_one_current(hist).collect()] == [4]
    assert hist.select("customer_history_key").distinct().count() == hist.count()


def test_as_of_join(spark):
    hist = h.customer_history(h.apply_scd2(h.apply_scd2(None, feed(spark, A), T1), feed(spark, B), T2))
    facts = spark.createDataFrame([(10, 1, dt.date(2024, 3, 1)), (11, 1, dt.date(2024, 7, 1)),
                                   (12, 4, dt.date(2024, 7, 1)), (13, 1, dt.date(2023, 1, 1))],
                                  "order_key bigint, customer_key bigint, order_date date")
    out = {r.order_key: r.market_segment for r in
           h.as_of_join(facts, hist, columns=["market_segment"]).collect()}
    assert out == {10: "BUILDING", 11: "AUTOMOBILE", 12: None, 13: None}


def test_replay_drops_noop_changes(spark):
    rows = [(1, "C1", "BUILDING", D("1.00"), "p", "a", 1, dt.date(2024, 1, 1)),
            (1, "C1", "BUILDING", D("1.00"), "p", "a", 1, dt.date(2024, 3, 1)),   # no-op
            (1, "C1", "AUTOMOBILE", D("1.00"), "p", "a", 1, dt.date(2024, 6, 15)),
            (2, "C2", "HOUSEHOLD", D("2.00"), None, "a", 2, dt.date(2024, 2, 1))]
    df = spark.createDataFrame(rows, FEED + ", effective_date date")
    out = sorted((r.customer_key, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.is_current)
                 for r in h.replay_history(df).collect())
    assert out == [(1, "2024-01-01 00:00:00", "2024-06-15 00:00:00", False),
                   (1, "2024-06-15 00:00:00", None, True),
                   (2, "2024-02-01 00:00:00", None, True)]


def test_stored_table_runs_and_replay_guard(spark, workdir):
    t = h.Scd2Table(spark, os.path.join(workdir, "state"))
    assert t.read() is None
    assert t.apply(feed(spark, A), T1, 0)
    assert t.apply(feed(spark, B), T2, 1)
    expected = versions(h.apply_scd2(h.apply_scd2(None, feed(spark, A), T1), feed(spark, B), T2))
    assert versions(t.read()) == expected
    assert not t.apply(feed(spark, A), T3, 1)  # replayed run id: no-op
    assert versions(t.read()) == expected
    # closed history lives in its own partition, untouched by later runs
    assert os.path.isdir(os.path.join(workdir, "state", "_state=closed-1"))


def test_bucketed_as_of_join_equals_plain(spark):
    from pyspark.sql import functions as F
    # key 1 changes segment every 20 days for two years; key 2 has one open version
    rows = [(1, f"C1", ["BUILDING", "MACHINERY"][i % 2], D("1.00"), "p", "a", 1,
             dt.date(2023, 1, 1) + dt.timedelta(days=20 * i)) for i in range(37)]
    rows.append((2, "C2", "HOUSEHOLD", D("2.00"), None, "a", 2, dt.date(2023, 3, 1)))
    hist = h.replay_history(spark.createDataFrame(rows, FEED + ", effective_date date"))
    facts = spark.range(0, 900).select((F.col("id") % 2 + 1).cast("bigint").alias("customer_key"),
                                       F.date_add(F.lit("2022-12-01").cast("date"), F.col("id").cast("int"))
                                       .alias("order_date"), F.col("id").alias("order_key"))
    plain = h.as_of_join(facts, hist, columns=["market_segment", "customer_history_key"])
    for grain in ("year", "month"):
        bucketed = h.as_of_join(facts, hist, columns=["market_segment", "customer_history_key"], bucket=grain)
        assert bucketed.count() == 900
        assert plain.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(plain).count() == 0


def test_stored_table_refuses_feed_with_repeated_key(spark, workdir):
    import pytest
    t = h.Scd2Table(spark, os.path.join(workdir, "state"))
    t.apply(feed(spark, A), T1, 0)
    with pytest.raises(ValueError):
        t.apply(feed(spark, B + [B[0][:2] + ("HOUSEHOLD",) + B[0][3:]]), T2, 1)
    assert not t.has_run(1) and t.read().count() == 4  # nothing written


def test_apply_scd2_matches_brute_force_model(spark):
    """Random snapshot sequences: apply_scd2 equals a direct model of the check
    strategy (change -> close + open, missing -> close, reappear -> open)."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    segs = st.sampled_from(["BUILDING", "MACHINERY", None])
    snapshot = st.dictionaries(st.integers(1, 5), segs, max_size=5)

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(snapshot, min_size=1, max_size=4))
    def check(runs):
        expected, open_v = [], {}
        state = None
        for i, snap in enumerate(runs):
            ts = f"2024-0{i + 1}-01 00:00:00"
            for k in list(open_v):
                if k not in snap or snap[k] != open_v[k][1]:
                    expected.append((k, open_v[k][0], ts, open_v[k][1]))
                    del open_v[k]
            for k, seg in snap.items():
                if k not in open_v:
                    open_v[k] = (ts, seg)
            rows = [(k, f"C{k}", seg, D("1.00"), None, "a", 1) for k, seg in snap.items()]
            state = h.apply_scd2(state, feed(spark, rows), ts)
            state = state.checkpoint()  # cut lineage between runs, as a stored table would
        expected += [(k, v[0], None, v[1]) for k, v in open_v.items()]
        got = [(r.customer_key, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.market_segment)
               for r in state.collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)

    check()


def test_run_that_closes_every_version(spark, workdir):
    t = h.Scd2Table(spark, os.path.join(workdir, "t"))
    t.apply(feed(spark, A[:2]), T1, 1)
    with pytest.raises(ValueError, match="allow_empty"):
        t.apply(feed(spark, []), T2, 2)
    assert all(v[2] is None for v in versions(t.read()))          # refused: nothing changed
    t.apply(feed(spark, []), T2, 2, allow_empty=True)
    assert versions(t.read()) == [(1, T1, T2, "BUILDING"), (2, T1, T2, "MACHINERY")]
    t.apply(feed(spark, A[:1]), T3, 3)                            # a key that comes back
    assert versions(t.read()) == [(1, T1, T2, "BUILDING"), (1, T3, None, "BUILDING"), (2, T1, T2, "MACHINERY")]


def test_older_run_is_refused(spark, workdir):
    t = h.Scd2Table(spark, os.path.join(workdir, "t"))
    t.apply(feed(spark, A), T2, 1)
    for ts in (T1, T2):  # before the open versions, or at their very time with changes
        with pytest.raises(ValueError, match="not after"):
            t.apply(feed(spark, B), ts, 2)
    assert len(versions(t.read())) == 4 and all(v[2] is None for v in versions(t.read()))


def test_null_key_is_refused(spark, workdir):
    t = h.Scd2Table(spark, os.path.join(workdir, "t"))
    with pytest.raises(ValueError, match="without customer_key"):
        t.apply(feed(spark, [*A, (None, "X", "S", D("1.00"), None, None, 1)]), T1, 1)
    assert not t.exists()


def test_bucketed_as_of_skips_versions_of_no_length(spark):
    ts = "timestamp_ntz"
    hist = spark.createDataFrame([(1, "a", T1, T1), (1, "b", T1, T2)], "customer_key long, seg string, f string, t string").selectExpr(
        "customer_key", "seg", f"CAST(f AS {ts}) AS valid_from", f"CAST(t AS {ts}) AS valid_to_or_max")
    facts = spark.createDataFrame([(1, dt.date(2024, 2, 1))], "customer_key long, order_date date")
    for bucket in (None, "month"):
        assert [r.seg for r in h.as_of_join(facts, hist, bucket=bucket).collect()] == ["b"]


def test_replay_with_deletions(spark):
    schema = FEED + ", effective_date date, gone boolean"
    day = lambda n: dt.date(2024, 1, n)
    rows = [(*A[0], day(1), None), (1, *[None] * 6, day(3), True), (1, *[None] * 6, day(4), True), (*A[0], day(6), False),
            (1, *[None] * 6, day(6), True), (2, *[None] * 6, day(2), True), (None, *[None] * 6, day(2), False)]
    df = spark.createDataFrame(rows, schema)
    got = versions(h.replay_history(df, deleted_col="gone"))
    assert got == versions(h.replay_history(df, deleted_col="gone", max_plain=0)) == [(1, "2024-01-01 00:00:00", "2024-01-03 00:00:00", "BUILDING"), (1, "2024-01-06 00:00:00", None, "BUILDING")]


def test_both_forms_of_replay_agree(spark):
    schema = FEED + ", effective_date date"
    rows = [(k, "C", f"S{(i * k) % 4 // 2}", D(i % 3), None, "a", 1, dt.date(2024, 1 + i % 9, 1 + (i * 7) % 28))
            for k in range(1, 6) for i in range(60)]
    df = spark.createDataFrame(rows, schema)
    plain, split = h.replay_history(df), h.replay_history(df, max_plain=1)
    shuffles = lambda x: x._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(plain) == 2 < shuffles(split)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, split.collect()), key=str)


def overlaps(df):
    spans = {}
    for r in df.collect():
        spans.setdefault(r.customer_key, []).append((str(r.valid_from), str(r.valid_to) if r.valid_to else "9999"))
    return [(k, a, b) for k, v in spans.items() for a, b in zip(sorted(v), sorted(v)[1:]) if a[1] > b[0]]


def test_run_before_a_closed_version_is_refused(spark, workdir):
    import pytest
    t = h.Scd2Table(spark, os.path.join(workdir, "t"))
    t.apply(feed(spark, A[:2]), "2024-01-01 00:00:00", 0)
    t.apply(feed(spark, A[:1]), "2024-05-01 00:00:00", 1)  # key 2 is closed; the open version dates from January
    with pytest.raises(ValueError, match="not after"):
        t.apply(feed(spark, A[:2]), "2024-03-01 00:00:00", 2)
    assert not t.has_run(2) and not overlaps(t.read()) and t.read().count() == 2
    assert t.apply(feed(spark, A[:2]), "2024-05-01 00:00:00", 3)  # the same time, nothing moves backward
    assert not overlaps(t.read())


def test_intervals_never_overlap_whatever_the_order_of_runs(spark, workdir):
    import random
    for seed in range(3):
        rng = random.Random(seed)
        t, applied, mark = h.Scd2Table(spark, os.path.join(workdir, f"t{seed}")), {}, ""
        for run in range(7):
            ts = f"2024-{rng.randrange(1, 10):02d}-01 00:00:00"
            rows = [(k, f"C{k}", rng.choice("AB"), D("1.00"), None, "a", 1) for k in range(1, 5) if rng.random() < 0.7]
            try:
                t.apply(feed(spark, rows), ts, run, allow_empty=True)
                assert ts >= mark
                applied[ts], mark = {r[0]: r[2] for r in rows}, ts
            except ValueError:
                assert ts <= mark
            got = t.read()
            assert got is None or not overlaps(got)
        for ts, want in applied.items():  # as of a run's time, the table says what the run saw
            seen = {r.customer_key: r.market_segment for r in t.read().collect() if str(r.valid_from) <= ts and (r.valid_to is None or str(r.valid_to) > ts)}
            assert seen == want


def test_a_crash_leaves_one_run_or_the_other(spark, workdir, monkeypatch):
    import pytest
    path = os.path.join(workdir, "t")
    t = h.Scd2Table(spark, path)
    t.apply(feed(spark, A), T1, 0)
    before = versions(t.read())
    after = versions(h.apply_scd2(t.read(), feed(spark, B), T2))

    def crash(*_):
        raise RuntimeError("crash")

    for owner, step, want in ((h.Scd2Table, "_refuse", before), (h.Manifests, "commit", before), (h.Scd2Table, "_clean", after)):
        with monkeypatch.context() as m:
            m.setattr(owner, step, crash)
            with pytest.raises(RuntimeError, match="crash"):
                t.apply(feed(spark, B), T2, 1)
        assert versions(t.read()) == want
    assert not t.apply(feed(spark, B), T2, 1) and t.apply(feed(spark, B), T3, 2)
    assert versions(t.read()) == after
    assert sorted(p for p in os.listdir(path) if p.startswith("_state")) == ["_state=closed-1", "_state=open-2"]


def test_a_table_without_a_ledger_is_taken_over(spark, workdir):
    import pytest
    path = os.path.join(workdir, "t")
    state = h.apply_scd2(h.apply_scd2(None, feed(spark, A), T1), feed(spark, B), T2).selectExpr(
        "*", "CASE WHEN valid_to IS NULL THEN 'open' ELSE 'closed-1' END AS _state")
    state.write.partitionBy("_state").parquet(path)
    os.makedirs(f"{path}/_runs")
    for run in (0, 1):
        open(f"{path}/_runs/run={run}", "w").close()
    t = h.Scd2Table(spark, path)
    assert t.has_run(1) and not t.apply(feed(spark, A), T3, 1)
    with pytest.raises(ValueError, match="not after"):
        t.apply(feed(spark, A), T1, 2)
    want = versions(h.apply_scd2(t.read(), feed(spark, A), T3))
    assert t.apply(feed(spark, A), T3, 2) and versions(t.read()) == want


def history_of(spark, rows):
    return spark.createDataFrame(rows, "customer_key long, seg string, f string, t string").selectExpr(
        "customer_key", "seg", "CAST(f AS timestamp_ntz) AS valid_from", "CAST(t AS timestamp_ntz) AS valid_to",
        "coalesce(CAST(t AS timestamp_ntz), timestamp_ntz'9999-12-31') AS valid_to_or_max")


def test_merge_equals_the_range_join(spark):
    import random

    import pytest
    rng, versions_, rows = random.Random(5), [], []
    for k in range(8):
        day = dt.datetime(2024, 1, 1)
        for n in range(rng.randrange(7)):
            until = day + dt.timedelta(days=rng.choice([0, 1, 9]))  # some of no length
            versions_.append((k, f"s{n}", str(day), str(until) if rng.random() < 0.9 else None))
            if versions_[-1][3] is None:
                break
            day = until + dt.timedelta(days=rng.choice([0, 0, 3]))  # gaps
    versions_.append((None, "nobody", "2024-01-01 00:00:00", None))
    for n in range(400):
        k = 3 if n % 3 == 0 else rng.choice([*range(9), None])
        rows.append((n // 2, k, dt.date(2023, 12, 28) + dt.timedelta(days=rng.randrange(40)) if n % 17 else None))  # repeated rows, no dates
    hist, facts = history_of(spark, versions_), spark.createDataFrame(rows, "id long, customer_key long, order_date date")
    for how in ("left", "inner"):
        want = h.as_of_join(facts, hist, columns=["seg", "valid_from"], how=how)
        for size in (1_000_000, 20):
            got = h.as_of_merge(facts, hist, columns=["seg", "valid_from"], how=how, rows_per_task=size)
            assert got.columns == want.columns
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    with pytest.raises(ValueError):
        h.as_of_merge(facts, hist, how="full")
    assert h.as_of_merge(facts.limit(0), hist).count() == 0


def test_merge_spreads_a_hot_key_with_many_versions(spark):
    from pyspark.sql import functions as F

    hist = spark.range(100_000).selectExpr(
        "7L AS customer_key", "CAST(id AS string) AS seg", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, CAST(id AS int)) AS valid_from",
        "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, CAST(id + 1 AS int)) AS valid_to_or_max")
    facts = spark.range(30_000).selectExpr("id", "IF(id % 3 = 0, 7L, id) AS customer_key",
                                           "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, CAST(id AS int), 30) AS order_date")
    got = h.as_of_merge(facts, hist, columns=["seg"], rows_per_task=1000)
    assert got.count() == 30_000  # every third row, and the one whose id is 7, are of the key
    assert got.filter("customer_key = 7 AND seg = CAST(id AS string)").count() == got.filter("seg IS NOT NULL").count() == 10_001
    parts = got.filter("customer_key = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 9_000
