import datetime as dt
import os

import pytest

from starmart.streaming.scd2_stream import ChangeLog, complete_dates, stream_scd2

HEADER = "customer_key,customer_name,market_segment,account_balance,phone,address,nation_key,effective_date\n"
SCHEMA = ("customer_key int, customer_name string, market_segment string, account_balance decimal(12,2), phone string, "
          "address string, nation_key int, effective_date date")


def put(feed, name, *rows, header=HEADER):
    os.makedirs(feed, exist_ok=True)
    with open(os.path.join(feed, name), "w") as f:
        f.write(header + "".join(r + "\n" for r in rows))


def run(spark, workdir, **more):
    stream_scd2(spark, f"{workdir}/feed", f"{workdir}/log", f"{workdir}/ckpt", **more).awaitTermination()


def versions(df):
    return sorted((r.customer_key, str(r.valid_from)[:10], str(r.valid_to)[:10] if r.valid_to else None, r.market_segment)
                  for r in df.collect())


def test_every_dated_state_is_a_version(spark, workdir):
    feed = os.path.join(workdir, "feed")
    put(feed, "a.csv", "1,C1,BUILDING,1.00,p,a,1,2024-01-01", "2,C2,HOUSEHOLD,2.00,p,a,2,2024-01-01")
    run(spark, workdir)
    # a delta: customer 1 changes twice, customer 2 absent (stays open)
    put(feed, "b.csv", "1,C1,MACHINERY,1.00,p,a,1,2024-06-15", "1,C1,AUTOMOBILE,1.00,p,a,1,2024-06-20")
    run(spark, workdir)
    log = ChangeLog(spark, f"{workdir}/log")
    assert versions(log.history()) == [
        (1, "2024-01-01", "2024-06-15", "BUILDING"), (1, "2024-06-15", "2024-06-20", "MACHINERY"),
        (1, "2024-06-20", None, "AUTOMOBILE"), (2, "2024-01-01", None, "HOUSEHOLD")]
    run(spark, workdir)  # nothing new: nothing changes
    assert log.history().count() == 4
    put(feed, "c.csv", "1,C1,FURNITURE,1.00,p,a,1,2024-03-01", "2,C2,HOUSEHOLD,2.00,p,a,2,2024-03-01")  # late, and a no-op
    run(spark, workdir)
    assert versions(log.history())[:3] == [
        (1, "2024-01-01", "2024-03-01", "BUILDING"), (1, "2024-03-01", "2024-06-15", "FURNITURE"),
        (1, "2024-06-15", "2024-06-20", "MACHINERY")]


def test_a_replayed_batch_replaces_itself(spark, workdir):
    log = ChangeLog(spark, f"{workdir}/log", SCHEMA)
    batch = spark.createDataFrame([(1, "C", "S", None, "p", "a", 1, dt.date(2024, 1, 1))], SCHEMA)
    log.append(batch, 0)
    log.append(batch, 0)
    assert log.states().count() == 1


def test_delete_marker_closes(spark, workdir):
    head = HEADER.strip() + ",is_deleted\n"
    put(f"{workdir}/feed", "a.csv", "1,C1,A,1.00,p,a,1,2024-01-01,false", "1,,,,,,,2024-02-01,true",
        "1,,,,,,,2024-02-05,true", "1,C1,A,1.00,p,a,1,2024-03-01,", header=head)
    schema = SCHEMA + ", is_deleted boolean"
    run(spark, workdir, schema=schema)
    assert versions(ChangeLog(spark, f"{workdir}/log", schema).history()) == [
        (1, "2024-01-01", "2024-02-01", "A"), (1, "2024-03-01", None, "A")]


@pytest.mark.parametrize("max_files", [1, 5, 1000])
def test_batch_boundaries_do_not_matter(spark, workdir, max_files):
    feed = os.path.join(workdir, "feed")
    for i in range(8):
        put(feed, f"{i}.csv", *[f"{k},C{k},S{(k + i // 2) % 3},{k}.00,p,a,1,2024-0{1 + i}-01" for k in range(5) if (k + i) % 4])
    run(spark, workdir, max_files=max_files)
    log = ChangeLog(spark, f"{workdir}/log")
    got, dates = versions(log.history()), [dt.date(2024, 1 + i, 1) for i in range(8)]
    states = {(k, i): f"S{(k + i // 2) % 3}" for i in range(8) for k in range(5) if (k + i) % 4}
    want, full = [], []
    for k in range(5):
        seen = [(i, states[k, i]) for i in range(8) if (k, i) in states]
        starts = [x for n, x in enumerate(seen) if n == 0 or seen[n - 1][1] != x[1]]
        want += [(k, str(dates[i]), str(dates[starts[n + 1][0]]) if n + 1 < len(starts) else None, s) for n, (i, s) in enumerate(starts)]
        now = None
        for i in range(9):
            s = states.get((k, i)) if i < 8 else "end"
            if now and s != now[1]:
                full.append((k, str(dates[now[0]]), str(dates[i]) if i < 8 else None, now[1]))
                now = None
            if s and s != "end" and not now:
                now = (i, s)
    assert got == sorted(want)
    assert all(b is None or a < b for _, a, b, _ in got)
    assert versions(log.history(dates)) == sorted(full, key=lambda x: (x[0], x[1]))


def test_only_whole_extracts_count(spark, workdir):
    feed, marks = os.path.join(workdir, "feed"), os.path.join(workdir, "marks")
    put(feed, "a.csv", "1,C1,A,1.00,p,a,1,2024-01-01", "2,C2,B,2.00,p,a,2,2024-01-01")
    put(feed, "b1.csv", "1,C1,A,1.00,p,a,1,2024-02-01")  # half of the second extract
    put(marks, "2024-01-01", header="")
    run(spark, workdir)
    log = ChangeLog(spark, f"{workdir}/log")
    both = [(1, "2024-01-01", None, "A"), (2, "2024-01-01", None, "B")]
    assert versions(log.history(complete_dates(spark, marks))) == both
    put(feed, "b2.csv", "2,C2,B,2.00,p,a,2,2024-02-01")
    put(marks, "2024-02-01", header="")
    run(spark, workdir)
    assert versions(log.history(complete_dates(spark, marks))) == both
    assert log.history([]).count() == 0


def brute_history(states):
    """Per key, by date: a version begins where the state differs from the one before."""
    out = []
    for k in {s[0] for s in states}:
        dated = {}
        for _, day, seg in sorted((s for s in states if s[0] == k), key=lambda s: (s[1], s[2] is None, s[2] or "")):
            dated.setdefault(day, seg)  # of one day, a state goes before a deletion, then the least
        now, begun = None, None
        for day, seg in sorted(dated.items()):
            if seg != now:
                if now is not None:
                    out.append((k, str(begun), str(day), now))
                now, begun = seg, day
        if now is not None:
            out.append((k, str(begun), None, now))
    return sorted(out, key=str)


@pytest.mark.parametrize("trim", [False, True])
def test_history_is_the_same_at_every_compaction_point(spark, workdir, trim):
    import random

    rng = random.Random(trim)
    schema = SCHEMA + ", is_deleted boolean"
    log, said = ChangeLog(spark, f"{workdir}/log", schema), []
    for batch in range(6):
        new = [(rng.randrange(1, 8), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60)), rng.choice(["A", "B", None]))
               for _ in range(rng.randrange(1, 14))]  # late states, repeats and deletions among them
        said += new
        rows = [(k, "C" if s else None, s, None, None, None, None, day, s is None) for k, day, s in new]
        log.append(spark.createDataFrame(rows, schema), batch)
        if batch % 2:
            log.compact(trim=trim)
            assert len(os.listdir(f"{workdir}/log/_compacted")) == 1
        assert sorted(versions(log.history()), key=str) == brute_history(said)
    log.append(spark.createDataFrame(rows[:1], schema), 1)  # a folded batch is replayed
    assert sorted(versions(log.history()), key=str) == brute_history(said)
    assert bool([f for f in os.listdir(f"{workdir}/log") if f.startswith("batch=")]) == (not trim)
    days = {(s[0], s[1]) for s in said}
    assert {(r.customer_key, r.effective_date) for r in log.states().collect()} == days


def test_compaction_of_extracts(spark, workdir):
    days = [dt.date(2024, m, 1) for m in range(1, 8)]
    held = {days[i]: {k: f"S{(k * i) % 3 // 2}" for k in range(6) if (k + i) % 3} for i in range(7)}
    log, plain = (ChangeLog(spark, f"{workdir}/{n}", SCHEMA) for n in ("a", "b"))
    for i, day in enumerate(days):
        batch = spark.createDataFrame([(k, "C", s, None, None, None, None, day) for k, s in held[day].items()], SCHEMA)
        for x in (log, plain):
            x.append(batch, i)
        if i in (2, 4):
            log.compact(days[:i])  # the newest extract is not whole yet
        assert versions(log.history(days[:i + 1])) == versions(plain.history(days[:i + 1]))
    assert versions(log.history([d for d in days if d != days[1]])) == versions(plain.history([d for d in days if d != days[1]]))
    late = spark.createDataFrame([(9, "C", "S", None, None, None, None, days[1])], SCHEMA)  # for an extract that was whole
    for x in (log, plain):
        x.append(late, 7)
    assert versions(log.history(days)) == versions(plain.history(days))
    with pytest.raises(ValueError):
        log.compact(days, trim=True)


def test_reading_after_a_compaction_replays_touched_keys_only(spark, workdir):
    log = ChangeLog(spark, f"{workdir}/log", SCHEMA)
    rows = [(k, "C", "S", None, None, None, None, dt.date(2024, 1, 1 + d)) for k in range(50) for d in range(20)]
    log.append(spark.createDataFrame(rows, SCHEMA), 0)
    log.compact(trim=True)
    log.append(spark.createDataFrame([(7, "C", "R", None, None, None, None, dt.date(2024, 1, 10))], SCHEMA), 1)
    runs, repeats, feed = log._split(*log._since(None))
    assert runs.count() == 49 and repeats.count() == 49 * 19 and feed.select("customer_key").distinct().count() == 1
    assert [v for v in versions(log.history()) if v[0] == 7] == [
        (7, "2024-01-01", "2024-01-10", "S"), (7, "2024-01-10", "2024-01-11", "R"), (7, "2024-01-11", None, "S")]
    assert log.history().count() == 52


def test_a_crash_while_compacting(spark, workdir, monkeypatch):
    from starmart.streaming import scd2_stream as module

    log = ChangeLog(spark, f"{workdir}/log", SCHEMA)
    batch = lambda day, s: spark.createDataFrame([(1, "C", s, None, None, None, None, dt.date(2024, 1, day))], SCHEMA)
    log.append(batch(1, "A"), 0)
    log.compact(trim=True)
    log.append(batch(2, "B"), 1)
    want = [(1, "2024-01-01", "2024-01-02", "A"), (1, "2024-01-02", None, "B")]

    def crash(*_):
        raise RuntimeError("crash")

    for owner, step in ((module.Manifests, "commit"), (module.Manifests, "forget"), (module, "remove")):
        with monkeypatch.context() as m:
            m.setattr(owner, step, crash)
            with pytest.raises(RuntimeError, match="crash"):
                log.compact(trim=True)
        assert versions(log.history()) == want
    log.compact(trim=True)
    assert versions(log.history()) == want and len(os.listdir(f"{workdir}/log/_compacted")) == 1


def test_stream_with_compactions(spark, workdir):
    for i in range(5):
        put(f"{workdir}/feed", f"{i}.csv", *[f"{k},C{k},S{(k + i) % 2},{k}.00,p,a,1,2024-0{1 + i}-01" for k in range(4)])
    run(spark, workdir, max_files=1, compact_every=2)
    log = ChangeLog(spark, f"{workdir}/log")
    assert log.history().count() == 20 and [f for f in os.listdir(f"{workdir}/log") if f.startswith("batch=")] == ["batch=4"]


def test_running_max_equals_a_plain_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from starmart.functions.ordered import running_max

    df = spark.range(300).select((F.col("id") % 3).alias("k"), F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("t"),
                                 F.when(F.hash("id") % 5 == 0, F.col("id")).alias("v"))
    by = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("_max_v", F.max("v").over(by))
    got = running_max(df, "k", "t", "v")
    assert got.exceptAll(want).count() == 0 and got.count() == 300
