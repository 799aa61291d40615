import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm.mixing import BUDGET, DIMS, ContradictingTargets, cell_probabilities, largest_budget, mix, mix_filter, power_targets, probabilities, rake

SCHEMA = "doc_id long, text string, lang string, source string"


def brute_weights(cells, powers, sweeps=80):
    """cells: {(source, lang, topic): n}."""
    def margin(w, i):
        out = defaultdict(float)
        for k, v in w.items():
            out[k[i]] += v
        return out

    target = []
    for i, p in enumerate(powers):
        m = {k: v ** p for k, v in margin(cells, i).items()}
        target.append({k: v / sum(m.values()) for k, v in m.items()})
    w = dict(cells)
    for _ in range(sweeps):
        for i in range(3):
            m = margin(w, i)
            w = {k: v * target[i][k[i]] / m[k[i]] for k, v in w.items()}
    return w


def brute_probabilities(cells, w, budget):
    if budget is None:
        most = min((cells[k] / w[k] for k in cells), default=0)
        return {k: min(1.0, w[k] * most / cells[k]) for k in cells}
    c, whole = 0.0, None
    while True:
        full = {k for k in cells if w[k] * c >= cells[k]}
        if sum(cells[k] for k in full) == whole or len(full) == len(cells):
            return {k: min(1.0, w[k] * c / cells[k]) for k in cells}
        whole = sum(cells[k] for k in full)
        c = max(0.0, (budget * sum(cells.values()) - whole) / sum(w[k] for k in cells if k not in full))


CELLS = {("a", "x", "p"): 900.0, ("a", "y", "p"): 100.0, ("b", "x", "p"): 40.0, ("b", "x", "q"): 60.0, ("c", "y", "q"): 10.0,
         ("a", "x", "q"): 300.0}


def test_rake_meets_the_marginals(spark):
    cells = spark.createDataFrame([(*k, v) for k, v in CELLS.items()] + [("d", "x", "p", 0.0)], "source string, lang string, topic string, n double")
    powers = {"source": 0.5, "lang": 0.7, "topic": 0.5}
    targets = power_targets(cells, DIMS, powers)
    raked = rake(cells, DIMS, targets)
    got = {(r.source, r.lang, r.topic): r.w for r in raked.collect()}
    want = brute_weights(CELLS, [0.5, 0.7, 0.5])
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-7) for k in want)
    for d in DIMS:
        share = {r[0]: r[1] for r in targets[d].collect()}
        for r in raked.groupBy(d).agg(F.sum("w").alias("w")).collect():
            assert r.w == pytest.approx(share[r[0]], rel=1e-8)
    p = {(r.source, r.lang, r.topic): r.p for r in probabilities(raked, 0.7).collect()}
    assert p == pytest.approx(brute_probabilities(CELLS, want, 0.7), rel=1e-6)
    assert sum(p[k] * CELLS[k] for k in p) == pytest.approx(0.7 * sum(CELLS.values()))


def test_achieved_marginals(spark):
    """Those of p * n, not of w: met without a budget, and not met by the default, where cells have too few tokens."""
    cells = spark.createDataFrame([(*k, v) for k, v in CELLS.items()], "source string, lang string, topic string, n double")
    targets = power_targets(cells, DIMS, {"source": 0.5, "lang": 0.7, "topic": 0.5})
    raked = rake(cells, DIMS, targets)

    def worst(budget):
        rows = probabilities(raked, budget).collect()
        assert all(0 <= r.p <= 1 for r in rows)
        total, off = sum(r.p * r.n for r in rows), 0.0
        for d in DIMS:
            for value, share in targets[d].collect():
                off = max(off, abs(sum(r.p * r.n for r in rows if r[d] == value) / total - share))
        return off, total / sum(r.n for r in rows), max(r.p for r in rows)

    off, share, most = worst(None)
    assert off < 1e-8 and share == pytest.approx(largest_budget(raked)) and most == pytest.approx(1.0)
    assert worst(share * 0.5)[0] < 1e-8 and worst(share * 1.1)[0] > 1e-3  # any smaller one meets them, no larger one
    off, share, _ = worst(BUDGET)
    assert off > 0.01 and share == pytest.approx(0.7)
    assert probabilities(raked.limit(0), None).collect() == []


def test_the_query_samples_its_whole_budget(spark, tmp_path):
    """Also where a source has too few tokens for its target: the others make up for it."""
    from starmart.llm.mixing import op7_mixing

    rows = [(i, f"word {i} " * 20, "en" if i % 3 else "fr", "big" if i % 10 else f"s{i % 7}") for i in range(4000)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = op7_mixing(spark, str(tmp_path))
    row = out.agg(F.sum(F.col("p") * F.col("tokens")), F.sum(F.when(F.col("sampled"), F.col("tokens"))), F.sum("tokens")).first()
    assert row[0] / row[2] == pytest.approx(0.7, abs=1e-4) and row[1] / row[2] == pytest.approx(0.7, abs=0.03)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_largest_budget_meets_the_targets(spark, sf):
    from starmart.llm.mixing import POWERS

    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    out = mix(rows, None).groupBy(*DIMS).agg(F.sum("tokens").alias("n"), F.sum(F.col("p") * F.col("tokens")).alias("m")).collect()
    total = sum(r.m for r in out)
    for d in DIMS:
        n, m = defaultdict(float), defaultdict(float)
        for r in out:
            n[r[d]] += r.n
            m[r[d]] += r.m
        powered = {v: x ** POWERS[d] for v, x in n.items() if x}
        for v, x in powered.items():
            assert m[v] / total == pytest.approx(x / sum(powered.values()), abs=1e-6)
    if sf == "sf0.01":
        drawn = mix(rows, None).agg(F.sum(F.when(F.col("sampled"), F.col("tokens"))), F.sum("tokens")).first()
        assert drawn[0] / drawn[1] == pytest.approx(total / sum(r.n for r in out), abs=0.05)


def test_targets_that_contradict_each_other(spark):
    cells = spark.createDataFrame([("a", "x", "p", 50.0), ("b", "y", "p", 50.0)], "source string, lang string, topic string, n double")
    share = lambda d, *v: spark.createDataFrame(list(zip(("a", "b") if d == "source" else ("x", "y"), v)), f"{d} string, share double")
    targets = {"source": share("source", 0.5, 0.5), "lang": share("lang", 0.9, 0.1)}
    with pytest.raises(ContradictingTargets, match="off by"):
        rake(cells, ["source", "lang"], targets, strict=True)
    with pytest.warns(UserWarning, match="contradict"):
        w = {r.lang: r.w for r in rake(cells, ["source", "lang"], targets).collect()}
    assert w == pytest.approx({"x": 0.9, "y": 0.1})
    targets["lang"] = share("lang", 0.5, 0.5)
    assert rake(cells, ["source", "lang"], targets, strict=True).count() == 2


def test_sample_follows_the_probabilities(spark):
    rows = [(i, f"word {i} " * 20, "en" if i % 3 else "fr", "big" if i % 10 else f"s{i % 7}") for i in range(4000)]
    out = mix(spark.createDataFrame(rows, SCHEMA), 0.5)
    for r in out.groupBy("source", "lang").agg(F.avg("p").alias("p"), F.avg(F.col("sampled").cast("int")).alias("s"), F.count("*").alias("n")).collect():
        assert abs(r.p - r.s) < 4 * (0.25 / r.n) ** 0.5
    tokens = out.agg(F.sum("tokens"), F.sum(F.when(F.col("sampled"), F.col("tokens")))).first()
    assert tokens[1] / tokens[0] == pytest.approx(0.5, abs=0.03)
    again = {r.doc_id for r in mix(spark.createDataFrame(rows[::-1], SCHEMA), 0.5).filter("sampled").collect()}
    assert again == {r.doc_id for r in out.filter("sampled").collect()}
    u = lambda d, t: int(hashlib.md5(f"{d}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:13], 16) / 2 ** 52
    p = {r.doc_id: r.p for r in out.collect()}
    assert again == {d for d, t, _, _ in rows if u(d, t) < p[d]}


def test_odd_rows(spark):
    rows = [(1, "a b", None, "s"), (1, "a b", None, "s"), (None, "c", "en", None), (2, None, "en", "s"), (3, "", "en", "t")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("p", F.lit(1))
    got = mix(df, 1.0).collect()
    assert len(got) == 5 and {r.lang for r in got} == {None, "en"}
    whole = {("s", None), (None, "en")}  # a cell without tokens is never drawn
    assert all(r.p == pytest.approx(float((r.source, r.lang) in whole)) and r.sampled == (r.p > 0.5) for r in got)
    kept = mix_filter(df, 1.0)
    assert kept.columns == df.columns and kept.count() == 3
    assert mix(df.limit(0)).collect() == [] and mix_filter(df.limit(0)).collect() == []
    assert cell_probabilities(df.limit(0).selectExpr("source", "lang", "lang AS topic", "doc_id AS tokens")).collect() == []
