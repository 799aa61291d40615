import math
import random
from collections import Counter

import pytest

from starmart.llm import lm_scoring
from starmart.llm.lm_scoring import lm_scores, op3_lm_scoring

SF = "/root/testdata/sf0.001"


def brute(texts, order):
    docs = [(t or "").encode().split() for t in texts]
    grams = [Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)) for w in docs]
    total, whole = sum(grams, Counter()), sum(map(len, docs))
    out = []
    for w, own in zip(docs, grams):
        log, by = 0.0, [0] * (order + 1)
        for i in range(len(w)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                c = total[g] - own[g]
                if c or n == 1:
                    below = total[g[:-1]] - own[g[:-1]] if n > 1 else max(1, whole - len(w))
                    log += math.log10(factor * max(c, 0.5) / below)
                    by[n if c else 0] += 1
                    break
                factor *= 0.4
        out.append((len(w), log, by))
    return out


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[2] == w[2] and g[1] == pytest.approx(w[1], abs=1e-7)


@pytest.mark.parametrize("order,unit", [(1, 50), (2, 600_000), (3, 200), (3, 600_000), (4, 1000)])
def test_scores_equal_brute_force(spark, monkeypatch, order, unit):
    monkeypatch.setattr(lm_scoring, "UNIT_WORDS", unit)
    rng = random.Random(order)
    texts = [" ".join(rng.choice(["a", "b", "é", "dd", f"w{rng.randrange(30)}"]) for _ in range(rng.randrange(60))) for _ in range(80)]
    texts += [None, "", " \n", "once", texts[0], texts[0], "x " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    path = df.sparkSession.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    df.write.mode("overwrite").parquet(f"{path}/lm-{order}-{unit}")
    got = {r.doc_id: tuple(r)[1:] for r in lm_scores(spark.read.parquet(f"{path}/lm-{order}-{unit}"), order).collect()}
    same([got[i] for i in range(len(texts))], brute(texts, order))


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c", 1), (None, "a b c", 1), (3, "a b", 2)], "doc_id long, text string, unit long").coalesce(1)
    got = sorted((r.doc_id or 0, r.n_words, r.n_by_order) for r in lm_scores(df).collect())
    assert got == [(0, 3, [0, 1, 1, 1]), (0, 3, [0, 1, 1, 1]), (3, 2, [0, 1, 1, 0])]
    assert lm_scores(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in op3_lm_scoring(spark, SF).collect()}
    for r, (n, log, by) in zip(rows, brute([r.text for r in rows], 3)):
        g = got[r.doc_id]
        assert (g.n_words, [g.n_order_0, g.n_order_1, g.n_order_2, g.n_order_3]) == (n, by)
        assert g.log10_score == pytest.approx(log, abs=1e-4)
