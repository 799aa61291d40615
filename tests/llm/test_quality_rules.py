import random

import numpy as np

from starmart.llm.quality_rules import (BAD, GOOD, RULES, fit, op5_quality_rules, quality_filter, quality_rules, votes_of)

SF = "/root/testdata/sf0.001"


def base(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    again = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(again), n < 50 or 100 * len(again) > 50 * n)


def rows_of(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()}


def texts(seed=1):
    rng = random.Random(seed)
    out = [None, "", " \n\t", "a b c", "# | <x>\n# | <x>\n\n \n", "a a a a a a", "é ü x y " * 3]
    for _ in range(120):
        w = [rng.choice(["the", "of", "Word", "été", "x*", "||", "LOUD!!", f"w{rng.randrange(200)}"]) for _ in range(rng.randrange(200))]
        for i in range(9, len(w), 10):
            w[i] += rng.choice(["\n", "\n\n", "\n" + " ".join(w[:4]) + "\n"])
        out.append(" ".join(w))
    return out + ["word " * 60_000]


def test_base_counts_equal_brute_force(spark):
    data = list(enumerate(texts()))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert rows_of(quality_rules(df)) == {d: base(t) for d, t in data}


def test_model_finds_planted_classes():
    rng = np.random.default_rng(3)
    k, n = len(RULES), 4000
    good = rng.random(n) < 0.8
    fails = np.where(good[:, None], 0.01, np.linspace(0.05, 0.6, k))
    votes = np.where(rng.random((n, k)) < fails, BAD, np.where(rng.random((n, k)) < 0.1, 1, GOOD))
    patterns, counts = np.unique(votes @ 3 ** np.arange(k - 1, -1, -1), return_counts=True)
    assert (votes_of(np.array([5]))[0][-2:] == [1, 2]).all()
    post, dist = fit(patterns, counts.astype(float))
    kept = dict(zip(patterns, post >= 0.5))
    said = np.array([kept[p] for p in votes @ 3 ** np.arange(k - 1, -1, -1)])
    assert (said == good).mean() > 0.93 and said[good].mean() > 0.97
    assert (dist[1, :, BAD] >= dist[0, :, BAD]).all()
    assert fit(np.empty(0, np.int64), np.empty(0))[0].shape == (0,)


def test_verdict_agrees_with_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op5_quality_rules(spark, SF).collect()}
    assert rows_of(op5_quality_rules(spark, SF)) == {d: base(t) for d, t in docs.items()}
    assert all(not got[d].kept for d in docs if got[d].base_failed)
    said = [(got[d].kept, q) for d, q in labels.items() if not got[d].base_failed]
    assert all(k for k, q in said if q) and not any(k for k, q in said if not q)


def test_odd_rows_and_filter(spark):
    good = "the cat sat on it and we saw that it was a fine day for all of them here. " * 1
    long = " ".join(f"{w}{i % 97}" if j % 3 else w for j, (i, w) in enumerate(zip(range(120), good.split() * 10)))
    df = spark.createDataFrame([(1, long, 5), (1, long, 5), (None, long, 6), (2, None, 7), (3, "x " * 100, 8)],
                               "doc_id long, text string, n_words int")
    got = sorted(((r.doc_id, r.kept) for r in quality_rules(df).collect()), key=str)
    assert got == sorted([(1, True), (1, True), (None, True), (2, False), (3, False)], key=str)
    kept = quality_filter(df)
    assert kept.columns == df.columns and sorted(r.n_words for r in kept.collect()) == [5, 5, 6]
    assert quality_rules(df.limit(0)).collect() == [] and quality_filter(df.limit(0)).collect() == []
