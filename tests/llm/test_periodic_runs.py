import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from starmart.llm import periodic_runs as module
from starmart.llm.periodic_runs import find_runs, op12_periodic_runs, periodic_runs

SF = "/root/testdata/sf0.001"


def brute(w, least=12):
    """Every lag, every maximal stretch; a stretch with a smaller period is not its lag's run."""
    found, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(least, 2 * q):
                found.setdefault((start, length), q)
            i = j
    return sorted(((s, n_, q) for (s, n_), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [x for k, x in enumerate(w) if k not in gone]


def numbers(texts):
    flat = [x for t in texts for x in t]
    return (np.array([hash(x) & (2**64 - 1) for x in flat], np.uint64), np.array([len(t) for t in texts], np.int64))


@pytest.mark.parametrize("block", [1 << 20, 7])
@pytest.mark.parametrize("least", [2, 3, 12])
def test_runs_equal_brute_force(monkeypatch, block, least):
    monkeypatch.setattr(module, "BLOCK_PAIRS", block)
    rng = random.Random(least)
    texts = []
    for k in range(250):
        t = [rng.randrange(1 + k % 4) for _ in range(rng.randrange(40))]
        u = [rng.randrange(3) for _ in range(rng.randrange(1, 12))]
        texts.append(t + u * rng.randrange(5) + u[:rng.randrange(len(u))] + t[:rng.randrange(len(t) + 1)])
    d, s, n, q = find_runs(*numbers(texts), least)
    got = [[] for _ in texts]
    for x in zip(d.tolist(), s.tolist(), n.tolist(), q.tolist()):
        got[x[0]].append(x[1:])
    assert got == [brute(t, least) for t in texts]


def test_repeats_that_are_no_runs():
    """Six words come again, and the match ends before it suffices at any pair of a block."""
    again = [f"a{k}" for k in range(6)]
    texts = [again + [f"x{k}" for k in range(8)] + again + [f"y{k}" for k in range(20)]]
    h, sizes = numbers(texts)
    assert brute(texts[0]) == []
    assert [len(c) for c in find_runs(h, sizes)] == [0] * 4
    texts.append(["z"] + [f"b{k}" for k in range(7)] * 3)
    h, sizes = numbers(texts)
    assert [tuple(int(x) for x in r) for r in zip(*find_runs(h, sizes))] == [(1, 1, 21, 7)]


def test_a_hot_word_does_not_cost_its_square():
    n = 200_000
    d, s, length, q = find_runs(np.zeros(n, np.uint64), np.array([n]))
    assert (d.tolist(), s.tolist(), length.tolist(), q.tolist()) == ([0], [0], [n], [1])
    h = np.tile(np.arange(10, dtype=np.uint64), n // 10)
    assert [c.tolist() for c in find_runs(h, np.array([n]))] == [[0], [0], [n], [10]]


def planted(doc_id, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def digest(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(collapse(w, runs)).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in op12_periodic_runs(spark, SF).collect()}
    some = sorted(rows, key=lambda r: len(r.text or ""))[:190]
    assert len(got) == len(rows)
    for r in some:
        assert got[r.doc_id] == digest(r.doc_id, r.text)
    assert sum(g[0] > 0 for g in got.values()) >= 15


def test_odd_rows(spark, tmp_path):
    text = "x " + "é b c " * 5
    df = spark.createDataFrame([(None, text, 1), (None, text, 1), (2, None, 2), (3, "", 3), (4, " \t\n", 4), (5, "a a " * 12, 5)],
                               "doc_id long, text string, runs long")
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect())
    assert got == [(0, 16, [(1, 15, 3)], "x é b c")] * 2 + [(2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 12, [(0, 12, 1)], "a a")]
    assert periodic_runs(df.limit(0)).collect() == []
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_periodic_runs(spark, str(tmp_path)).count() == 6


def test_a_long_text(spark):
    words = [f"w{k}" for k in range(150_000)]
    df = spark.createDataFrame([(1, " ".join(words + words[-40_000:]))], "doc_id long, text string")
    assert [tuple(x) for x in periodic_runs(df).first().runs] == [(110_000, 80_000, 40_000)]
