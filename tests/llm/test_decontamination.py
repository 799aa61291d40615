import random
import re

import pytest

from starmart.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n):
    wins = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(k) for k in wins}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    found |= wins[tuple(w[i:i + size])]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items, n=10, slop=0):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in dc.decontamination(d, b, n, slop).collect()), key=str)


@pytest.mark.parametrize("limit", [dc.MAX_BROADCAST_ROWS, 0])
def test_exact_windows_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "MAX_BROADCAST_ROWS", limit)  # 0: every join shuffles
    rng = random.Random(4)
    vocab = ["the", "The", "of", "É", "é", "x1"] + [f"w{i}" for i in range(12)]
    gap = [" ", ", ", "-", "\n", "_", ": "]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice(gap) for _ in range(n))
    items = [(i, text(rng.randrange(3, 14))) for i in range(12)] + [(50, ""), (51, None), (52, "Solo"), (53, "twice twice")]
    docs = [(i, rng.choice(["", "¿", "..."]) + text(rng.randrange(40)) + rng.choice(items)[1].__str__().swapcase() + text(rng.randrange(20)))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, "--"), (103, "solo twice, TWICE twice"), (104, "The " * 3000)]
    assert run(spark, docs, items, 5) == brute(docs, items, 5)


def test_odd_rows(spark):
    t = " ".join(f"w{i}" for i in range(14))
    docs = [(1, t), (1, t), (None, t + " z"), (1, "other"), (2, t[:20])]
    assert run(spark, docs, [(7, t), (7, t), (None, "other")]) == sorted(
        [(1, 14, 14, ["7"]), (1, 14, 14, ["7"]), (None, 15, 14, ["7"]), (1, 1, 1, [""]), (2, 7, 0, [])], key=str)
    assert run(spark, docs[:1], []) == [(1, 14, 0, [])] and run(spark, [], [(7, t)]) == []


def test_proximity(spark):
    item = [(1, "alpha beta gamma delta")]
    docs = [(1, "x alpha beta gamma delta"), (2, "alpha beta or gamma delta"), (3, "beta alpha gamma delta"),
            (4, "alpha a b c beta gamma delta"), (5, "alpha beta gamma")]
    assert [r[3] for r in run(spark, docs, item, 4)] == [["1"], [], [], [], []]
    assert [bool(r[3]) for r in run(spark, docs, item, 4, slop=1)] == [True, True, True, False, False]


def test_filter(spark):
    t = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(1, t, 3), (2, "clean", 4), (None, None, 5), (2, "x " + t, 6)], "doc_id long, text string, rid int")
    b = spark.createDataFrame([(1, t)], "item_id long, text string")
    got = dc.decontamination_filter(df, b)
    assert got.columns == df.columns and sorted(r.rid for r in got.collect()) == [4, 5]
