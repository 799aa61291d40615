import hashlib
import random

import pytest

from starmart.llm.substring_dedup import op2_substring_dedup, substring_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, n):
    """rows: (doc_id, text) with distinct ids -> {doc_id: (kept words, n_words, n_removed)}."""
    first, words = {}, {}
    for d, t in sorted(rows):
        w = words[d] = (t or "").encode().split()
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i:i + n]), (d, i))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] != (d, i):
                gone.update(range(i, i + n))
        out[d] = (b" ".join(x for i, x in enumerate(w) if i not in gone).decode(), len(w), len(gone))
    return out


def check(spark, rows, n, rounds=None):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.kept_text, r.n_words, r.n_removed) for r in substring_dedup(df, n, rounds).collect()}
    assert got == brute(rows, n)


@pytest.mark.parametrize("n,rounds", [(5, 1), (8, 2), (20, None), (50, None)])
def test_random_texts_with_planted_repeats(spark, n, rounds):
    rng = random.Random(n)
    vocab = [f"w{i}" for i in range(40)] + ["é", "a"]
    common = [[rng.choice(vocab) for _ in range(n + rng.randrange(40))] for _ in range(6)]
    rows = []
    for d in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            c = rng.choice(common)
            i = rng.randrange(len(c) - n + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = c[i:i + n + rng.randrange(len(c) - n - i + 1)]
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(100 + k, rows[3][1]) for k in range(20)]                      # exact copies
    rows += [(200, "a " * 70), (201, "b " * 3 + "a " * 30 + "c d " * 25), (202, None), (203, ""), (204, " \n ")]
    check(spark, rows, n, rounds)


def test_periodic_and_separator_like_words(spark):
    rows = [(1, "x\x1cy " * 30), (2, "a b " * 40), (3, "b a " * 40 + "a b c " * 20), (4, "a b " * 25), (-5, "a b " * 21)]
    check(spark, rows, 20)


def test_odd_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    rows = [(1, t, 9), (1, t, 9), (None, t, 1), (2, "z " + t, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long")
    got = sorted(map(tuple, substring_dedup(df, 20).collect()), key=str)
    assert got == sorted([(None, t, 30, 0), (1, "", 30, 30), (1, "", 30, 30), (2, "z", 31, 30)], key=str)
    t2 = " ".join(f"v{i}" for i in range(30))
    twice = spark.createDataFrame([(1, t2), (1, t2)], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup(twice, 20).collect()] == [0, 0]
    assert substring_dedup(df.limit(0), 20).collect() == []


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.kept_sha256, r.n_words, r.n_removed) for r in op2_substring_dedup(spark, SF).collect()}
    want = {d: (hashlib.sha256(k.encode()).hexdigest(), a, b) for d, (k, a, b) in brute(rows, 20).items()}
    assert got == want
