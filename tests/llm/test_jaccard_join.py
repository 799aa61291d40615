import random

import numpy as np
import pytest

from starmart.llm.jaccard_join import jaccard_components, jaccard_links, jaccard_pairs, linked, near_duplicate_filter, op9_jaccard_join

SF = "/root/testdata/sf0.001"


def lower_az(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t, k):
    w = lower_az(t).encode().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=5, num=3, den=4):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and den * n >= num * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low.setdefault(find(i), []).append(d)
    return sorted((d, len(sets[i]), min(low[find(i)])) for i, (d, _) in enumerate(rows))


def edited(rng, words, n, vocab):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(vocab)
    return words


def corpus(seed, docs=120, vocab=300):
    rng = random.Random(seed)
    vocab = [f"W{i}" if i % 7 else f"é{i}" for i in range(vocab)]
    base = [[rng.choice(vocab) for _ in range(rng.randrange(8, 120))] for _ in range(8)]
    line = [rng.choice(vocab) for _ in range(12)]
    texts = []
    for _ in range(docs):
        w = edited(rng, rng.choice(base), rng.randrange(7), vocab)
        if rng.random() < 0.5:
            w = line + w
        if rng.random() < 0.2:
            w = w[:rng.randrange(1, len(w))]
        texts.append(" ".join(w))
    texts += [" ".join(line), " ".join(line + ["x"]), " ".join(line + ["y"]), "a b", "A b", "a b c d e", None, "", " \n"]
    texts += [texts[0]] * 9 + [texts[0].upper()]
    return [(i * 3 - 50, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,k,num,den", [(1, 5, 3, 4), (2, 5, 3, 4), (3, 3, 1, 2), (4, 1, 9, 10)])
def test_components_equal_brute_force(spark, seed, k, num, den):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, k, num, den).collect())
    assert got == brute(rows, k, num, den)


def test_chain_of_near_copies(spark):
    """Neighbours are linked, the ends are not: one component all the same."""
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[i] = f"v{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()) == brute(rows)


def brute_links(rows, k=5, num=3, den=4):
    sets = [shingles(t, k) for _, t in rows]
    ok = lambda a, b: a and b and den * len(a & b) >= num * len(a | b)
    return sorted((d, sum(i != j and bool(ok(sets[i], t)) for j, t in enumerate(sets))) for i, (d, _) in enumerate(rows))


def test_every_link_is_counted(spark, monkeypatch):
    """In a group of near copies all pairs count, not only those of a star."""
    monkeypatch.setattr("starmart.llm.jaccard_join.BLOCK_CLASSES", 7)
    near = " ".join(f"n{i}" for i in range(60))
    rows = corpus(1) + [(1000 + i, f"{near} end{i % 20}") for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_links(rows)
    assert max(n for _, n in want) == 23 and sorted((r.doc_id, r.n_links) for r in jaccard_links(df).collect()) == want
    pairs, members = jaccard_pairs(df)
    of, links = {}, dict.fromkeys((d for d, _ in rows), 0)
    for r in members.collect():
        of.setdefault(r.cls, []).append(r.doc_id)
    found = [(r.a, r.b) for r in pairs.collect()]
    assert len(found) == len(set(found)) and all(a < b for a, b in found)
    for a, b in found + [(c, c) for c in of]:
        for x in of[a]:
            links[x] += len(of[b]) - (a == b)
        for x in of[b] if a != b else ():
            links[x] += len(of[a])
    assert sorted(links.items()) == want


def test_linked_at_the_threshold():
    a = np.arange(0, 7, dtype=np.uint64)
    assert linked(a, np.arange(1, 8, dtype=np.uint64), 3, 4)          # 6 of 8
    assert not linked(a, np.r_[np.arange(1, 7), 50, 51].astype(np.uint64), 3, 4)  # 6 of 9


def test_filter_keeps_one_of_each_group(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(5, t, 1), (5, t, 1), (3, t + " more", 2), (9, "other text here", 3), (None, t, 4), (9, "", 5), (8, None, 6),
            (None, "only null id", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid int").repartition(3)
    got = near_duplicate_filter(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(3, t + " more", 2), (9, "other text here", 3), (9, "", 5), (8, None, 6), (None, "only null id", 7)], key=str)
    one = spark.createDataFrame([(5, t), (5, t)], "doc_id long, text string")
    assert near_duplicate_filter(one).count() == 1
    assert jaccard_components(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in op9_jaccard_join(spark, SF).collect()) == brute(rows)
