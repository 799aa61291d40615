"""Quality by weak supervision.

Rules look at a text and vote good, bad, or abstain. No rule decides alone: a
two-class model with a vote distribution per rule and class is fitted by
expectation-maximisation to the votes of all documents, and a document is kept
when its posterior probability of being good reaches one half. The model needs
no labels. Its sufficient statistic is the number of documents per vote
pattern (at most 3 to the number of rules, whatever the corpus), so one
aggregation with map-side sums feeds it.

Results in odd cases: null or empty text has no words, fails the base check
and is dropped; repeated rows are scored alike; an empty table gives an empty
table; other columns are ignored (or carried along by the filter, whatever
their names).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starmart.llm.common import CHUNK_WORDS, U, WordHashes, pair, persist, small_batches, tidy, windows

# Frequent function words of the corpus languages.
STOP_WORDS = """
a and are as at be by for from have in is it not of on or that the this to was with you
au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui sur un une
als auf aus das dem den der des die ein eine er es für im in ist mit nicht sich sie und von zu
al con de del el en es la las lo los no para por que se su un una y
""".split()

GOOD, ABSTAIN, BAD = 0, 1, 2

#: name -> (bad from, good up to) of a feature; between them the rule abstains.
#: With bad from < good up to the direction is reversed (small values are bad).
RULES = {
    "symbols": (0.10, 0.03),
    "repeated_trigrams": (0.40, 0.20),
    "duplicate_lines": (0.40, 0.10),
    "capitals": (0.40, 0.15),
    "shouting": (0.20, 0.05),
    "bare_marks": (0.15, 0.05),
    "distinct_words": (0.15, 0.30),
    "stop_words": (0.02, 0.08),
    "long_words": (0.20, 0.08),
    "length": (50, 80),
}
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "pattern"]
RESULT = StructType([StructField(c, LongType()) for c in FIELDS])
_SPACES = " \t\n\x0b\x0c\r"


def _features(texts: list[str], hashes: WordHashes, stop: np.ndarray) -> np.ndarray:
    """Base counts and vote pattern of texts of together about a chunk."""
    n = len(texts)
    split = [t.encode().split() for t in texts]
    count = np.array([len(w) for w in split], np.int64)
    words = [w for ws in split for w in ws]
    x = hashes.of(words)
    doc = np.repeat(np.arange(n), count)

    # words in 3-word windows that are found twice or more in their text
    covered = np.zeros(len(x), bool)
    if len(x) >= 3:
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        _, at, seen = np.unique(pair(windows(x, 3)[inside], doc[inside].astype(U)), return_inverse=True,
                                return_counts=True)
        twice = inside[seen[at] > 1]
        for k in range(3):
            covered[twice + k] = True
    repeat = np.bincount(doc, covered, n).astype(np.int64)
    distinct = np.bincount(doc[np.unique(pair(x, doc.astype(U)), return_index=True)[1]], minlength=n)
    stops = np.bincount(doc, np.isin(x, stop), n)

    size = np.fromiter(map(len, words), np.int64, len(words))
    bare = np.bincount(doc[[i for i in np.flatnonzero(size == 1) if not words[i].isalnum()]], minlength=n)
    long = np.bincount(doc, size > 24, n)
    capital = np.bincount(doc, np.fromiter(map(bytes.isupper, words), bool, len(words)), n)

    rows = np.zeros((n, 5))
    for i, t in enumerate(texts):
        lines = [s for s in t.split("\n") if s.strip(_SPACES)]
        rows[i] = (len(t) - sum(map(t.count, _SPACES)), sum(map(t.count, "#*$%&|<>")), len(lines) - len(set(lines)),
                   len(lines), t.count("!!"))
    chars, symbols, dup, lines, shouts = rows.T
    per = np.maximum(count, 1)
    value = {
        "symbols": symbols / per, "repeated_trigrams": repeat / per, "duplicate_lines": dup / np.maximum(lines, 1),
        "capitals": capital / per, "shouting": shouts / per, "bare_marks": bare / per,
        "distinct_words": distinct / np.minimum(per, 1000), "stop_words": stops / per, "long_words": long / per,
        "length": count,
    }
    pattern = np.zeros(n, np.int64)
    for name, (bad, good) in RULES.items():
        v = value[name]
        up = bad > good
        vote = np.where((v >= bad) if up else (v < bad), BAD, np.where((v <= good) if up else (v >= good), GOOD, ABSTAIN))
        pattern = pattern * 3 + vote
    return np.stack([count, chars.astype(np.int64), symbols.astype(np.int64), dup.astype(np.int64), repeat, pattern])


@F.arrow_udf(RESULT)
def measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from tidy(_measure)(texts)


# else Spark evaluates it again for a pushed-down filter on its result
measure = measure.asNondeterministic()


def _measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    hashes = WordHashes()
    stop = WordHashes().of([w.encode() for w in set(STOP_WORDS)])
    for batch in texts:
        batch = ["" if t is None else t for t in batch.to_pylist()]
        parts, held, size = [], [], 0
        for t in batch:
            held.append(t)
            size += len(t) // 6 + 1
            if size >= CHUNK_WORDS:
                parts.append(_features(held, hashes, stop))
                held, size = [], 0
        if held or not parts:
            parts.append(_features(held, hashes, stop))
        cols = np.concatenate(parts, axis=1)
        yield pa.StructArray.from_arrays([pa.array(c) for c in cols], names=FIELDS)


def votes_of(patterns: np.ndarray) -> np.ndarray:
    """Pattern numbers to votes, a column per rule."""
    k = len(RULES)
    return patterns[:, None] // 3 ** np.arange(k - 1, -1, -1) % 3


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 10.0):
    """Expectation-maximisation over vote patterns: posterior of being good per
    pattern, and vote distributions [class, rule, vote]. ``prior`` is the
    weight, in documents, of the starting belief that a bad text fails about a
    quarter of the rules and a good one hardly any."""
    votes = votes_of(patterns)
    k = votes.shape[1]
    start = np.empty((2, k, 3))
    start[0] = (0.90, 0.09, 0.01)   # good
    start[1] = (0.60, 0.15, 0.25)   # bad
    dist, good = start.copy(), 0.8
    onehot = np.eye(3)[votes]       # [pattern, rule, vote]
    post = np.full(len(patterns), good)
    for _ in range(rounds):
        ll = [np.log(np.einsum("prv,rv->pr", onehot, dist[c])).sum(1) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(ll[1] + np.log(1 - good) - ll[0] - np.log(good), -700, 700)))
        done = np.abs(new - post).max(initial=0) < 1e-9
        post = new
        if done:
            break
        for c, w in ((0, post * counts), (1, (1 - post) * counts)):
            dist[c] = (np.einsum("p,prv->rv", w, onehot) + prior * start[c]) / (w.sum() + prior)
        good = float(np.clip(((post * counts).sum() + 0.8 * prior) / (counts.sum() + prior), 0.05, 0.99))
        # a rule is at least not worse than chance: it is likelier to say bad of a bad text
        flip = dist[1, :, BAD] < dist[0, :, BAD]
        dist[1, flip], dist[0, flip] = start[1, flip], start[0, flip]
    return post, dist


def posterior(measured: DataFrame) -> DataFrame:
    """Fit the model to all rows of ``measured`` (column pattern): pattern, p_good."""
    rows = measured.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3 ** len(RULES)
    patterns = np.array([r["pattern"] for r in rows], np.int64).reshape(-1)
    post, _ = fit(patterns, np.array([r["count"] for r in rows], float))
    return measured.sparkSession.createDataFrame(
        [(int(p), float(q)) for p, q in zip(patterns, post)], "pattern long, p_good double")


def _verdict(measured: DataFrame, model: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (measured.join(F.broadcast(model), "pattern").withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("p_good") >= 0.5)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, p_good and kept for every row."""
    small_batches(docs.sparkSession)
    measured = docs.select("doc_id", measure(F.col("text").cast("string")).alias("m")).select("doc_id", "m.*")
    measured = persist(measured, "quality")
    return _verdict(measured, posterior(measured))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that quality_rules keeps, columns unchanged. Texts
    are measured twice rather than shuffled or stored."""
    small_batches(docs.sparkSession)
    one = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), measure(F.col("text").cast("string")).alias("m"))
    model = posterior(docs.select(measure(F.col("text").cast("string")).alias("m")).select("m.pattern"))
    return _verdict(one.select("row", "m.*"), model).filter("kept").select("row.*")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "p_good")
