"""Periodic runs (op12): stretches of words that repeat with some period.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and a length of at least max(MIN_LENGTH, 2 q), which no word beside
it extends with that period.

Method: a sparse diagonal DP. The diagonal of lag q holds a match at word i if
word i - q is equal; a run of period q is a maximal stretch of matches on that
diagonal, of at least max(MIN_LENGTH - q, q) of them. Words are taken with their
earlier occurrences only, and of these

* an occurrence counts with its context: fewer than CONTEXT = MIN_LENGTH / 2
  matches are never enough at any lag, so the earlier places of the CONTEXT
  words that begin at i are looked up, not those of one word;
* a diagonal becomes active where its stretch begins, that is where the words
  before the two places differ (or there is none). Within a stretch its match
  length grows implicitly: "a a a a ..." has as many stretches as words, not as
  many as pairs of words.

The match length of an active diagonal is found by bisection over prefix sums
of two polynomial hashes, first at the length that suffices, which ends nearly
all; the others emit their stretch. Stretches with the same ends are one run at
several multiples of its period: the smallest is kept. Occurrences are paired
in blocks, so memory does not grow with the number of pairs; there is no cap.

Documents are independent: one pass over the table, no shuffle. A task handles
about ``CHUNK_WORDS`` words at once, or one longer text.

Odd rows. Null, empty or blank text: no words, no runs, empty collapsed text.
Repeated rows and null ids are documents of their own. Runs may overlap; equal
lengths are all reported. Other columns are ignored; an empty table gives an
empty result. ``op12`` plants runs by a rule on doc_id first; a null id has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import (
    CHUNK_WORDS, U, WORD_SPACE, WordHashes, mix, pair, record_batch, small_batches, table, tidy, windows,
)

MIN_LENGTH = 12
#: Pairs of occurrences handled at once.
BLOCK_PAIRS = 1 << 20
#: Moduli (primes below 2**31) and bases of the prefix hashes.
PRIMES, BASES = (2147483647, 2147483629), (48271, 1103515)


class Prefix:
    """Equality of stretches of a word-hash array by prefix sums."""

    def __init__(self, h: np.ndarray):
        self.sums, self.powers = [], []
        for prime, base in zip(PRIMES, BASES):
            power = np.ones(len(h) + 1, np.int64)
            done, step = 1, base
            while done < len(power):
                part = power[done:2 * done]
                part[:] = power[:len(part)] * step % prime
                done, step = 2 * done, step * step % prime
            terms = (h % U(prime)).astype(np.int64) * power[:-1] % prime
            self.sums.append(np.r_[0, np.cumsum(terms) % prime])
            self.powers.append(power)

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from i on equal those from j < i on."""
        out = np.ones(len(i), bool)
        for prime, s, power in zip(PRIMES, self.sums, self.powers):
            out &= (s[i + n] - s[i]) % prime == (s[j + n] - s[j]) % prime * power[i - j] % prime
        return out


def _occurrences(key: np.ndarray, left: np.ndarray, at: np.ndarray):
    """Blocks of pairs (later, earlier) of places with equal ``key`` and another
    ``left``, each pair once."""
    order = np.lexsort((left, key))
    key, left, at = key[order], left[order], at[order]
    new_key = np.r_[True, key[1:] != key[:-1]]
    new_group = new_key | np.r_[True, left[1:] != left[:-1]]

    def end_of(new):  # the place after the last of each entry's group
        starts = np.flatnonzero(new)
        return np.repeat(np.r_[starts[1:], len(new)], np.diff(np.r_[starts, len(new)]))

    partners = end_of(new_group)
    n = end_of(new_key) - partners
    total = np.cumsum(n)
    lo = 0
    while lo < len(n):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + BLOCK_PAIRS, "right")))
        c = n[lo:hi]
        a = np.repeat(at[lo:hi], c)
        b = at[np.repeat(partners[lo:hi], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)]
        if len(a):
            yield np.maximum(a, b), np.minimum(a, b)
        lo = hi


def find_runs(h: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH):
    """Runs of the documents whose word hashes are ``h``, ``sizes`` words each:
    arrays document, start (in the document), length, period, sorted so."""
    context = -(-min_length // 2)
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    if len(h) < context or not sizes.size:
        return none
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = first[doc], (first + sizes)[doc]
    place = np.arange(len(h))
    with np.errstate(over="ignore"):
        key = pair(windows(h, context), mix(doc[:len(h) - context + 1].astype(U)))
    whole = np.flatnonzero(place[:len(key)] + context <= end[:len(key)])
    key = key[whole]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = order[np.r_[False, same] | np.r_[same, False]]
    if not len(again):
        return none
    at = whole[again]
    with np.errstate(over="ignore"):  # a text's beginning (0) differs from every word
        left = np.where(at > begin[at], mix(h[at - 1]) | U(1), U(0))
    prefix, found = None, []
    for i, j in _occurrences(key[again], left, at):
        lag = i - j
        need = np.maximum(min_length - lag, lag)
        near = i + need <= end[i]
        i, j, lag, need = i[near], j[near], lag[near], need[near]
        if not len(i):
            continue
        prefix = prefix or Prefix(h)
        long = prefix.equal(i, j, need)
        i, j, lag, low = i[long], j[long], lag[long], need[long]
        if not len(i):
            continue
        high = end[i] - i  # matches: at least low, at most high
        while (low < high).any():
            middle = (low + high + 1) // 2
            ok = prefix.equal(i, j, middle)
            low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
        found.append((doc[j], j - begin[j], low + lag, lag))
    if not found:
        return none
    d, start, length, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, length, start, d))  # equal ends: the smallest period first
    d, start, length, period = (c[order] for c in (d, start, length, period))
    keep = np.r_[True, (d[1:] != d[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])]
    d, start, length, period = (c[keep] for c in (d, start, length, period))
    order = np.lexsort((period, start, d))
    return tuple(c[order] for c in (d, start, length, period))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
RESULT_SQL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    if not len(start):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def _answer(ids: list, texts: list[list[bytes]], hashes: WordHashes, min_length: int) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in texts], np.int64)
    h = np.concatenate([hashes.of(w) for w in texts])
    d, start, length, period = find_runs(h, sizes, min_length)
    cuts = np.searchsorted(d, np.arange(len(ids) + 1))
    kept = [_collapse(w, start[i:j], length[i:j], period[i:j]).decode("utf-8", "replace")
            for w, i, j in zip(texts, cuts, cuts[1:])]
    runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(start), pa.array(length), pa.array(period)], fields=list(RUN)))
    return record_batch(RESULT, doc_id=ids, n_words=sizes, runs=runs, collapsed=kept)


def _run(min_length: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            ids, texts, n = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()  # bytes split at \x20 and \x09-\x0D only
                ids.append(doc_id)
                texts.append(words)
                n += len(words)
                if n >= CHUNK_WORDS:
                    yield _answer(ids, texts, hashes, min_length)
                    ids, texts, n = [], [], 0
            if ids:
                yield _answer(ids, texts, hashes, min_length)
    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the
    text without the repetitions: of every run only the first period stays."""
    if min_length < 2:
        raise ValueError("min_length must be at least 2")
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(tidy(_run(min_length)), RESULT_SQL)


def plant_runs(docs: DataFrame) -> DataFrame:
    """The texts of op12: by a rule on doc_id, every tenth document repeats its
    words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", WORD_SPACE), lambda w: w != "")
    n = F.size(words).cast("long")
    marked = docs.select("doc_id", "text", g.alias("g"), F.when((h % 10 == 0) & (n > 0), words).alias("words"))
    n = F.size("words").cast("long")
    a = F.col("g") % n
    p = F.lit(1) + F.floor((n - a) / (3 + F.col("g") % 8))
    part = F.slice("words", (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), a.cast("int")), tail), " ")
    return marked.select("doc_id", F.when(F.col("words").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(plant_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
