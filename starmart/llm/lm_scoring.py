"""Stupid-backoff language model scores.

Every document is scored by a model of all other documents: the count of an
n-gram is its count in the corpus less its count in the document itself. Where
the n-gram was seen, a word scores count / count of its context, else alpha
times its score after a shorter context; a word never seen counts as half an
occurrence.

Documents are taken in units of bounded size. A unit sends each distinct
n-gram of any order once, with its count, to the bucket of its hash: the count
tables. There the counts of all units are added, and joined back to the units
that asked; these explode their n-grams again and sum the scores per document.
An n-gram that is in every document costs a row per unit. Lists of hashes are
sorted and packed, so that a hash of 56 bits takes about 5 bytes.

Results in odd cases: null or empty text has no words and score 0; every row
is a document of its own, so a repeated row has been seen elsewhere; doc_id
may be null; an empty table gives an empty table; other columns are ignored.
A unit is named by its texts; if a second reading of ``docs`` deals documents
differently (a source without an order), the query fails instead of mixing up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import U, WordHashes, pack, pair, partitions, record_batch, small_batches, tidy, unpack

#: Words in a unit (one document may have more).
UNIT_WORDS = 800_000
ALPHA = 0.4
HASH_BITS = 56
ROWS = pa.schema([("unit", pa.int64()), ("bucket", pa.int32()), ("kind", pa.int8()), ("blob", pa.binary())])
ROWS_DDL = "unit long, bucket int, kind tinyint, blob binary"
COUNTS, TEXT = 0, 1
EMPTY = 0  # the n-gram of order 0, whose count is the number of words


def _units(batches):
    """(name, ids, texts) of runs of documents."""
    ids, texts, size, name = [], [], 0, xxhash.xxh3_64()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                t = (t or "").encode()
                ids.append(d)
                texts.append(t)
                name.update(b"%d:" % len(t) + t)
                size += len(t) // 6 + 1
                if size >= UNIT_WORDS:
                    yield name.intdigest() >> 1, ids, texts
                    ids, texts, size, name = [], [], 0, xxhash.xxh3_64()
    if ids:
        yield name.intdigest() >> 1, ids, texts


class Grams:
    """N-grams of a unit: per order, the distinct hashes, their counts, and for
    each word position which n-gram ends there (-1: none)."""

    def __init__(self, texts: list[bytes], hashes: WordHashes, order: int):
        words = [t.split() for t in texts]
        self.count = np.array([len(w) for w in words], np.int64)
        self.doc = np.repeat(np.arange(len(words), dtype=np.int32), self.count)
        x = np.concatenate([hashes.of(w) for w in words] or [np.empty(0, U)])
        del words
        place = np.arange(len(x)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        self.keys, self.seen, self.at = [], [], []
        h = x
        for n in range(1, order + 1):
            if n > 1:
                h = pair(h[:-1], x[n - 1:], n)  # a longer n-gram: the shorter one before, and the word
            ends = np.flatnonzero(place >= n - 1)
            keys, inverse, seen = np.unique(h[ends - (n - 1)] >> U(64 - HASH_BITS), return_inverse=True, return_counts=True)
            at = np.full(len(x), -1, np.int32)
            at[ends] = inverse
            self.keys.append(keys)
            self.seen.append(seen.astype(np.uint32))
            self.at.append(at)
        self.words = len(x)

    def lists(self, buckets: int):
        """(bucket, order, slice of its sorted keys): buckets are ranges of hashes."""
        width = -(-(1 << HASH_BITS) // buckets)
        bounds = np.array([b * width for b in range(1, buckets)], U)
        for n, keys in enumerate(self.keys, 1):
            cuts = np.r_[0, np.searchsorted(keys, bounds), len(keys)]
            for b in range(buckets):
                if cuts[b + 1] > cuts[b]:
                    yield b, n, slice(cuts[b], cuts[b + 1])


def _pack_list(keys: np.ndarray, seen: np.ndarray) -> bytes:
    high = np.diff(keys >> U(32), prepend=U(0)).astype(np.uint32)
    return pack([(keys & U(0xFFFFFFFF)).astype(np.uint32)], [high, seen])


def _open_list(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, high, seen = unpack(blob, [np.uint32], [np.uint32, np.uint32])
    return (np.cumsum(high.astype(U)) << U(32)) | low, seen


def _send_counts(order: int, buckets: int):
    def run(batches):
        hashes = WordHashes()
        for unit, _, texts in _units(batches):
            g = Grams(texts, hashes, order)
            yield _row(unit, 0, EMPTY, _pack_list(np.zeros(1, U), np.array([g.words], np.uint32)))
            for b, n, part in g.lists(buckets):
                yield _row(unit, b, n, _pack_list(g.keys[n - 1][part], g.seen[n - 1][part]))
    return run


def _row(unit: int, bucket: int, kind: int, blob: bytes) -> pa.RecordBatch:
    return record_batch(ROWS, unit=[unit], bucket=[bucket], kind=[kind], blob=[blob])


def _add_counts(batches):
    """Count tables of the buckets of a partition, one bucket and order at a
    time (rows come sorted): total counts, in the order of each unit's list."""
    held, now = [], None

    def answer():
        lists = [_open_list(blob) for _, blob in held]
        keys, inverse = np.unique(np.concatenate([k for k, _ in lists]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([s for _, s in lists]), len(keys)).astype(np.int64)
        at = 0
        for (unit, _), (k, _) in zip(held, lists):
            yield _row(unit, now[0], now[1], pack([], [total[inverse[at:at + len(k)]]]))
            at += len(k)

    for batch in batches:
        for unit, b, n, blob in zip(*(batch.column(c).to_pylist() for c in ("unit", "bucket", "kind", "blob"))):
            if (b, n) != now and held:
                yield from answer()
                held = []
            now = (b, n)
            held.append((unit, blob))
    if held:
        yield from answer()


def _send_texts(batches):
    for unit, ids, texts in _units(batches):
        head = pack([], [np.array([d is None for d in ids], np.int64), np.array([d or 0 for d in ids], np.int64),
                         np.array([len(t) for t in texts], np.int64)])
        yield _row(unit, -1, TEXT, len(head).to_bytes(8, "little") + head
                   + zstandard.ZstdCompressor(level=1).compress(b"".join(texts)))


def _open_texts(blob: bytes):
    end = 8 + int.from_bytes(blob[:8], "little")
    none, ids, sizes = unpack(blob[8:end], [], [np.int64] * 3)
    body, at, texts = zstandard.ZstdDecompressor().decompress(blob[end:]), 0, []
    for n in sizes.tolist():
        texts.append(body[at:at + n])
        at += n
    return [None if x else d for x, d in zip(none.tolist(), ids.tolist())], texts


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log10_score", pa.float64()),
                    ("n_by_order", pa.list_(pa.int64()))])


def _scores(order: int, buckets: int):
    def score(ids, texts, answers, hashes):
        g = Grams(texts, hashes, order)
        whole = int(answers[(0, EMPTY)][0])
        others = []  # per order: count elsewhere of the n-gram that ends at each word
        for n in range(1, order + 1):
            total = np.empty(len(g.keys[n - 1]), np.int64)
            others.append(np.zeros(g.words, np.int64))
            for b, m, part in g.lists(buckets):
                if m == n:
                    total[part] = answers[(b, n)]
            at = g.at[n - 1]
            shared = np.flatnonzero((at >= 0) & (total[at] > 1))
            if len(shared):
                mine = g.doc[shared].astype(np.int64) * len(total) + at[shared]
                _, inverse, own = np.unique(mine, return_inverse=True, return_counts=True)
                others[-1][shared] = total[at[shared]] - own[inverse]
        rest = whole - g.count[g.doc]  # words elsewhere
        value = np.maximum(others[0], 0.5) / np.maximum(rest, 1)
        level = np.where(others[0] > 0, 1, 0)
        for n in range(2, order + 1):
            context = np.zeros(g.words, np.int64)
            context[1:] = others[n - 2][:-1]
            seen = others[n - 1] > 0
            value = np.where(seen, others[n - 1] / np.maximum(context, 1), np.where(g.at[n - 1] >= 0, ALPHA, 1.0) * value)
            level = np.where(seen, n, level)
        logs = np.bincount(g.doc, np.log10(value), len(ids))
        by = np.bincount(g.doc.astype(np.int64) * (order + 1) + level, minlength=len(ids) * (order + 1)).reshape(len(ids), -1)
        for at in range(0, len(ids), 5000):
            to = slice(at, at + 5000)
            yield record_batch(RESULT, doc_id=ids[to], n_words=g.count[to], log10_score=logs[to], n_by_order=by[to].tolist())

    def run(batches):
        hashes, answers, unit, asked = WordHashes(), {}, None, []

        def close():
            if unit is not None and not (answers and asked):
                raise RuntimeError("documents were dealt differently when read again")
            for texts in asked:  # units of equal texts share their counts
                yield from score(*_open_texts(texts), answers, hashes)

        for batch in batches:
            for u, b, n, blob in zip(*(batch.column(c).to_pylist() for c in ("unit", "bucket", "kind", "blob"))):
                if u != unit:
                    yield from close()
                    answers, asked, unit = {}, [], u
                if b < 0:
                    asked.append(blob)
                else:
                    answers[(b, n)] = unpack(blob, [], [np.int64])[0]
        yield from close()
    return run


def lm_scores(docs: DataFrame, order: int = 3) -> DataFrame:
    """doc_id, n_words, log10_score (sum over the words) and n_by_order (words
    scored by an n-gram of order 0, for never seen, up to ``order``) per row."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = partitions(spark)
    buckets = parts
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = (docs.mapInArrow(tidy(_send_counts(order, buckets)), ROWS_DDL).repartition(parts, "bucket")
              .sortWithinPartitions("bucket", "kind").mapInArrow(tidy(_add_counts), ROWS_DDL))
    texts = docs.mapInArrow(tidy(_send_texts), ROWS_DDL)
    return (counts.unionByName(texts).repartition(parts, "unit").sortWithinPartitions("unit", "bucket")
            .mapInArrow(tidy(_scores(order, buckets)), "doc_id long, n_words long, log10_score double, n_by_order array<long>"))


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    out = lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", F.round("log10_score", 5).alias("log10_score"),
                      *[F.col("n_by_order")[n].alias(f"n_order_{n}") for n in range(4)],
                      F.round(F.pow(F.lit(10.0), -F.col("log10_score") / F.greatest("n_words", F.lit(1))), 3).alias("perplexity"))
