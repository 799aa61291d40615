"""Substring deduplication by recompression.

A document is a sequence of words. Words get 64-bit names; a run of one word
gets one name, and then, for a few rounds, neighbours ``a b`` are replaced by
one name where ``a`` falls into the left and ``b`` into the right half of a
partition drawn from the names themselves. A name depends on nothing but what
it stands for, so equal substrings get the same symbols away from their ends,
in every document. Each symbol carries the span of words that its existence
depended on; a symbol whose span lies inside a window therefore occurs in every
equal window, at the same offset.

1. Every window of ``n`` words is represented by the symbol with the smallest
   name among those it determines (or by itself, if it determines none). One
   shuffle on the symbols' contexts shows which of them occur twice.
2. Only windows represented by a repeated symbol are compared, word by word
   through 96-bit hashes of the whole window. All but the first occurrence (by
   doc_id, then start) are covered by an earlier one, and their words go.

Tasks merge equal symbols and windows before each shuffle, so a passage that
stands in a third of all documents sends one row per task, not per document.
Data between the steps are packed into one binary row per task and bucket.

Results in odd cases: null or empty text has no words and returns an empty
text; rows that repeat both doc_id and text count as one document; different
texts under one doc_id are ordered by a hash of the text, and a null doc_id
comes before all others; other columns are ignored; an empty table returns an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import (CHUNK_WORDS, U, WordHashes, mix, pack, pair, partitions, record_batch, scatter,
                                 small_batches, tidy, unpack, windows)

#: Symbols or windows a task merges before it sends them on.
FLUSH = 1_500_000
#: Bytes of text a task packs at once.
PACK_BYTES = 24_000_000
NULL_ID = np.iinfo(np.int64).min
ROWS = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("blob", pa.binary())])
ROWS_DDL = "bucket int, kind tinyint, blob binary"
FIRST, KNOWN, TEXT = 0, 1, 2
PLACE = [np.int64, np.uint32, np.uint32]  # doc, text hash, position


# ------------------------------------------------------------- recompression

class Symbols:
    """Symbols of a word array: name, words [lo, hi), and the words [cl, cr)
    that determined them. ``sep`` marks the separators between documents."""

    def __init__(self, names: np.ndarray, sep: np.ndarray):
        at = np.arange(len(names), dtype=np.int64)
        self.name, self.sep = names, sep
        self.lo, self.hi, self.cl, self.cr = at, at + 1, at, at + 1

    def _regroup(self, first: np.ndarray, name: np.ndarray) -> None:
        last = np.r_[first[1:], len(self.name)] - 1
        self.cl = self.cl[np.maximum(first - 1, 0)]
        self.cr = self.cr[np.minimum(last + 1, len(self.name) - 1)]
        self.lo, self.hi, self.sep, self.name = self.lo[first], self.hi[last], self.sep[first], name

    def runs(self) -> None:
        new = np.r_[True, (self.name[1:] != self.name[:-1]) | self.sep[1:] | self.sep[:-1]]
        first = np.flatnonzero(new)
        length = np.diff(np.r_[first, len(new)]).astype(U)
        name = self.name[first]
        self._regroup(first, np.where(length > 1, pair(name, length, 1), name))

    def pairs(self, salt: int) -> None:
        left = (mix(self.name + U(salt)) & U(1)).astype(bool)
        joined = np.zeros(len(left), bool)  # the second of a pair
        joined[1:] = left[:-1] & ~left[1:] & ~self.sep[:-1] & ~self.sep[1:]
        first = np.flatnonzero(~joined)
        two = np.r_[joined[1:], False][first]
        nxt = self.name[np.minimum(first + 1, len(left) - 1)]
        name = self.name[first]
        self._regroup(first, np.where(two, pair(name, nxt, salt), name))


def default_rounds(n: int) -> int:
    """Rounds after which a window still determines several symbols: a round
    looks about one symbol of 4/3 the size further on either side."""
    rounds, context = 0, 2.0
    while context + 2 * (4 / 3) ** rounds + (4 / 3) ** (rounds + 1) <= 0.45 * n:
        context += 2 * (4 / 3) ** rounds
        rounds += 1
    return max(1, rounds)


def anchors(x: np.ndarray, sep: np.ndarray, n: int, rounds: int) -> tuple[np.ndarray, ...]:
    """For each window start in ``x``: position code of its anchor, and per
    distinct anchor its code and key. Returns (starts, code, codes, keys)."""
    s = Symbols(x, sep)
    s.runs()
    for r in range(rounds):
        s.pairs(2 + r)
    blocked = np.r_[0, np.cumsum(sep)]
    starts = np.flatnonzero(blocked[n:] == blocked[:-n]) if len(x) >= n else np.empty(0, np.int64)
    first = np.searchsorted(s.cl, starts, "left")
    last = np.searchsorted(s.cr, starts + n, "right") - 1
    have = first <= last
    best = np.zeros(len(starts), np.int64)
    if have.any():
        f, l = first[have], last[have]
        rank = mix(s.name + U(77))
        width = l - f + 1
        level = np.zeros(len(f), np.int64)
        tables, size = [np.arange(len(rank), dtype=np.int32)], 1
        while size * 2 <= width.max():
            a = tables[-1]
            b = a[np.minimum(np.arange(len(a)) + size, len(a) - 1)]
            tables.append(np.where(rank[b] < rank[a], b, a))
            size *= 2
            level += width >= size
        got = np.empty(len(f), np.int64)
        for k, t in enumerate(tables):
            m = level == k
            a, b = t[f[m]], t[l[m] - (1 << k) + 1]
            got[m] = np.where(rank[b] < rank[a], b, a)
        best[have] = got
    code = np.where(have, s.lo[best] * 2, starts * 2 + 1)

    chosen = np.unique(best[have])
    key = span_hash(x, s.cl[chosen], s.cr[chosen]) ^ mix((s.lo[chosen] - s.cl[chosen]).astype(U))
    alone = starts[~have]
    whole = windows(x, n, 5)[alone] if len(alone) else np.empty(0, U)
    return starts, code, np.r_[s.lo[chosen] * 2, alone * 2 + 1], np.r_[key, whole]


_BASE = 0x9E3779B97F4A7C15 | 1


def span_hash(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of x[lo:hi] for many spans, as differences of a prefix sum."""
    if not len(lo):
        return np.empty(0, U)
    powers = np.full(len(x), _BASE, U)
    powers[0] = 1
    powers = np.cumprod(powers)
    inverse = np.full(len(x), pow(_BASE, -1, 1 << 64), U)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    total = np.r_[U(0), np.cumsum(x * powers)]
    return mix((total[hi] - total[lo]) * inverse[lo] + (hi - lo).astype(U))


# ---------------------------------------------------------- documents, chunks

def _texts(batch: pa.RecordBatch) -> tuple[list[int], list[bytes]]:
    ids = [NULL_ID if d is None else d for d in batch.column("doc_id").to_pylist()]
    return ids, [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]


def _uid(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) & 0xFFFFFFFF


def _chunks(docs: Iterator[tuple[int, int, bytes]], hashes: WordHashes, n: int):
    """Join documents of at least ``n`` words into arrays with separators:
    (x, sep, doc, uid and first position of the document at each place)."""
    held, words = [], 0

    def chunk():
        size = sum(len(h) for _, _, h in held) + len(held) + 1
        x, sep = np.zeros(size, U), np.zeros(size, bool)
        at, of = 1, np.zeros(size, np.int32)
        sep[0] = True
        base = []
        for k, (_, _, h) in enumerate(held):
            x[at:at + len(h)] = h
            of[at:at + len(h)] = k
            base.append(at)
            at += len(h)
            sep[at] = True
            at += 1
        return (x, sep, np.array([d for d, _, _ in held], np.int64)[of],
                np.array([u for _, u, _ in held], np.uint32)[of], np.array(base, np.int64)[of])

    for doc, uid, text in docs:
        w = text.split()
        if len(w) < n:
            continue
        held.append((doc, uid, hashes.of(w)))
        words += len(w)
        if words >= CHUNK_WORDS:
            yield chunk()
            held, words = [], 0
    if held:
        yield chunk()


def _doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(doc.astype(U)) % U(buckets)).astype(np.int32)


def _out(bucket: int, kind: int, blob: bytes) -> pa.RecordBatch:
    return record_batch(ROWS, bucket=[bucket], kind=[kind], blob=[blob])


def _places(doc, uid, pos, buckets: int):
    for b, cols in scatter(_doc_bucket(doc, buckets), [doc, uid, pos]):
        order = np.lexsort((cols[2], cols[1], cols[0]))
        yield _out(b, KNOWN, pack([], [c[order] for c in cols]))


def _later(keys: list[np.ndarray], doc, uid, pos):
    """Sort rows by keys, then place. Returns (order, first of its key, place
    equal to that of its key's first)."""
    order = np.lexsort((pos, uid, doc, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    d, u, p = doc[order], uid[order], pos[order]
    return order, new, (d == d[head]) & (u == u[head]) & (p == p[head])


# ------------------------------------------------------------------ the steps

def _pack_texts(buckets: int):
    def run(batches):
        ids, texts, size = [], [], 0

        def flush():
            doc = np.array(ids, np.int64)
            for b, (rows,) in scatter(_doc_bucket(doc, buckets), [np.arange(len(doc))]):
                some = [texts[i] for i in rows]
                head = pack([], [doc[rows], np.array([len(t) for t in some], np.int64)])
                body = zstandard.ZstdCompressor(level=1).compress(b"".join(some))
                yield _out(b, TEXT, len(head).to_bytes(8, "little") + head + body)

        for batch in batches:
            for d, t in zip(*_texts(batch)):
                ids.append(d)
                texts.append(t)
                size += len(t)
                if size >= PACK_BYTES:
                    yield from flush()
                    ids, texts, size = [], [], 0
        yield from flush()
    return run


def _open_texts(blob: bytes) -> Iterator[tuple[int, bytes]]:
    at = 8 + int.from_bytes(blob[:8], "little")
    ids, sizes = unpack(blob[8:at], [], [np.int64, np.int64])
    body, at = zstandard.ZstdDecompressor().decompress(blob[at:]), 0
    for d, n in zip(ids.tolist(), sizes.tolist()):
        yield d, body[at:at + n]
        at += n


def _merge_send(keys, doc, uid, pos, buckets: int, second: np.ndarray | None = None):
    """Keep one row per key for the shuffle; what the task itself already knows
    goes out as KNOWN places."""
    cols = [keys] if second is None else [keys, second]
    order, new, same = _later(cols, doc, uid, pos)
    twice = np.zeros(len(order), bool)
    other = np.flatnonzero(~same)
    heads = np.flatnonzero(new)
    twice[heads[np.searchsorted(heads, other, "right") - 1]] = True
    known = ~same
    yield from _places(doc[order][known], uid[order][known], pos[order][known], buckets)
    row = order[new]
    sent = [c[row] for c in (*cols, doc, uid, pos)] + [twice[new].astype(np.uint8)]
    for b, part in scatter((sent[0] % U(buckets)).astype(np.int32), sent):
        k = len(cols)
        by = np.lexsort((part[k + 2], part[k + 1], part[k]))
        part = [c[by] for c in part]
        yield _out(b, FIRST, pack(part[:k], part[k:]))


def _send_anchors(n: int, rounds: int, buckets: int):
    def run(batches):
        hashes, held, size = WordHashes(), [], 0

        def docs():
            for batch in batches:
                for d, t in zip(*_texts(batch)):
                    yield d, _uid(t), t

        for x, sep, doc, uid, base in _chunks(docs(), hashes, n):
            _, _, codes, keys = anchors(x, sep, n, rounds)
            at = codes >> 1
            held.append((keys, doc[at], uid[at], (codes - 2 * base[at]).astype(np.uint32)))
            size += len(keys)
            if size >= FLUSH:
                yield from _merge_send(*map(np.concatenate, zip(*held)), buckets)
                held, size = [], 0
        if held:
            yield from _merge_send(*map(np.concatenate, zip(*held)), buckets)
    return run


def _blobs(batches):
    for batch in batches:
        yield from zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist())


def _find_repeats(wide: bool, drop_first: bool, buckets: int):
    """Over one range of keys: places of keys that occur at two places (without
    the first place if ``drop_first``), bucketed by document."""
    raw = [U, np.uint32] if wide else [U]

    def run(batches):
        got = []
        for kind, blob in _blobs(batches):
            if kind == KNOWN:
                cols = unpack(blob, [], PLACE)
                yield from _places(*cols, buckets)
            else:
                got.append(unpack(blob, raw, [*PLACE, np.uint8]))
        if not got:
            return
        cols = [np.concatenate(c) for c in zip(*got)]
        keys, (doc, uid, pos, twice) = cols[:len(raw)], cols[len(raw):]
        order, new, same = _later(keys, doc, uid, pos)
        if drop_first:
            keep = ~same
        else:
            group = np.cumsum(new) - 1
            many = np.bincount(group, ~same) + np.bincount(group, twice[order]) > 0
            keep = many[group]
        yield from _places(doc[order][keep], uid[order][keep], pos[order][keep], buckets)
    return run


def _index(parts: list[list[np.ndarray]]):
    """(doc, uid) -> sorted positions."""
    if not parts:
        return {}
    doc, uid, pos = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((pos, uid, doc))
    doc, uid, pos = doc[order], uid[order], pos[order]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (uid[1:] != uid[:-1])])
    ends = np.r_[cut[1:], len(doc)]
    return {(int(doc[i]), int(uid[i])): pos[i:j] for i, j in zip(cut, ends)}


def _docs_with_places(batches):
    """Places come first in a partition (sorted by kind), then texts; yields
    (doc, uid, text, positions or None)."""
    parts, index = [], None
    for kind, blob in _blobs(batches):
        if kind == KNOWN:
            parts.append(unpack(blob, [], PLACE))
            continue
        if index is None:
            index, parts = _index(parts), []
        for d, t in _open_texts(blob):
            u = _uid(t)
            yield d, u, t, index.get((d, u))


def _send_windows(n: int, rounds: int, buckets: int):
    def run(batches):
        hashes, held, size, wanted = WordHashes(), [], 0, {}

        def docs():
            for d, u, t, pos in _docs_with_places(batches):
                if pos is not None:
                    wanted[(d, u)] = pos
                    yield d, u, t

        for x, sep, doc, uid, base in _chunks(docs(), hashes, n):
            starts, code, _, _ = anchors(x, sep, n, rounds)
            shift = 2 * base[np.maximum(starts, 0)]
            heads = np.flatnonzero(np.r_[True, shift[1:] != shift[:-1]]) if len(starts) else starts
            keep = np.zeros(len(starts), bool)
            for i, j in zip(heads, np.r_[heads[1:], len(starts)]):
                g = starts[i]
                keep[i:j] = np.isin(code[i:j] - shift[i], wanted[(int(doc[g]), int(uid[g]))])
            at = starts[keep]
            if len(at):
                low = windows(x, n, 11)[at].astype(np.uint32)
                held.append((windows(x, n, 7)[at], low, doc[at], uid[at], (at - base[at]).astype(np.uint32)))
                size += len(at)
            wanted.clear()
            if size >= FLUSH:
                h, low, *place = map(np.concatenate, zip(*held))
                yield from _merge_send(h, *place, buckets, low)
                held, size = [], 0
        if held:
            h, low, *place = map(np.concatenate, zip(*held))
            yield from _merge_send(h, *place, buckets, low)
    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_words", pa.int64()),
                    ("n_removed", pa.int64())])


def _cut(n: int):
    def run(batches):
        rows, size = [], 0

        def flush():
            return record_batch(RESULT, **{f.name: [r[i] for r in rows] for i, f in enumerate(RESULT)})

        for d, _, text, pos in _docs_with_places(batches):
            words = text.split()
            gone = 0
            kept = words
            if pos is not None:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, pos.astype(np.int64), 1)
                np.add.at(edge, np.minimum(pos.astype(np.int64) + n, len(words)), -1)
                stay = np.cumsum(edge[:-1]) == 0
                kept = [w for w, k in zip(words, stay.tolist()) if k]
                gone = len(words) - len(kept)
            rows.append((None if d == NULL_ID else d, b" ".join(kept).decode(), len(words), gone))
            size += len(text)
            if size > 8_000_000:
                yield flush()
                rows, size = [], 0
        if rows:
            yield flush()
    return run


def substring_dedup(docs: DataFrame, n: int = 20, rounds: int | None = None) -> DataFrame:
    """Cut every word covered by a window of ``n`` words that also starts
    earlier in the corpus.

    Returns doc_id, kept_text (kept words, one space between), n_words and
    n_removed, a row for each input row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rounds = rounds or default_rounds(n)
    parts = partitions(spark)
    buckets = 2 * parts
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "bucket")

    def with_texts(places: DataFrame) -> DataFrame:
        texts = docs.mapInArrow(tidy(_pack_texts(buckets)), ROWS_DDL)
        return dealt(places.unionByName(texts)).sortWithinPartitions("kind")

    sent = dealt(docs.mapInArrow(tidy(_send_anchors(n, rounds, buckets)), ROWS_DDL))
    repeated = sent.mapInArrow(tidy(_find_repeats(False, False, buckets)), ROWS_DDL)
    sent = dealt(with_texts(repeated).mapInArrow(tidy(_send_windows(n, rounds, buckets)), ROWS_DDL))
    covered = sent.mapInArrow(tidy(_find_repeats(True, True, buckets)), ROWS_DDL)
    return with_texts(covered).mapInArrow(
        tidy(_cut(n)), "doc_id long, kept_text string, n_words long, n_removed long")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), 20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256"))
