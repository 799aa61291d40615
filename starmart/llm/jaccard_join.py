"""N-gram Jaccard self-join with rare-first prefix filtering.

A document's set holds its distinct word shingles as 64-bit tokens: a rarity
class in the top byte (of the rarest of its words, from counts over the whole
corpus, kept in a table of fixed size), a hash below. Ascending order is the
join's global order, rare shingles first. Documents with equal sets form one
class and take part once.

1. Every class posts the tokens of its prefix, with its set's size and the
   token's position. Two sets that reach the threshold share a prefix token,
   and at the first one they share their sizes and positions still allow for
   the needed overlap: lists are filtered by size (length filter) and by what
   can follow (positional filter).
2. In each list, classes of like size are paired with one of them, the least
   edited. A suffix
   filter bounds from below how far two sets differ: each class has a bitmap
   of the parity of its tokens per bin, and two bitmaps differ in no more bits
   than the sets differ in tokens. Pairs that pass are verified by exact
   intersection, once per pair.
3. Verified pairs give components. Lists that hold several components yield
   the pairs between them, which are verified too, and components are joined
   again. So every pair that could link two components has been looked at,
   while a group of thousands of near copies costs about one pair a member.

4. Every link lies in one component, so links are counted there: all pairs of
its classes pass the length and suffix filters or are verified, in blocks of
bounded size; a class in a large component travels once per block. A document's
links are the other documents of its class and all of the linked classes.

Rows travel packed by task and token bucket. Sets are rebuilt from the texts
for the classes in some pair only, which are found by a bitmap of fixed size.

Results in odd cases: a text without words has the empty set, is linked with
nothing and is its own component; fewer words than a shingle count as one
shingle; documents of equal sets are linked; rows that share a doc_id but not
the text are separate; a null doc_id never names a component unless all its
documents have none; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import (CHUNK_WORDS, U, WordHashes, broadcast_within, mix, pack, partitions, persist,
                                 record_batch, scatter, small_batches, tidy, unpack, windows)
from starmart.llm.components import components

#: Cells of the word count table (one byte each when broadcast), and of the bitmap.
CELLS, BITS = 1 << 20, 1 << 23
#: Bins of a parity bitmap, in 64-bit words.
PARITY = 8
#: Texts taken out of a batch at once.
SLICE = 256
#: The count table travels in so many parts.
PARTS = 64
#: Postings a task merges before it sends them on.
FLUSH = 300_000
#: Classes and tokens of a component that make a block, whose pairs with another one task looks at.
BLOCK_CLASSES, BLOCK_TOKENS = 400, 400_000
NULL_ID = np.iinfo(np.int64).min
MAX_BROADCAST_ROWS = 300_000
POST, MEMBER, PAIR, LIST = 0, 1, 2, 3
BLOBS = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("blob", pa.binary())])
BLOBS_DDL = "bucket int, kind tinyint, blob binary"
ROWS = pa.schema([("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("d", pa.int64()),
                  ("parity", pa.list_(pa.int64()))])
ROWS_DDL = "kind tinyint, a long, b long, c long, d long, parity array<long>"


# ------------------------------------------------------------------- texts

def _slices(batches, *columns: str):
    """Rows of all batches, a slice at a time as Python values; texts lower-cased (A-Z)."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield from zip(*[part.column(c).to_pylist() for c in columns],
                           ((t or "").encode().lower() for t in part.column("text").to_pylist()))


def _texts(batches):
    return (t for t, in _slices(batches))


def _chunks(rows, size_of):
    """Lists of rows of together about CHUNK_WORDS words."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += size_of(r)
        if size >= CHUNK_WORDS * 6:
            yield held
            held, size = [], 0
    if held:
        yield held


# ------------------------------------------------------------- word counts

def _count_words(batches):
    total = np.zeros(CELLS, np.int64)
    hashes = WordHashes()
    for texts in _chunks(_texts(batches), len):
        words = [w for t in texts for w in t.split()]
        total += np.bincount((hashes.of(words) % U(CELLS)).astype(np.int64), minlength=CELLS)
    for k, part in enumerate(np.split(total, PARTS)):
        yield _blob(k, 0, zstandard.ZstdCompressor(level=1).compress(part.tobytes()))


def _add_counts(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
            part = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64)
            sums[k] = sums[k] + part if k in sums else part
    for k, part in sums.items():
        yield _blob(k, 0, part.tobytes())


def word_rarity(docs: DataFrame) -> np.ndarray:
    """Rarity class (8 a doubling) per cell of word hashes: an upper bound of
    the counts of the words in it, over all documents. CELLS bytes."""
    parts = (docs.select("text").mapInArrow(tidy(_count_words), BLOBS_DDL).repartition(PARTS, "bucket")
             .mapInArrow(tidy(_add_counts), BLOBS_DDL).collect())
    total = np.zeros((PARTS, CELLS // PARTS), np.int64)
    for r in parts:
        total[r.bucket] = np.frombuffer(r.blob, np.int64)
    return np.minimum(255, np.round(8 * np.log2(total.reshape(-1) + 1.0))).astype(np.uint8)


# -------------------------------------------------------------------- sets

def token_sets(texts: list[bytes], rarity: np.ndarray, hashes: WordHashes, k: int) -> list[np.ndarray]:
    """Sorted distinct tokens of each (already lower-cased) text."""
    words = [t.split() for t in texts]
    x = hashes.of([w for ws in words for w in ws])
    rare = rarity[(x % U(CELLS)).astype(np.int64)]
    full = windows(x, k)
    least = rare[:len(full)].copy() if len(full) else rare[:0]
    for j in range(1, k):
        np.minimum(least, rare[j:j + len(least)], out=least)
    tokens = (least.astype(U) << U(56)) | (full & U((1 << 56) - 1))
    out, at = [], 0
    for ws in words:
        n = len(ws)
        if n >= k:
            out.append(np.unique(tokens[at:at + n - k + 1]))
        elif n:
            one = windows(x[at:at + n], n, 99)
            out.append((one & U((1 << 56) - 1)) | (rare[at:at + n].min().astype(U) << U(56)))
        else:
            out.append(np.empty(0, U))
        at += n
    return out


def _class(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes())


def _blob(bucket: int, kind: int, blob: bytes) -> pa.RecordBatch:
    return record_batch(BLOBS, bucket=[bucket], kind=[kind], blob=[blob])


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bit b of the result: whether an odd number of tokens falls into bin b."""
    odd = np.bincount((tokens & U(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def suffix_parities(tokens: np.ndarray, p: int) -> np.ndarray:
    """Row i, for i < p: parity of the tokens after position i."""
    at = (tokens[:p] & U(64 * PARITY - 1)).astype(np.int64)
    bits = np.zeros((p, PARITY), U)
    bits[np.arange(p), at >> 6] = U(1) << (at & 63).astype(U)
    return (np.bitwise_xor.accumulate(bits, axis=0) ^ parity(tokens).view(U)).view(np.int64)


def _send_postings(rarity, k: int, num: int, den: int, buckets: int):
    def run(batches):
        hashes, table = WordHashes(), rarity.value
        seen: set[int] = set()
        posts, size = [], 0

        def flush():
            tok, cls, n, pos = (np.concatenate(c) for c in zip(*posts))
            for b, cols in scatter((mix(tok) % U(buckets)).astype(np.int32), [tok, cls, n, pos]):
                yield _blob(b, POST, pack(cols[:2], cols[2:]))

        docs = ((NULL_ID if d is None else d, r, t) for d, r, t in _slices(batches, "doc_id", "rid"))
        for rows in _chunks(docs, lambda r: len(r[2])):
            sets = token_sets([t for _, _, t in rows], table, hashes, k)
            cls = np.array([_class(s) for s in sets], U)
            members = [np.array([d for d, _, _ in rows], np.int64), np.array([r for _, r, _ in rows], np.int64), cls,
                       np.array([len(s) for s in sets], np.uint32), np.array([parity(s) for s in sets])]
            for b, cols in scatter((mix(members[1].astype(U)) % U(buckets)).astype(np.int32), members):
                yield _blob(b, MEMBER, pack([cols[1], cols[2], *cols[4].T.copy()], [cols[0], cols[3]]))
            for c, s in zip(cls.tolist(), sets):
                if not len(s) or c in seen:
                    continue
                seen.add(c)
                p = len(s) - -(-num * len(s) // den) + 1
                posts.append((s[:p], np.full(p, c, U), np.full(p, len(s), np.uint32), np.arange(p, dtype=np.uint32)))
                size += p
            if size >= FLUSH:
                yield from flush()
                posts, size = [], 0
                if len(seen) > FLUSH:
                    seen.clear()
        if posts:
            yield from flush()
    return run


def can_reach(size_a, pos_a, size_b, pos_b, num: int, den: int):
    """Length and positional filter at a shared token (the first of a pair)."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    follow = np.minimum(size_a - pos_a, size_b - pos_b)
    return (den * small >= num * large) & ((num + den) * follow >= num * (size_a + size_b))


def _long(x: np.ndarray) -> np.ndarray:
    return x.astype(U).view(np.int64)


def _rows(kind: int, *cols) -> pa.RecordBatch:
    n = len(cols[0])
    cols = [*cols, *[np.zeros(n, np.int64)] * (4 - len(cols))]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *map(pa.array, cols),
                                       pa.nulls(n, ROWS.field("parity").type)], schema=ROWS)


def _match_lists(num: int, den: int):
    """Over one range of tokens: members passed on, star pairs, and the lists
    of three and more classes."""
    def run(batches):
        got = []
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
                if kind == MEMBER:
                    rid, cls, *bits, doc, n = unpack(blob, [np.int64, U, *[np.int64] * PARITY], [np.int64, np.uint32])
                    ids = pa.array(doc, mask=doc == NULL_ID)
                    lists = pa.ListArray.from_arrays(np.arange(len(doc) + 1, dtype=np.int32) * PARITY, np.stack(bits, 1).reshape(-1))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), MEMBER, np.int8)), ids, pa.array(rid),
                                                      pa.array(cls.view(np.int64)), pa.array(n.astype(np.int64)), lists], schema=ROWS)
                else:
                    got.append(unpack(blob, [U, U], [np.uint32, np.uint32]))
        if not got:
            return
        tok, cls, size, pos = (np.concatenate(c) for c in zip(*got))
        got.clear()
        order = np.lexsort((cls, tok))
        tok, cls, size, pos = tok[order], cls[order], size[order].astype(np.int64), pos[order].astype(np.int64)
        same = np.r_[False, (tok[1:] == tok[:-1]) & (cls[1:] == cls[:-1])]  # one class, sent by several tasks
        tok, cls, size, pos = (c[~same] for c in (tok, cls, size, pos))
        first = np.r_[True, tok[1:] != tok[:-1]]
        group = np.cumsum(first) - 1
        many = np.bincount(group)
        # in a pair, the smaller set has its token in the first part of its prefix
        early = np.bincount(group, (num + den) * (size - pos) >= 2 * num * size) > 0
        keep = ((many >= 2) & early)[group]
        tok, cls, size, pos, group = (c[keep] for c in (tok, cls, size, pos, group))
        if not len(tok):
            return
        three = many[group] >= 3
        band = np.where(three, np.floor(np.log(size) / np.log(den / num)), 0).astype(np.int64)
        # the centre of a star is the class with the fewest rarer tokens: of edited copies, the least edited
        order = np.lexsort((mix(cls), pos, band, group))
        head = np.r_[True, (group[order][1:] != group[order][:-1]) | (band[order][1:] != band[order][:-1])]
        star = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
        ok = (star != order) & can_reach(size[star], pos[star], size[order], pos[order], num, den)
        a, b = _long(cls[star[ok]]), _long(cls[order[ok]])
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        if pairs.size:
            yield _rows(PAIR, pairs[0], pairs[1])
        if three.any():
            yield _rows(LIST, _long(tok[three]), _long(cls[three]), size[three], pos[three])
    return run


# ------------------------------------------------------------- verification

def _bitmap(at: DataFrame) -> np.ndarray:
    """Bits whose numbers are in ``at`` (column at, below BITS): BITS / 8 bytes."""
    at, ids = F.col("at"), at
    words = (ids.select(F.shiftright(at, 6).alias("word"), (at % 64).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect())
    out = np.zeros(BITS // 64, np.int64)
    for r in words:
        out[r.word] = r.bits
    return out


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 6] >> (at & 63) & 1).astype(bool)


def _sets_of(batches, rarity, bits, k: int):
    """Non-empty sets of the documents in a bitmap, a list at a time."""
    hashes, table, bitmap = WordHashes(), rarity.value, bits.value
    wanted = (b.filter(pa.array(_has(bitmap, b.column("at").to_numpy(zero_copy_only=False)))) for b in batches)
    for rows in _chunks(_texts(wanted), len):
        yield [s for s in token_sets(rows, table, hashes, k) if len(s)]


def _send_sets(rarity, bits, k: int):
    schema = pa.schema([("cls", pa.int64()), ("tokens", pa.binary())])

    def run(batches):
        for sets in _sets_of(batches, rarity, bits, k):
            if sets:
                yield record_batch(schema, cls=_long(np.array([_class(s) for s in sets], U)),
                                   tokens=[s.tobytes() for s in sets])
    return run


ENTRY = pa.schema([("token", pa.int64()), ("cls", pa.int64()), ("size", pa.int64()), ("pos", pa.int64()),
                   ("rest", pa.list_(pa.int64()))])


def _send_entries(rarity, bits, token_bits, k: int, num: int, den: int):
    """Postings of the tokens in a bitmap, with the parity of what follows."""
    def run(batches):
        for sets in _sets_of(batches, rarity, bits, k):
            for s in sets:
                p = len(s) - -(-num * len(s) // den) + 1
                at = np.flatnonzero(_has(token_bits.value, _token_at(s[:p])))
                if len(at):
                    rest = suffix_parities(s, p)[at]
                    lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * PARITY, rest.reshape(-1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_long(s[at])), pa.array(np.full(len(at), _long(np.array([_class(s)], U))[0])),
                         pa.array(np.full(len(at), len(s), np.int64)), pa.array(at), lists], schema=ENTRY)
    return run


def _token_at(tokens: np.ndarray) -> np.ndarray:
    return (tokens & U(BITS - 1)).astype(np.int64)


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two token sets reach the threshold."""
    n = len(a) + len(b)
    if den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (n - both)


def _verify(num: int, den: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))
            ok = [linked(np.frombuffer(p, U), np.frombuffer(q, U), num, den) for p, q in zip(x, y)]
            yield record_batch(schema, a=[v for v, o in zip(a, ok) if o], b=[v for v, o in zip(b, ok) if o])
    return run


def _differ_little(num: int, den: int, size_a, size_b, parity_a, parity_b, before=0):
    """Suffix filter: tokens known to differ ``before`` those in the bitmaps,
    and the bitmaps, leave room for the needed overlap."""
    bits = sum((F.bit_count(parity_a[i].bitwiseXOR(parity_b[i])) for i in range(PARITY)), F.lit(0)) + before
    return (num + den) * bits <= (den - num) * (size_a + size_b)


def linked_within(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int):
    """Yield (i, js): the sets of ``right`` that are linked with left[i]; None
    for the sets of ``left`` after it."""
    sets = left + (right or [])
    size = np.array([len(s) for s in sets], np.int64)
    bits = np.array([parity(s).view(U) for s in sets])
    ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(size)[:-1])
    mark = np.zeros(max(int(x.max()) for x in ids) + 1, np.uint8)
    for i in range(len(left)):
        js = np.arange(i + 1 if right is None else len(left), len(sets))
        small, large = np.minimum(size[i], size[js]), np.maximum(size[i], size[js])
        differ = np.bitwise_count(bits[js] ^ bits[i]).sum(axis=1, dtype=np.int64)
        js = js[(den * small >= num * large) & ((num + den) * differ <= (den - num) * (size[i] + size[js]))]
        if not len(js):
            continue
        mark[ids[i]] = 1
        both = np.array([np.count_nonzero(mark[ids[j]]) for j in js.tolist()], np.int64)
        mark[ids[i]] = 0
        js = js[den * both >= num * (size[i] + size[js] - both)]
        if len(js):
            yield i, js if right is None else js - len(left)


BLOCK_DDL = "a long, b long, n long"


def _links_in_blocks(num: int, den: int, pairs: bool):
    """Over rows sorted by comp, i and j: the links of each pair of blocks, or
    per class (a) the number of documents that they lead to (n)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
    columns = ("comp", "i", "j", "own", "cls", "docs", "tokens")

    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))

    def run(batches):
        for (_, i, j), group in groupby(rows(batches), key=lambda r: r[:3]):
            once = {cls: (own, docs, np.frombuffer(tokens, U)) for _, _, _, own, cls, docs, tokens in group}
            side = [[(c, n, s) for c, (own, n, s) in once.items() if own == k] for k in ((i,) if i == j else (i, j))]
            if not all(side):
                continue
            right = side[-1]
            to = {c: 0 for c in once}
            for x, ys in linked_within([s for _, _, s in side[0]], None if i == j else [s for _, _, s in right], num, den):
                a, n, _ = side[0][x]
                if pairs:
                    b = [right[y][0] for y in ys.tolist()]
                    yield record_batch(schema, a=[min(a, c) for c in b], b=[max(a, c) for c in b], n=[1] * len(b))
                    continue
                for y in ys.tolist():
                    to[a] += right[y][1]
                    to[right[y][0]] += n
            found = [(c, n) for c, n in to.items() if n]
            if found:
                yield record_batch(schema, a=[c for c, _ in found], b=[None] * len(found), n=[n for _, n in found])
    return run


class Joiner:
    """One join over ``docs``: holds the count table and the thresholds."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int):
        self.docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                                F.xxhash64("doc_id", "text").alias("rid"))
        self.spark, self.k, self.num, self.den = docs.sparkSession, k, num, den
        small_batches(self.spark)
        self.rarity = self.spark.sparkContext.broadcast(word_rarity(self.docs))

    def match(self) -> DataFrame:
        parts = partitions(self.spark)
        sent = self.docs.mapInArrow(tidy(_send_postings(self.rarity, self.k, self.num, self.den, 2 * parts)), BLOBS_DDL)
        return persist(sent.repartition(parts, "bucket").mapInArrow(tidy(_match_lists(self.num, self.den)), ROWS_DDL), "lists")

    def _of(self, nodes: DataFrame, classes: DataFrame):
        """Texts with their bit, and a bitmap of the documents that stand for ``nodes`` (cls)."""
        at = F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).alias("at")
        bits = self.spark.sparkContext.broadcast(_bitmap(nodes.join(classes, "cls").select(at)))
        return self.docs.select("text", at), bits

    def verify(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that are links. ``classes``: cls, doc_id
        of a member, size and parity."""
        side = lambda c: classes.select(F.col("cls").alias(c), F.col("size").alias(f"size_{c}"), F.col("parity").alias(f"parity_{c}"))
        pairs = pairs.join(side("a"), "a").join(side("b"), "b").filter(_differ_little(
            self.num, self.den, *[F.col(c) for c in ("size_a", "size_b", "parity_a", "parity_b")]))
        pairs = persist(pairs.select("a", "b"), "pairs")
        nodes = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "cls")
        texts, bits = self._of(nodes, classes)
        sets = texts.mapInArrow(tidy(_send_sets(self.rarity, bits, self.k)), "cls long, tokens binary")
        both = (pairs.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b")
                .join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a"))
        return persist(both.select("a", "b", "x", "y").mapInArrow(tidy(_verify(self.num, self.den)), "a long, b long").distinct(),
                       "links")

    def between(self, lists: DataFrame, comp: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs of classes in different components that some list allows."""
        named = lists.join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
            "comp", F.coalesce("comp", "cls"))
        named = persist(named, "named-lists")
        sizes = named.groupBy("token", "comp").agg(F.count("*").alias("n"))
        mixed = persist(sizes.groupBy("token").agg(F.count("*").alias("comps"), F.max_by("comp", "n").alias("main"))
                        .filter("comps > 1").drop("comps"), "mixed")
        named = named.join(broadcast_within(mixed, MAX_BROADCAST_ROWS), "token").withColumn("minor", F.col("comp") != F.col("main"))
        named = persist(named, "mixed-lists")
        # the lists again, for these tokens and classes only, with what the suffix filter needs
        tokens = self.spark.sparkContext.broadcast(_bitmap(mixed.select(F.pmod("token", F.lit(BITS)).alias("at"))))
        num, den = self.num, self.den
        texts, bits = self._of(named.select("cls").distinct(), classes)
        full = texts.mapInArrow(tidy(_send_entries(self.rarity, bits, tokens, self.k, num, den)),
                                "token long, cls long, size long, pos long, rest array<long>")
        named = persist(named.select("token", "cls", "comp", "minor").join(full, ["token", "cls"]).dropDuplicates(["token", "cls"]),
                        "full-lists")
        early = (num + den) * (F.col("size") - F.col("pos")) >= 2 * num * F.col("size")
        left = named.filter(early).select("token", *[F.col(c).alias(f"l_{c}") for c in ("cls", "size", "pos", "comp", "minor", "rest")])
        found = []
        for l_minor, right in ((True, named), (False, named.filter("minor"))):
            # all tokens before the first shared one differ
            x = left.filter(F.col("l_minor") == l_minor).join(right, "token").filter(
                (F.col("l_comp") != F.col("comp"))
                & ((F.col("l_size") < F.col("size")) | (F.col("l_size") == F.col("size")) & (F.col("l_cls") < F.col("cls")))
                & (den * F.col("l_size") >= num * F.col("size"))
                & ((num + den) * F.least(F.col("l_size") - F.col("l_pos"), F.col("size") - F.col("pos"))
                   >= num * (F.col("l_size") + F.col("size")))
                & _differ_little(num, den, F.col("l_size"), F.col("size"), F.col("l_rest"), F.col("rest"),
                                 F.col("l_pos") + F.col("pos")))
            found.append(x.select(F.least("l_cls", "cls").alias("a"), F.greatest("l_cls", "cls").alias("b")))
        return found[0].union(found[1]).distinct()


    def links(self, named: DataFrame, classes: DataFrame, pairs: bool = False) -> DataFrame:
        """Per class (a) the number of documents of linked classes (n), or the
        links (a, b) themselves. ``named``: cls and comp of all classes."""
        of = named.select("cls", "comp").join(classes.select("cls", "size", "docs"), "cls")
        sums = persist(of.groupBy("comp").agg(F.count("*").alias("classes"), F.sum("size").alias("tokens")).filter("classes > 1"),
                       "component-sizes")
        blocks = F.ceil(F.greatest(F.col("classes") / BLOCK_CLASSES, F.col("tokens") / BLOCK_TOKENS)).cast("int")
        of = persist(of.join(sums.select("comp", blocks.alias("blocks")), "comp").select(
            "cls", "comp", "docs", "blocks", F.pmod(F.xxhash64("cls"), "blocks").cast("int").alias("own")), "blocks")
        texts, bits = self._of(of.select("cls"), classes)
        sets = texts.mapInArrow(tidy(_send_sets(self.rarity, bits, self.k)), "cls long, tokens binary")
        rows = sets.join(broadcast_within(of, MAX_BROADCAST_ROWS), "cls").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "docs", "tokens")
        rows = rows.repartition(partitions(self.spark), "comp", "i", "j").sortWithinPartitions("comp", "i", "j")
        found = rows.mapInArrow(tidy(_links_in_blocks(self.num, self.den, pairs)), BLOCK_DDL)
        return persist(found.select("a", "b") if pairs else found.groupBy("a").agg(F.sum("n").alias("n")), "class-links")


def _joined(docs: DataFrame, k: int, num: int, den: int):
    """The join, its rows (members), classes, and their components."""
    join = Joiner(docs, k, num, den)
    rows = join.match()
    members = rows.filter(F.col("kind") == MEMBER).select(
        F.col("a").alias("doc_id"), F.col("b").alias("rid"), F.col("c").alias("cls"), F.col("d").alias("n_shingles"), "parity")
    classes = members.filter("n_shingles > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("docs"), F.first("n_shingles").alias("size"), F.first("parity").alias("parity"))
    classes = persist(classes, "classes")
    stars = persist(rows.filter(F.col("kind") == PAIR).select("a", "b").distinct(), "pairs")
    lists = rows.filter(F.col("kind") == LIST).select(
        F.col("a").alias("token"), F.col("b").alias("cls"), F.col("c").alias("size"), F.col("d").alias("pos"))

    links = join.verify(stars, classes)
    comp = components(links)
    more = persist(join.between(lists, comp, classes).join(stars, ["a", "b"], "left_anti"), "pairs")
    comp = persist(classes.select("cls").join(comp.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", F.coalesce("comp", "cls").alias("comp")), "class-components")
    named = comp
    if more.limit(1).count():
        # of the further links, only which components they join matters
        links = join.verify(more, classes)
        for side in ("a", "b"):
            links = links.join(comp.withColumnRenamed("cls", side), side).drop(side).withColumnRenamed("comp", side)
        wider = components(links.distinct()).select(F.col("node").alias("comp"), F.col("comp").alias("wider"))
        named = comp.join(wider, "comp", "left").select("cls", F.coalesce("wider", "comp").alias("comp"))
    named = classes.select("cls", "doc_id").join(named, "cls")
    # written before it is joined, so that Spark may split a component of very many classes
    ids = persist(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "component-ids")
    named = persist(named.select("cls", "comp").join(ids, "comp"), "components")
    return join, members, classes, named


def _rows_of(members: DataFrame, named: DataFrame, *more) -> DataFrame:
    out = members.join(named, "cls", "left")
    return out.select("doc_id", "rid", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("comp")).alias("component"),
                      F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *more)


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """For every row: doc_id, rid (hash of id and text), n_shingles, component
    (its smallest class; null for an empty set) and component_id (its smallest
    doc_id). Links are pairs with Jaccard similarity >= num / den."""
    _, members, _, named = _joined(docs, k, num, den)
    return _rows_of(members, named)


def jaccard_links(docs: DataFrame, k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """Rows of ``jaccard_components`` with n_links: other rows that reach the threshold."""
    join, members, classes, named = _joined(docs, k, num, den)
    to = join.links(named, classes).select(F.col("a").alias("cls"), F.col("n").alias("further"))
    counted = classes.select("cls", "docs").join(to, "cls", "left").select(
        "cls", (F.col("docs") - 1 + F.coalesce("further", F.lit(0))).alias("links"))
    named = persist(named.join(counted, "cls"), "counted")
    return _rows_of(members, named, F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_pairs(docs: DataFrame, k: int = 5, num: int = 3, den: int = 4) -> tuple[DataFrame, DataFrame]:
    """All links between classes of equal sets (a, b: a < b), and the rows of
    every class (doc_id, rid, cls); rows of one class are linked as well."""
    join, members, classes, named = _joined(docs, k, num, den)
    return join.links(named, classes, pairs=True), members.filter("n_shingles > 0").select("doc_id", "rid", "cls")




def near_duplicate_filter(docs: DataFrame, k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """One row of each component (smallest doc_id, then hash of the text), and
    all rows without words; columns unchanged."""
    found = persist(jaccard_components(docs, k, num, den).filter("n_shingles > 0"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    first = persist(first.select("component", F.col("first.rid").alias("first")), "kept")
    rows = found.join(first, "component")
    gone = persist(rows.filter("rid != first").select("rid").distinct(), "dropped")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    named = docs.select(row, F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string")).alias("rid"))
    named = named.join(broadcast_within(gone, MAX_BROADCAST_ROWS), "rid", "left_anti")
    # equal rows of a document that stays: one of them is enough
    again = persist(rows.filter("rid = first").groupBy("rid").count().filter("count > 1").select("rid"), "again")
    if again.limit(1).count():
        twice = named.join(broadcast_within(again, MAX_BROADCAST_ROWS), "rid", "left_semi").dropDuplicates(["rid"])
        named = named.join(broadcast_within(again, MAX_BROADCAST_ROWS), "rid", "left_anti").unionByName(twice)
    return named.select("row.*")


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    out = jaccard_links(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_shingles", "component_id", "n_links")
