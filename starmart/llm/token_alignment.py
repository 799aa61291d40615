"""Cross-tokenizer alignment (op13): which tokens of two tokenizers cover the
same bytes of a text, and how often each pair of ids is linked in the corpus.

Method. A text is encoded by both tokenizers; the token bytes of each side give
cumulative ends. A dictionary per side maps an end to the number of tokens up
to it; the ends in both key sets (a hash-set intersection), sorted, slice both
id lists into groups, and the links of a group are all pairs of its slices.

Spark's part. A task deals its documents into units of about ``UNIT_LINKS``
links. Each unit is written once, with the distinct id pairs of each document
and their multiplicity as packed columns. Units then send plain rows (unit, a,
b, documents): one per distinct pair, however many documents hold it. They are
summed per pair, the highest count of every A id is taken (at most one row per
vocabulary entry, so that table is broadcast), and the rows are joined with the
counts and meet their unit again. No task holds more than a unit, a pair that
is in every document costs one row per unit, and such a pair's rows may be
split by Spark, since a count is one row.

Tokenizer files are read once on the driver (their paths are parameters, their
size is checked) and broadcast. A byte-level BPE whose ids are in merge order is
run by tiktoken, several times as fast as the tokenizers library, which runs
any other and whatever tiktoken refuses; a test holds them equal.

Odd rows. A null or empty text, and one that either side does not give back
byte for byte (the text holds U+2581, or white space that a normalizer drops),
has no tokens: all counts 0, ``groups_sha256`` empty. Repeated rows and repeated
or null ids are documents of their own. A group without a common end inside is
one group, however long: its pairs are counted by distinct ids, not expanded.
Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import pack, persist, record_batch, small_batches, table, tidy, unpack

FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Links of a unit, and links expanded at once; bound a task's memory, change no result.
UNIT_LINKS = 1_000_000
#: Bytes of text encoded at a time, unless one text is longer.
ENCODE_BYTES = 1 << 20
#: A group with more links is counted by its distinct ids.
WIDE_GROUP = 1024
#: A tokenizer file may have so many bytes, and ids below 2 ** ID_BITS.
MAX_FILE_BYTES, ID_BITS = 32 << 20, 20

# Fixed value: the split of the public byte-level BPE vocabularies.
BYTE_BPE_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


BYTE_PIECE = re.compile("<0x[0-9A-F]{2}>")


# ----------------------------------------------------------------- tokenizers

def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePieces:
    """A byte-level BPE of the tokenizers library (a .json file)."""

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        spec, alphabet = json.loads(blob), _byte_of_char()
        self.slow = Tokenizer.from_str(blob.decode())
        self.slow.encode_special_tokens = True
        vocab = spec["model"]["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))]) + 1
        self.bytes = [b""] * size
        for t in spec.get("added_tokens", []):
            self.bytes[t["id"]] = t["content"].encode()
        for token, i in vocab.items():
            if all(c in alphabet for c in token):
                self.bytes[i] = bytes(alphabet[c] for c in token)
        self.fast = self._ranked(spec, vocab)

    def _ranked(self, spec: dict, vocab: dict):
        """The same vocabulary by ranks, if its ids are in merge order and its
        text is split the public way; else None."""
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {self.bytes[i]: i for t, i in vocab.items() if t not in added}
        known = (split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
                 and not spec.get("normalizer") and not model.get("ignore_merges")
                 and merged == sorted(set(merged)) and all(bytes([b]) in ranks for b in range(256)))
        if not known:
            return None
        import tiktoken

        return tiktoken.Encoding("ranked", pat_str=BYTE_BPE_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        texts = [" " + t for t in texts]
        if self.fast is not None:
            try:
                return [self.fast.encode_ordinary(t) for t in texts]
            except BaseException as e:  # a panic of the library is no Exception: a text it cannot split
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return [x.ids for x in self.slow.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model with byte fallback (a .model file), which adds the space itself."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            byte = BYTE_PIECE.fullmatch(piece) and self.model.is_byte(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(2)
def _load(blob: bytes):
    """A tokenizer with, per id, its bytes, their number and the id as text; kept
    for the later tasks of a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = BytePieces(blob) if blob[:1] == b"{" else Pieces(blob)
    if len(t.bytes) > 1 << ID_BITS:
        raise ValueError(f"a vocabulary of {len(t.bytes)} ids; at most {1 << ID_BITS}")
    t.size = np.array([len(b) for b in t.bytes], np.int64)
    t.name = [str(i) for i in range(len(t.bytes))]
    return t


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        blob = f.read(MAX_FILE_BYTES + 1)
    if len(blob) > MAX_FILE_BYTES:
        raise ValueError(f"{path} has more than {MAX_FILE_BYTES} bytes")
    return blob


# ------------------------------------------------------------------ alignment

def cuts(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Numbers of A and of B tokens up to each common end, in order."""
    index_a = dict(zip(ends_a, itertools.count(1)))
    index_b = dict(zip(ends_b, itertools.count(1)))
    common = list(filter(index_a.__contains__, index_b))  # keys of B in B's own order, so sorted
    return list(map(index_a.__getitem__, common)), list(map(index_b.__getitem__, common))


def _text_of(names_a: list[str], names_b: list[str], at_a: list[int], at_b: list[int]) -> str:
    out, i, j = [], 0, 0
    add = out.append
    for k, m in zip(at_a, at_b):
        a = names_a[i] if k - i == 1 else ",".join(names_a[i:k])
        b = names_b[j] if m - j == 1 else ",".join(names_b[j:m])
        add(f"{a}|{b}")
        i, j = k, m
    return ";".join(out)


def _reduce(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of their multiplicities."""
    k, t = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(t[order], first) if len(k) else t


def pair_counts(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (a << ID_BITS | b) of the links, and how many links have each."""
    from_a, from_b = np.r_[0, at_a[:-1]], np.r_[0, at_b[:-1]]
    n_a, n_b = at_a - from_a, at_b - from_b
    wide = n_a * n_b > WIDE_GROUP
    keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for g in np.flatnonzero(wide):
        x, u = np.unique(a[from_a[g]:at_a[g]], return_counts=True)
        y, v = np.unique(b[from_b[g]:at_b[g]], return_counts=True)
        for lo in range(0, len(x), max(1, UNIT_LINKS // len(y))):
            part = slice(lo, lo + max(1, UNIT_LINKS // len(y)))
            keys.append((x[part, None] << ID_BITS | y[None, :]).ravel())
            times.append((u[part, None] * v[None, :]).ravel())
            if sum(map(len, keys)) > 2 * UNIT_LINKS:
                keys, times = map(lambda z: [z], _reduce(keys, times))
    single = n_a * n_b == 1
    keys.append(a[from_a[single]] << ID_BITS | b[from_b[single]])
    times.append(np.ones(len(keys[-1]), np.int64))
    from_a, from_b, n_a, n_b = (z[~(wide | single)] for z in (from_a, from_b, n_a, n_b))
    ends = np.cumsum(n_a * n_b)
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + UNIT_LINKS, "right")))
        n = n_a[lo:hi] * n_b[lo:hi]
        width = np.repeat(n_b[lo:hi], n)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        keys.append(a[np.repeat(from_a[lo:hi], n) + place // width] << ID_BITS | b[np.repeat(from_b[lo:hi], n) + place % width])
        times.append(np.ones(len(place), np.int64))
        if hi < len(ends):
            keys, times = map(lambda z: [z], _reduce(keys, times))
        lo = hi
    return _reduce(keys, times)


class Aligned:
    """One document: its counts, digest and distinct pairs."""

    def __init__(self, text: str | None, a, b, ids_a: list[int], ids_b: list[int]):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest, self.keys, self.times = "", np.empty(0, np.int64), np.empty(0, np.int64)
        whole = b" " + text.encode() if text else b""
        if not text or b"".join(map(a.bytes.__getitem__, ids_a)) != whole or b"".join(map(b.bytes.__getitem__, ids_b)) != whole:
            return
        x, y = np.fromiter(ids_a, np.int64, len(ids_a)), np.fromiter(ids_b, np.int64, len(ids_b))
        at_a, at_b = cuts(np.cumsum(a.size[x]).tolist(), np.cumsum(b.size[y]).tolist())
        shown = _text_of(list(map(a.name.__getitem__, ids_a)), list(map(b.name.__getitem__, ids_b)), at_a, at_b)
        self.digest = hashlib.sha256(shown.encode()).hexdigest()
        ends_a, ends_b = np.fromiter(at_a, np.int64, len(at_a)), np.fromiter(at_b, np.int64, len(at_b))
        self.n_a, self.n_b, self.n_groups = len(ids_a), len(ids_b), len(at_a)
        self.n_links = int((np.diff(ends_a, prepend=0) * np.diff(ends_b, prepend=0)).sum())
        self.keys, self.times = pair_counts(x, y, ends_a, ends_b)


# ----------------------------------------------------------------------- jobs

UNITS = pa.schema([("unit", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("digest", pa.list_(pa.string())), ("blob", pa.binary())])
PAIRS = pa.schema([("unit", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                    ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
UNITS_SQL = "unit long, doc_id array<long>, digest array<string>, blob binary"
PAIRS_SQL = "unit long, a int, b int, n long"
RESULT_SQL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")
_HEAD = [np.int64] * 5  # tokens of A and B, groups, links, distinct pairs


def _aligned(batches, a, b):
    """(doc_id, Aligned) of every row, encoded in lots of bounded size."""
    for batch in batches:
        ids, lot, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            ids.append(doc_id)
            lot.append(text)
            size += len(text or "")
            if size >= ENCODE_BYTES:
                yield from _encoded(ids, lot, a, b)
                ids, lot, size = [], [], 0
        yield from _encoded(ids, lot, a, b)


def _encoded(ids, lot, a, b):
    full = [t for t in lot if t]
    sides = iter(zip(a.encode(full), b.encode(full))) if full else iter(())
    for doc_id, text in zip(ids, lot):
        yield doc_id, Aligned(text, a, b, *(next(sides) if text else ([], [])))


def _unit_row(name: int, ids: list, docs: list[Aligned]) -> pa.RecordBatch:
    keys, index = np.unique(np.concatenate([d.keys for d in docs]), return_inverse=True)
    head = pack([], [np.array(c, np.int64) for c in zip(*((d.n_a, d.n_b, d.n_groups, d.n_links, len(d.keys)) for d in docs))])
    seen = np.bincount(index, minlength=len(keys)).astype(np.int64)
    names = pack([], [np.diff(keys, prepend=0), seen])
    body = pack([], [index.astype(np.uint32), np.concatenate([d.times for d in docs])])
    blob = b"".join(len(x).to_bytes(8, "little") + x for x in (head, names, body))
    return record_batch(UNITS, unit=[name], doc_id=[ids], digest=[[d.digest for d in docs]], blob=[blob])


def _parts(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 8], "little")
        out.append(blob[at + 8:at + 8 + n])
        at += 8 + n
    return out


def _open_names(part: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, seen = unpack(part, [], [np.int64, np.int64])
    return np.cumsum(steps), seen


def _units(files):
    def run(batches):
        from pyspark import TaskContext

        a, b = (_load(f) for f in files.value)
        base, k, ids, docs, links = TaskContext.get().partitionId() << 32, 0, [], [], 0
        for doc_id, doc in _aligned(batches, a, b):
            ids.append(doc_id)
            docs.append(doc)
            links += len(doc.keys) + 8
            if links >= UNIT_LINKS:
                yield _unit_row(base + k, ids, docs)
                k, ids, docs, links = k + 1, [], [], 0
        if ids:
            yield _unit_row(base + k, ids, docs)
    return run


def _unit_pairs(batches):
    low = (1 << ID_BITS) - 1
    for batch in batches:
        for unit, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys, seen = _open_names(_parts(blob)[1])
            for at in range(0, len(keys), 50_000):
                k, n = keys[at:at + 50_000], seen[at:at + 50_000]
                yield record_batch(PAIRS, unit=np.full(len(k), unit), a=(k >> ID_BITS).astype(np.int32), b=(k & low).astype(np.int32), n=n)


def _answers(units: pa.Table, counts: pa.Table) -> pa.Table:
    """Rows of one unit's documents from the corpus-wide counts of its pairs."""
    ids, digests, blob = (units.column(c)[0] for c in ("doc_id", "digest", "blob"))
    head, names, body = _parts(blob.as_py())
    n_a, n_b, n_groups, n_links, n_keys = unpack(head, [], _HEAD)
    keys, _ = _open_names(names)
    total, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    if len(keys):
        asked = (counts.column("a").to_numpy().astype(np.int64) << ID_BITS) | counts.column("b").to_numpy()
        at = np.searchsorted(keys, asked)
        total[at], best[at] = counts.column("total").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    index, times = unpack(body, [], [np.uint32, np.int64])
    doc = np.repeat(np.arange(len(n_keys)), n_keys)
    links_best, links_sum = np.zeros(len(n_keys), np.int64), np.zeros(len(n_keys), np.int64)
    np.add.at(links_best, doc, times * best[index])
    np.add.at(links_sum, doc, times * total[index])
    cols = {"doc_id": ids.values, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
            "n_best": links_best, "count_sum": links_sum, "groups_sha256": digests.values}
    return pa.Table.from_arrays([pa.array(cols[f.name], type=f.type) for f in RESULT], schema=RESULT)


def align(docs: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """One row per document: tokens, groups and links of both tokenizers, the
    links that are their A id's most frequent ones, the sum of the links' counts
    and the digest of the groups."""
    spark = docs.sparkSession
    small_batches(spark)
    files = spark.sparkContext.broadcast((read_file(file_a), read_file(file_b)))
    units = persist(docs.select("doc_id", "text").mapInArrow(tidy(_units(files)), UNITS_SQL), "token-units")
    pairs = units.select("unit", "blob").mapInArrow(tidy(_unit_pairs), PAIRS_SQL)
    counts = persist(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")), "token-pairs")
    # at most one row per id of A (2 ** ID_BITS)
    highest = counts.groupBy("a").agg(F.max("total").alias("most"))
    known = counts.join(F.broadcast(highest), "a").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    asked = pairs.select("unit", "a", "b").join(known, ["a", "b"])
    return units.groupBy("unit").cogroup(asked.groupBy("unit")).applyInArrow(_answers, RESULT_SQL)


def op13_token_alignment(spark: SparkSession, sf_dir: str, folder: str = FOLDER) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), f"{folder}/{FILE_A}", f"{folder}/{FILE_B}")
