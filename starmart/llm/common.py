"""Helpers shared by the text operators: work tables, word hashing, packing.

Word hashes are xxh3-64 of the word's UTF-8 bytes; every derived name (pairs,
runs, windows, shingles) mixes such hashes, so all executors agree on a name
without a shared dictionary.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import remove, work_path

U = np.uint64
WORD_SPACE = r"[\x20\x09-\x0D]+"
#: Words handled at once inside a task; bounds the numpy working set.
CHUNK_WORDS = 250_000
#: Entries of the per-task word cache before it starts anew.
CACHE_WORDS = 200_000

_C1, _C2, _K = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


#: Rows of text sent to Python at a time. Spark's default suits narrow rows.
TEXT_BATCH = 1000


# ---------------------------------------------------------------- work tables

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ROOTS: set[str] = set()


def new_work_path(spark: SparkSession, name: str) -> str:
    """A path in the application's folder below the shared work folder. Results
    are lazy and read their tables when they are used, so the folder goes when
    the driver ends."""
    root = work_path(spark, "llm", spark.sparkContext.applicationId)
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_remove_root, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _remove_root(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is not None:  # still running
        remove(spark, root)


def persist(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = new_work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of long texts on their way to Python. Changes no result."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_BATCH:
        spark.conf.set(key, str(TEXT_BATCH))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# -------------------------------------------------------------------- memory

def tidy(run):
    """``run`` (batches -> batches) as a task function that gives its memory
    back: Spark keeps Python workers, and what they hold, for later tasks."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return tidied


def release_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim:
        trim(0)


# -------------------------------------------------------------- word hashing

class WordHashes(dict):
    """word bytes -> 64-bit hash, cached; forgets everything when it grows."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=U, count=len(words))


def mix(z: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on a uint64 array."""
    z = (z ^ (z >> U(30))) * _C1
    z = (z ^ (z >> U(27))) * _C2
    return z ^ (z >> U(31))


def pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """Ordered combination of two hash arrays."""
    return mix(a * _K + mix(b + U(salt)))


def windows(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of every ``n`` consecutive entries (len(h) - n + 1 values), from
    windows of doubling length."""
    if len(h) < n:
        return np.empty(0, U)
    with np.errstate(over="ignore"):
        block, size, done, out = h, 1, 0, None
        while True:
            if n & size:
                part = block[done:]
                out = part if out is None else pair(out[:len(part)], part[:len(out)], salt + size)
                done += size
            if done >= n:
                return out[:len(h) - n + 1]
            block, size = pair(block[:-size], block[size:], (1 << 32) + salt + size), size * 2


# ------------------------------------------------------------------- packing

def _planes(c: np.ndarray) -> bytes:
    """All first bytes of the values, then all second ones, ...: compresses better."""
    return np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes()


def pack(raw: list[np.ndarray], packed: list[np.ndarray]) -> bytes:
    """Columns of one length as bytes; ``packed`` ones (sorted ids, positions)
    are compressed, ``raw`` ones (hashes) are not worth it."""
    n = len(raw[0]) if raw else len(packed[0])
    body = b"".join(c.tobytes() for c in raw)
    rest = zstandard.ZstdCompressor(level=1).compress(b"".join(map(_planes, packed))) if packed else b""
    return n.to_bytes(8, "little") + body + rest


def unpack(blob: bytes, raw: list, packed: list) -> list[np.ndarray]:
    n, at, out = int.from_bytes(blob[:8], "little"), 8, []
    for t in raw:
        w = np.dtype(t).itemsize * n
        out.append(np.frombuffer(blob, t, n, at))
        at += w
    if packed:
        rest, at = zstandard.ZstdDecompressor().decompress(blob[at:]), 0
        for t in packed:
            w = np.dtype(t).itemsize
            planes = np.frombuffer(rest, np.uint8, n * w, at).reshape(w, n)
            out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
            at += n * w
    return out


def scatter(bucket: np.ndarray, cols: list[np.ndarray]):
    """Yield (bucket, columns) with the rows of each bucket, order kept."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    cols = [c[order] for c in cols]
    for i, j in zip(cuts, np.r_[cuts[1:], len(b)]):
        yield int(b[i]), [c[i:j] for c in cols]


def record_batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in schema], schema=schema)


def doc_bucket(buckets: int):
    """Bucket of a document, from its id alone (null ids share one bucket)."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of ``df`` (cheap to count: a written table) only if it
    has at most ``max_rows`` rows; beyond that Spark shuffles the join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
