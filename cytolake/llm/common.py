"""Shared helpers: session folders, batch slicing, and vectorised word and hash primitives over UTF-8 buffers.

Hashes are 64-bit polynomials modulo 2**64 over a random byte table, finished with a bit mixer, so every
executor computes the same value for the same bytes.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytolake.sources.shared import discard, partitions, shared_path

GOLDEN = 0x9E3779B97F4A7C15
BASE = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
#: Bytes of text that one vectorised step handles; bounds the memory of a Python worker.
SLICE_BYTES = 1_000_000


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that spark.checkpoint.dir names."""
    return shared_path(spark, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_of(df: DataFrame) -> DataFrame:
    """doc_id and text alone, null text as empty; other columns, whatever their names, are left behind."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def lean(run):
    """The same batch function, which gives its memory back to the system at the end: Python workers live on between stages."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of BASE, or of its inverse, modulo 2**64."""
    key = "i" if inverse else "p"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        base = pow(BASE, -1, 1 << 64) if inverse else BASE
        out = np.empty(size, np.uint64)
        out[0], done = 1, 1
        while done < size:
            step = min(done, size - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        _powers[key] = have = out
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(len(data)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range [start, end)."""
    n = len(prefix)
    return mix((prefix[end] - prefix[start]) * powers(n, True)[start] + (end - start).astype(np.uint64) * np.uint64(GOLDEN))


def buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary array without nulls."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64) if len(array) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of at most limit bytes of text, or single longer rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = buffer_of(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(off, off[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word (a run without the six ASCII white-space bytes) of rows laid end to end."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~word[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~word[1:]
    start = np.flatnonzero(word & (before | edge[:n]))
    end = np.flatnonzero(word & (after | edge[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def window_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive hash of each run of size consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out *= np.uint64(BASE)
        out += words[i : i + n]
    return mix(out)


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i]+length[i]-1, one after the other."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - at, length)


def sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


def binary(items: list[bytes]) -> pa.Array:
    return pa.array(items, pa.binary())


def sample_share(df: DataFrame, rows: int) -> float:
    """The share of rows to keep for an expected sample of the given size."""
    n = df.count()
    return 1.0 if n <= rows else rows / n


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About rows rows of df (all, if it has no more), by a hash of the key; the same ones on every run."""
    share = sample_share(df, rows)
    return df if share >= 1 else df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)) < int(share * 1_000_000))
