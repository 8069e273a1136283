"""Byte-level BPE by a global shuffle of distinct words.

A task cuts its documents into pre-tokens and keeps, for a block of whole documents, the distinct pre-tokens and
for each position the rank of its pre-token in the block. Distinct pre-tokens go, one entry for each block, to the
bucket of their hash; a bucket encodes each distinct word once and answers each block with the ids. The position
stream stays in its own partition, where the answers join it; texts are never shuffled and a word that fills
the corpus costs one entry for each block. Decoding joins the ids with the token-byte table, whose size the
vocabulary fixes.

Edge cases: null text counts as empty and gives no tokens; a repeated row gives a row each time; null doc_id is
kept; texts of any length stay whole (a block is at least one document); an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import buffer_of, docs_of, lean, partitions, ragged, slices, table

#: Bytes of text in a block, at which a task closes it.
BLOCK_BYTES = 8_000_000
#: Words that a bucket's task remembers at a time.
MEMO_WORDS = 400_000


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


@functools.cache
def token_table(path: str) -> pa.Array:
    """Bytes of each id, null where the id is free."""
    ranks = load_ranks(path)
    out: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return pa.array(out, pa.large_binary())


def decode_ids(ids: np.ndarray, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Joins ids with the token table: the bytes one after the other, and the offset of each id."""
    if len(ids) and int(ids.max()) >= len(tokens) or (got := tokens.take(pa.array(ids))).null_count:
        raise ValueError("an id is not in the token table")
    return buffer_of(got)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays behind their lengths, compressed; wide integers by byte plane."""
    parts = []
    for a in arrays:
        raw = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        parts += [np.array([len(raw)], "<u8").tobytes(), raw]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    out, at = [], 0
    for kind in kinds:
        n = int(np.frombuffer(data, "<u8", 1, at)[0])
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n, at + 8).reshape(width, n // width)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += 8 + n
    return out


class _Block:
    """Distinct pre-tokens and positions of a run of whole documents."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.stream: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.bytes = 0

    def add(self, doc_ids: list, texts: list[str], find) -> None:
        found = [find(t) for t in texts]
        self.ids += doc_ids
        self.counts += map(len, found)
        self.bytes += sum(map(len, texts))
        local = pa.array([w for f in found for w in f], pa.large_string()).dictionary_encode()
        words = self.words
        index = np.fromiter((words.setdefault(w, len(words)) for w in local.dictionary.to_pylist()), np.uint32, len(local.dictionary))
        self.stream.append(index[local.indices.to_numpy()] if len(local) else np.zeros(0, np.uint32))

    def rows(self, routes: list[int]) -> Iterator[tuple[int, int, int, int, bytes]]:
        """route, kind, block, bucket, payload: the stream (kind 0) and a list of words for each bucket (kind 1)."""
        buckets = len(routes)
        stream = np.concatenate(self.stream) if self.stream else np.zeros(0, np.uint32)
        raw = [w.encode("utf-8", "surrogatepass") for w in self.words]
        order = np.argsort(-np.bincount(stream, minlength=len(raw)), kind="stable")  # frequent words get short ranks
        rank = np.empty(len(raw), np.uint32)
        rank[order] = np.arange(len(raw), dtype=np.uint32)
        bucket = np.fromiter((zlib.crc32(raw[i]) % buckets for i in order), np.uint32, len(raw))
        known = np.array([x is not None for x in self.ids], np.uint8)
        payload = _pack(np.array([x or 0 for x in self.ids], np.int64), known, np.array(self.counts, np.uint32), bucket, rank[stream] if len(stream) else stream)
        block = int(np.uint64(xxhash.xxh3_64_intdigest(payload)).astype(np.int64))
        yield block, 0, block, 0, payload
        by = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            mine = [raw[order[i]] for i in by[edges[b] : edges[b + 1]]]
            yield routes[b], 1, block, int(b), _pack(np.fromiter(map(len, mine), np.uint32, len(mine)), np.frombuffer(b"".join(mine), np.uint8))


_OUT = pa.schema([("route", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _explode(routes: list[int], pattern: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, block = regex.compile(pattern).findall, _Block()
        for part in slices(batches, limit=1_000_000):
            block.add(part.column(0).to_pylist(), part.column(1).to_pylist(), find)
            if block.bytes >= block_bytes:
                yield _batch(list(block.rows(routes)), _OUT)
                block = _Block()
        if block.ids:
            yield _batch(list(block.rows(routes)), _OUT)

    return run


_ANSWER = pa.schema([("route", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())])


def _encode_words(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memo = encoder(path, pattern)._encode_single_piece, {}
        for batch in batches:
            for block, bucket, payload in zip(*(batch.column(k) for k in ("block", "bucket", "payload")), strict=True):
                lengths, data = _unpack(payload.as_py(), "<u4", "u1")
                raw, at, out = data.tobytes(), 0, []
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                for n in lengths.tolist():
                    w = raw[at : at + n]
                    at += n
                    ids = memo.get(w)
                    if ids is None:
                        ids = memo[w] = np.array(encode(w), "<u4").tobytes()
                    out.append(ids)
                ids = np.frombuffer(b"".join(out), "<u4")
                yield _batch([(block.as_py(), bucket.as_py(), _pack(np.fromiter(map(len, out), np.uint32, len(out)) // np.uint32(4), ids))], _ANSWER)

    return run


_TOKENS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def _reassemble(path: str, out_bytes: int = 2_000_000):
    def rows(streams: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        tokens = token_table(path)
        got = {b: i for i, b in enumerate(answers.column("bucket").to_pylist())}
        for payload in streams.column("payload"):
            ids, known, counts, bucket, stream = _unpack(payload.as_py(), "<i8", "u1", "<u4", "<u4", "<u4")
            present = np.unique(bucket)
            if any(int(b) not in got for b in present):
                raise RuntimeError("the ids of a block are incomplete; the job must run again")
            parts = [_unpack(answers.column("payload")[got[int(b)]].as_py(), "<u4", "<u4") for b in present]
            by = np.argsort(bucket, kind="stable")
            length = np.empty(len(bucket), np.int64)
            start = np.empty(len(bucket), np.int64)
            if len(by):
                n = np.concatenate([p[0] for p in parts]).astype(np.int64)
                length[by], start[by] = n, np.cumsum(n) - n
            flat = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint32)
            edge = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            size = np.concatenate([[0], np.cumsum(length[stream])])
            a = 0
            while a < len(counts):  # documents whose ids fill one output batch
                b = int(np.searchsorted(size[edge], size[edge[a]] + out_bytes // 4, "right")) - 1
                b = min(max(b, a + 1), len(counts))
                words = stream[edge[a] : edge[b]]
                out = flat[ragged(start[words], length[words])]
                data, off = decode_ids(out, tokens)
                cut = size[edge[a : b + 1]] - size[edge[a]]
                le, dec = out.astype("<u4"), off[cut]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[a:b], pa.int64(), mask=known[a:b] == 0),
                        pa.array(np.diff(cut), pa.int64()),
                        pa.array([le[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary()),
                        pa.array([data[x:y].tobytes() for x, y in zip(dec, dec[1:])], pa.binary()),
                    ],
                    schema=_TOKENS,
                )
                a = b

    return lambda streams, answers: pa.Table.from_batches(rows(streams, answers), _TOKENS)


def routes_of(spark, n: int) -> list[int]:
    """For each of n partitions a value that hash partitioning sends there, so that buckets do not meet in one partition. Bounded by the number of partitions."""
    got: dict[int, int] = {}
    size = 32 * n
    while len(got) < n:
        got = {r.p: r.id for r in spark.range(size).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()}
        size *= 2
    return [got[p] for p in range(n)]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded (bytes of the ids) of each document."""
    path, pattern = path or default_paths()[0], pattern or default_paths()[1]
    n = partitions(docs.sparkSession)
    sent = docs_of(docs).mapInArrow(lean(_explode(routes_of(docs.sparkSession, n), pattern, block_bytes)), "route long, kind int, block long, bucket int, payload binary").repartition(n, "route")
    # rand() keeps the filter above the exchange, which both branches then share.
    kind = F.col("kind") + (F.rand(1) * 0).cast("int")
    # Both branches keep all columns, so that Spark finds their exchanges equal and runs one.
    streams, answers = sent.where(kind == 0), sent.where(kind == 1).mapInArrow(lean(_encode_words(path, pattern)), "route long, bucket int, payload binary")
    return streams.groupBy("route").cogroup(answers.groupBy("route")).applyInArrow(_reassemble(path), "doc_id long, n_tokens long, ids binary, decoded binary")


def token_ids(encoded: DataFrame) -> DataFrame:
    """The ids of encode() as array<long>, by built-in functions."""
    at = F.sequence(F.lit(1), F.col("n_tokens").cast("int"))
    byte = lambda i, k: F.conv(F.hex(F.substring("ids", i * 4 - F.lit(k), F.lit(1))), 16, 10).cast("long")
    ids = F.when(F.col("n_tokens") > 0, F.transform(at, lambda i: byte(i, 3) + byte(i, 2) * 256 + byte(i, 1) * 65536 + byte(i, 0) * 16777216)).otherwise(F.array().cast("array<long>"))
    return encoded.withColumn("token_ids", ids)


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    got = encode(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
