"""Packs token sequences by best-fit decreasing.

Each document is cut into full windows first; a document's rest goes, longest first, into the open window with
the least room that still holds it. A segment tree over the remaining room finds that window. Pieces are dealt by
a hash into groups whose number follows the number of documents, and a group packs alone: it costs at most a few
part-filled windows, whatever the corpus' size.

Edge cases: null text counts as empty, a document of one closing id; repeated rows are pieces of their own; a null
doc_id is kept; ties in length go by doc_id, start and checksum; an empty table gives no rows; a document longer
than many windows stays whole across full windows; a string that the vocabulary marks as special (such as `<|endoftext|>`)
becomes its own id wherever it stands, as the tokenizers library does by default.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import buffer_of, docs_of, lean, prefix_hash, ragged, range_hash, slices, table, word_spans

WINDOW = 2048
CLOSING_ID = 1
#: Documents in a packing group, on average.
GROUP_DOCS = 32_768
#: Distinct chunks that a task remembers at a time.
MEMO_CHUNKS = 500_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def _loaded(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer(path: str, with_marks: bool = True):
    """The file's tokenizer, the only copy in a process; with_marks holds until the next call."""
    t = _loaded(path)
    t.encode_special_tokens = not with_marks  # then their strings in a text are ordinary text
    return t


@functools.cache
def marks(path: str) -> list[str]:
    """Strings that the vocabulary turns into ids of their own wherever they stand in a text."""
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


@functools.cache
def by_chunks(path: str) -> bool:
    """Does the vocabulary file normalise and split texts as ChunkEncoder takes for granted?"""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    return (said.get("normalizer"), said.get("pre_tokenizer"), said.get("post_processor")) == (NORMALIZER, PRE_TOKENIZER, None)


#: Of the vocabularies that ChunkEncoder can read; fixed values.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(97, 123)]] = True
TAIL = np.zeros(256, bool)
TAIL[[c for c in range(33, 127) if not chr(c).isalnum() and c != ord("'")]] = True


class ChunkEncoder:
    """Encodes each distinct chunk once. The vocabulary lowers case, drops white space and splits at it, and splits
    between a letter or digit and other signs, so a text's ids are those of its chunks: ASCII-lowered words, and the
    signs that end a word after an ASCII letter or digit. What else it splits is left to the tokenizer. It does not know
    the vocabulary's marks; encode_rows keeps texts with one from it."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}  # by 64-bit hash
        self.ids, self.start = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.used = 0

    def _learn(self, fresh: list[bytes]) -> None:
        """Encodes new chunks as one text, which spares a call for each, and cuts the ids at the chunks' places."""
        texts = [c.decode() for c in fresh]
        place = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        got = tokenizer(self.path, False).encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(got.ids, np.uint32)
        at = np.fromiter((a for a, _ in got.offsets), np.int64, len(ids))
        counts = np.bincount(np.searchsorted(place, at, "right") - 1, minlength=len(texts))
        first, need = len(self.index) - len(fresh), self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need, len(self.ids)), np.uint32)])
        if len(self.index) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros(len(self.index) + len(self.start), np.int64)])
        self.ids[self.used : need] = ids
        self.start[first + 1 : len(self.index) + 1] = self.used + np.cumsum(counts)
        self.used = need

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows end to end: all ids, and the number of ids of each row."""
        n = len(off) - 1
        data = LOWER[data]
        start, end, doc = word_spans(data, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        middle = np.maximum.accumulate(np.where(TAIL[data], -1, np.arange(len(data))))[end - 1] + 1
        two = np.flatnonzero((middle > start) & (middle < end) & ALNUM[data[np.maximum(middle, 1) - 1]])
        begin = np.concatenate([start, middle[two]])
        stop = np.concatenate([end, end[two]])
        stop[two] = middle[two]
        order = np.argsort(begin)
        begin, stop, doc = begin[order], stop[order], np.concatenate([doc, doc[two]])[order]
        h, one, where = np.unique(range_hash(prefix_hash(data), begin, stop), return_index=True, return_inverse=True)
        if len(self.index) > MEMO_CHUNKS:
            self.clear()
        index, before = self.index, len(self.index)
        at = np.fromiter((index.setdefault(x, len(index)) for x in h.tolist()), np.int64, len(h))
        new = np.flatnonzero(at >= before)
        if len(new):
            raw = data.tobytes()
            self._learn([raw[a:b] for a, b in zip(begin[one[new]].tolist(), stop[one[new]].tolist(), strict=True)])
        at = at[where]
        length = self.start[at + 1] - self.start[at]
        return self.ids[ragged(self.start[at], length)], np.bincount(doc, weights=length, minlength=n).astype(np.int64)


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("salt", pa.int64()), ("ids", pa.binary())])


def encode_rows(encode: ChunkEncoder, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text. Texts that hold one of the vocabulary's marks, and all texts of a vocabulary of another kind, go to the tokenizer itself."""
    path, plain = encode.path, pa.array(np.full(len(texts), by_chunks(encode.path)))
    for mark in marks(path):
        plain = pc.and_not(plain, pc.match_substring(texts, mark))
    ids, counts = encode(*buffer_of(pc.if_else(plain, texts, "")))
    edge = np.append(0, np.cumsum(counts))
    for i, alone in enumerate(plain.to_pylist()):
        yield ids[edge[i] : edge[i + 1]] if alone else np.array(tokenizer(path).encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)


def _cut(path: str, window: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, n = ChunkEncoder(path), 0
        for part in slices(batches, limit=1_000_000):
            rows = []
            for doc, ids in zip(part.column(0).to_pylist(), encode_rows(encode, part.column(1)), strict=True):
                own = np.append(ids, np.uint32(CLOSING_ID)).astype("<u4")
                for a in range(0, len(own), window):
                    piece = own[a : a + window].tobytes()
                    rows.append((doc, a, len(piece) // 4, zlib.crc32(piece), len(own), n, piece if with_ids else None))
                    n += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return run


class RoomTree:
    """Segment tree over remaining room 0..size: counts of open windows, and the least room of at least so much."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, least: int) -> int:
        """The least room >= least that an open window has; -1 if none has."""
        i = least + self.leaves
        if self.count[i]:
            return least
        while i > 1:
            if not i & 1 and self.count[i + 1]:  # the nearest subtree to the right with an open window
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece; lengths must not grow."""
    tree, open_at = RoomTree(window), [[] for _ in range(window + 1)]
    sequence, offset, made = [], [], 0
    for n in lengths:
        room = tree.tightest(n) if n < window else -1
        if room < 0:
            s, room = made, window
            made += 1
        else:
            s = open_at[room].pop()
            tree.add(room, -1)
        sequence.append(s)
        offset.append(window - room)
        if room > n:
            open_at[room - n].append(s)
            tree.add(room - n, 1)
    return sequence, offset


def _fill(window: int):
    def run(key: tuple, pieces: pa.Table) -> pa.Table:
        order = pc.sort_indices(pieces, [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending"), ("salt", "ascending")])
        pieces = pieces.take(order)
        sequence, offset = best_fit(pieces["length"].to_pylist(), window)
        out = pieces.drop_columns(["salt", "grp"])
        out = out.append_column("sequence_id", pa.array((np.int64(key[0].as_py()) << 40) + np.array(sequence, np.int64)))
        return out.append_column("offset", pa.array(np.array(offset, np.int64)))

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, group_docs: int = GROUP_DOCS, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, ids (null unless with_ids), sequence_id, offset."""
    docs = docs_of(docs)
    groups = -(-docs.select("doc_id").count() // group_docs) or 1
    pieces = docs.mapInArrow(lean(_cut(vocabulary or default_vocabulary(), window, with_ids)), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long, ids binary")
    pieces = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "salt"), F.lit(groups)).cast("int"))
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, sequence_id long, offset long"
    return pieces.groupBy("grp").applyInArrow(_fill(window), out)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
