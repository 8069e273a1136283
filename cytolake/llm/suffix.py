"""Removes repeated byte strings by logarithmic families of suffix arrays.

Every window of MIN_LEN bytes has one anchor, the position of its least ANCHOR-byte hash (the leftmost of equal
ones), so equal windows have equal anchors at equal places. Windows with the same anchor form a run; anchors whose
hash occurs once in the corpus cannot repeat, and only runs of the others travel, with their bytes, to the
partition of their hash. There they arrive sorted by hash, in batches. A batch gets two suffix arrays, of the
bytes from the anchor on and of the reversed bytes before it, with their common prefix lengths; a window repeats
if another run shares its part before and its part after the anchor, which the two arrays tell for all runs at
once without comparing pairs. A hash that goes on over several batches keeps an index family: each new batch is
merge-scanned against the levels, and levels of equal size merge. Identical runs stay in a level once. So that no family
outgrows a task, a hash of more than HOT_RUNS runs (a passage that a share of all documents holds, each with other text
around it) sends 128-bit hashes of its runs' windows instead, spread over all partitions and collapsed before they travel;
the result is the same.

Equal texts collapse first and are removed whole if they reach MIN_LEN bytes. Matches never cross documents.

Edge cases: null text counts as empty; texts under MIN_LEN bytes are never touched; repeated rows are equal texts;
overlaps count and all copies go, the first too; a null doc_id is kept; an empty table gives no rows. As text,
what is left drops the bytes of code points that a removal cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import buffer_of, docs_of, lean, mix, partitions, powers, prefix_hash, ragged, range_hash, slices, table
from cytolake.llm.minhash import _key_array, _keys, fresh, key_of

MIN_LEN, ANCHOR = 400, 64
#: For strip(): the least bytes of a passage that repeats, under those of 50 words (of four letters and a blank), and its anchor.
PASSAGE_LEN, PASSAGE_ANCHOR = 240, 32
#: Runs of a hash up to which one task's family of suffix arrays holds them, at about 1.1 KB each; beyond, they go by windows.
HOT_RUNS = 16_384
#: Bytes of one buffer in the anchor pass; its positions must fit PLACE_BITS bits.
BUFFER_BYTES, PLACE_BITS = 1_000_000, 24


def window_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of size values, by prefix and suffix minima of blocks."""
    n = len(values)
    if n < size:
        return values[:0]
    padded = np.full(-(-n // size) * size, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    before = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[: n - size + 1], before[size - 1 : n])


def anchors(data: np.ndarray, off: np.ndarray, min_len: int = MIN_LEN, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Of rows end to end: hash, row, anchor, first and last window start (in the row) of each run of windows with one anchor."""
    size = np.diff(off)
    ok = np.flatnonzero(size >= min_len)
    if not len(ok):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    prefix = prefix_hash(data)
    n = len(data) - anchor + 1
    gram = mix((prefix[anchor:] - prefix[:n]) * powers(n, True))
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = window_minimum(gram & ~low | np.arange(n, dtype=np.uint64), min_len - anchor + 1)
    starts = ragged(off[ok], size[ok] - min_len + 1)
    row = np.repeat(ok, size[ok] - min_len + 1)
    at = (least[starts] & low).astype(np.int64)
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (row[1:] != row[:-1])))
    last = np.append(new[1:], len(at)) - 1
    base = off[row[new]]
    return gram[at[new]].view(np.int64), row[new], at[new] - base, starts[new] - base, starts[last] - base


_RUN = pa.struct([("a", pa.int64()), ("p", pa.int64()), ("q", pa.int64())])


def _anchor_rows(min_len: int, anchor: int):
    """A row for each hash of each text, with all its runs, so that a text that repeats a line costs its hashes one row each."""

    def emit(key, h, row, a, p, q):
        order = np.lexsort((p, h, row))
        h, row, a, p, q = (x[order] for x in (h, row, a, p, q))
        new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
        runs = pa.StructArray.from_arrays([pa.array(a), pa.array(p), pa.array(q)], fields=list(_RUN))
        runs = pa.ListArray.from_arrays(pa.array(np.append(new, len(h)), pa.int32()), runs)
        return pa.RecordBatch.from_arrays([pa.array(h[new]), _key_array(key[row[new]]), runs], names=["h", "key", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=BUFFER_BYTES):
            key = _keys(part.column(0))
            data, off = buffer_of(part.column(1))
            if len(data) <= 2 * BUFFER_BYTES or part.num_rows > 1:
                h, row, a, p, q = anchors(data, off, min_len, anchor)
                if len(h):
                    yield emit(key, h, row, a, p, q)
                continue
            for base in range(0, len(data) - min_len + 1, BUFFER_BYTES):  # one long text, by stretches of window starts
                piece = data[base : base + BUFFER_BYTES + min_len - 1]
                h, row, a, p, q = anchors(piece, np.array([0, len(piece)]), min_len, anchor)
                yield emit(key, h, row, a + base, p + base, q + base)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash, those whose hash has several runs, here or in other rows; holds one row back."""
    held, shown = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        h = batch.column(0).to_numpy()
        same = h[1:] == h[:-1]
        flag = np.append(same, False) | np.append(False, same) | (batch.column(2).value_lengths().to_numpy() > 1)
        if held is not None and shown:
            flag[0] = False  # it has been given already
        shown = bool(flag[-1]) or (len(h) == 1 and shown)
        yield batch.filter(pa.array(flag))
        held = batch.slice(batch.num_rows - 1)


def _marked(hot: int):
    """_repeated() with a mark on the rows of hashes that have more than hot runs; holds back up to that many runs."""

    def give(part: pa.RecordBatch, flag) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(np.broadcast_to(flag, part.num_rows))], names=[*part.schema.names, "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, is_hot, last = [], 0, False, None
        for batch in _repeated(batches):
            if not batch.num_rows:
                continue
            h, runs = batch.column(0).to_numpy(), batch.column(2).value_lengths().to_numpy()
            edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            start, tail = 0, int(edge[-1])
            if h[0] == last:
                start = int(edge[1]) if len(edge) > 1 else len(h)
                size += int(runs[:start].sum())
                held.append(batch.slice(0, start))
                if is_hot or size > hot:
                    yield from (give(x, True) for x in held)
                    held, is_hot = [], True
                if start == len(h):
                    continue
            yield from (give(x, size > hot) for x in held)
            if tail > start:
                e = edge[(edge >= start) & (edge < tail)] - start
                many = np.add.reduceat(runs[start:tail], e) > hot
                yield give(batch.slice(start, tail - start), np.repeat(many, np.diff(np.append(e, tail - start))))
            held, size, is_hot, last = [batch.slice(tail)], int(runs[tail:].sum()), False, h[tail]
        if held:
            yield from (give(x, size > hot) for x in held)

    return run


def _windows(prefix: np.ndarray, base: np.ndarray, p: np.ndarray, q: np.ndarray, min_len: int):
    """Of runs of windows (first and last start p and q, in rows that begin at base): 128 bits of hash of each window, its run and its start."""
    n = q - p + 1
    at = ragged(base + p, n)
    half = min_len // 2
    one = range_hash(prefix, at, at + min_len)
    two = mix(range_hash(prefix, at, at + half) * np.uint64(3) + range_hash(prefix, at + half, at + min_len))
    run = np.repeat(np.arange(len(p)), n)
    return one, two, run, at - base[run]


def _ranges(run: np.ndarray, start: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs and ends of the stretches that windows, by run and start, cover without a gap in their starts."""
    if not len(run):
        return run, start, start
    new = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (start[1:] != start[:-1] + 1)))
    return run[new], start[new], start[np.append(new[1:], len(run)) - 1] + min_len


#: Bytes of distinct runs that a task remembers at a time, and runs of hot hashes whose windows it compares at a time.
SEEN_BYTES, HOT_SLICE = 24_000_000, 512


def _contexts(min_len: int):
    """The runs with their bytes. Of equal runs that a task meets, one goes on; as all their windows repeat, the bytes
    that they cover go along as finished ranges (ctx null, a and p the start and end), dealt by text. A run of a hot hash
    goes on as the hashes of its windows (ctx empty; h and a the hash, p the start), each that some runs share once, with the
    shared ones' ranges finished."""

    def by_windows(key, h, row, p, q, prefix, off) -> Iterator[pa.RecordBatch]:
        for x in range(0, len(p), HOT_SLICE):
            c = slice(x, x + HOT_SLICE)
            own = key[row[c]]
            one, two, run, start = _windows(prefix, off[row[c]], p[c], q[c], min_len)
            order = np.lexsort((two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            first = order[np.append(True, ~same)]
            yield pa.RecordBatch.from_arrays([pa.array(one[first].view(np.int64)), _key_array(own[run[first]]), pa.array(two[first].view(np.int64)), pa.array(start[first]), pa.array([b""] * len(first), pa.binary())], names=["h", "key", "a", "p", "ctx"])
            twice = np.zeros(len(one), bool)
            twice[order] = np.append(same, False) | np.append(False, same)
            r, s, e = _ranges(run[twice], start[twice], min_len)
            if len(r):
                k = own[r]
                yield pa.RecordBatch.from_arrays([pa.array(k.view("<i8")[:, 0].copy()), _key_array(k), pa.array(s), pa.array(e), pa.nulls(len(r), pa.binary())], names=["h", "key", "a", "p", "ctx"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        held = 0
        for part in slices(batches):
            key = _keys(part.column(part.schema.get_field_index("key")))
            data, off = buffer_of(part.column(part.schema.get_field_index("text")))
            hashes = part.column(part.schema.get_field_index("runs"))
            outer = hashes.flatten()
            inner = outer.field("runs")
            n_inner = inner.value_lengths().to_numpy()
            h = np.repeat(outer.field("h").to_numpy(), n_inner)
            row = np.repeat(np.repeat(np.arange(part.num_rows), hashes.value_lengths().to_numpy()), n_inner)
            hot = np.repeat(outer.field("hot").to_numpy(zero_copy_only=False), n_inner)
            prefix = prefix_hash(data) if hot.any() else None
            flat = inner.flatten()
            a, p, q = (flat.field(k).to_numpy() for k in ("a", "p", "q"))
            for x in range(0, len(h), 4096):
                s = slice(x, x + 4096)
                size = q[s] - p[s] + min_len
                raw = data[ragged(off[row[s]] + p[s], size)].tobytes()
                edge = np.append(0, np.cumsum(size))
                go, done = [], []
                for i, (hi, ai, pi, lo, hi_edge, r) in enumerate(zip(h[s].tolist(), a[s].tolist(), p[s].tolist(), edge[:-1].tolist(), edge[1:].tolist(), row[s].tolist(), strict=True)):
                    mark = (hi, ai - pi, raw[lo:hi_edge])
                    first = seen.get(mark)
                    if first is None:
                        seen[mark] = [key[r].tobytes(), pi, hi_edge - lo]
                        held += hi_edge - lo + 300
                        go.append(i)
                        continue
                    if first:
                        done.append((first[0], first[1], first[1] + first[2]))
                        first.clear()
                    done.append((key[r].tobytes(), pi, pi + hi_edge - lo))
                go = np.array(go, np.int64)
                wide = go[hot[s][go]] if prefix is not None else go[:0]
                if len(wide):
                    yield from by_windows(key, h[s][wide], row[s][wide], p[s][wide], q[s][wide], prefix, off)
                    go = go[~hot[s][go]]
                if len(go):
                    ctx = pa.array([raw[edge[i] : edge[i + 1]] for i in go], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(h[s][go]), _key_array(key[row[s][go]]), pa.array(a[s][go]), pa.array(p[s][go]), ctx], names=["h", "key", "a", "p", "ctx"])
                if done:
                    raw_key = np.frombuffer(b"".join(d[0] for d in done), np.uint8).reshape(-1, 16)
                    yield pa.RecordBatch.from_arrays([pa.array(raw_key.view("<i8")[:, 0].copy()), _key_array(raw_key), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()), pa.nulls(len(done), pa.binary())], names=["h", "key", "a", "p", "ctx"])
                if held > SEEN_BYTES:
                    seen.clear()
                    held = 0

    return run


class Level:
    """Runs of windows in suffix order, from the anchor on and backwards from it, with the flags of repeated windows."""

    def __init__(self, h, key, a, left, right, n_left, n_right, min_len, flags=None):
        self.h, self.key, self.a, self.left, self.right, self.n_left, self.n_right, self.min_len = h, key, a, left, right, n_left, n_right, min_len
        self.flags = np.zeros((len(h), left.shape[1] + 1), bool) if flags is None else flags

    @classmethod
    def of(cls, batch: pa.RecordBatch, min_len: int, anchor: int) -> Level:
        h, a, p = (batch.column(batch.schema.get_field_index(k)).to_numpy() for k in "hap")
        data, off = buffer_of(batch.column(batch.schema.get_field_index("ctx")))
        n_left = a - p
        n_right = np.diff(off) - n_left
        at = off[:-1] + n_left
        data = np.append(data, np.uint8(0))
        reach = np.arange(min_len - anchor)
        left = np.where(reach < n_left[:, None], data[np.maximum(at[:, None] - 1 - reach, 0)], 0).astype(np.uint8)
        reach = np.arange(min_len)
        right = np.where(reach < n_right[:, None], data[np.minimum(at[:, None] + reach, len(data) - 1)], 0).astype(np.uint8)
        return cls(h, _keys(batch.column(batch.schema.get_field_index("key"))), a, left, right, n_left, n_right, min_len)

    def __len__(self) -> int:
        return len(self.h)

    def take(self, rows) -> Level:
        return Level(*(x[rows] for x in (self.h, self.key, self.a, self.left, self.right, self.n_left, self.n_right)), self.min_len, self.flags[rows])

    @staticmethod
    def merge(x: Level, y: Level) -> Level:
        names = ("h", "key", "a", "left", "right", "n_left", "n_right")
        return Level(*(np.concatenate([getattr(x, k), getattr(y, k)]) for k in names), x.min_len, np.concatenate([x.flags, y.flags]))

    def _sorted(self, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each run in the suffix array of that side (under its hash), and the common prefix with the run before."""
        head = (self.h.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
        text = np.ascontiguousarray(np.concatenate([head, side], axis=1))
        order = np.argsort(text.view(f"S{text.shape[1]}").reshape(-1), kind="stable")  # linear on sorted runs
        text = text[order]
        common = np.full(len(text), -1)
        if len(text) > 1:
            differ = text[1:] != text[:-1]
            first = np.where(differ.any(1), differ.argmax(1), text.shape[1])
            common[1:] = np.where(first < 8, -1, first - 8)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return place, common

    def scan(self) -> None:
        """Flags every window that two runs share."""
        n = len(self)
        if n < 2:
            return
        l_place, l_common = self._sorted(self.left)
        r_place, r_common = self._sorted(self.right)
        for o in range(self.left.shape[1] + 1):
            rows = np.flatnonzero((o <= self.n_left) & (self.min_len - o <= self.n_right))
            if len(rows) < 2:
                continue
            key = np.cumsum(l_common < o)[l_place[rows]] * (n + 1) + np.cumsum(r_common < self.min_len - o)[r_place[rows]]
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            self.flags[rows[order[1:][same]], o] = True
            self.flags[rows[order[:-1][same]], o] = True

    def found(self) -> pa.RecordBatch:
        """key, start and end of the bytes under flagged windows."""
        f = np.zeros((len(self), self.flags.shape[1] + 2), np.int8)
        f[:, 1:-1] = self.flags
        step = np.diff(f, axis=1)
        row, low = np.nonzero(step == 1)
        high = np.nonzero(step == -1)[1] - 1
        return pa.RecordBatch.from_arrays([_key_array(self.key[row]), pa.array(self.a[row] - high), pa.array(self.a[row] - low + self.min_len)], names=["key", "s", "e"])

    def distinct(self) -> Level:
        """One of identical runs (all of whose windows are flagged by now)."""
        seen = {}
        for i in range(len(self)):
            seen.setdefault((self.n_left[i], self.n_right[i], self.left[i].tobytes(), self.right[i].tobytes()), i)
        return self.take(np.array(list(seen.values())))


class Family:
    """Levels of the hash that the last batch ended in."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def add(self, new: Level) -> Iterator[pa.RecordBatch]:
        if self.levels and self.levels[0].h[0] != new.h[0]:
            self.levels = []
        new.scan()
        going = np.flatnonzero(new.h == new.h[0])
        for i, level in enumerate(self.levels):
            both = Level.merge(level, new.take(going))
            before = both.flags[: len(level)].copy()
            both.scan()
            self.levels[i] = both.take(np.arange(len(level)))
            new.flags[going] |= both.flags[len(level) :]
            yield Level(*(getattr(level, k) for k in ("h", "key", "a", "left", "right", "n_left", "n_right")), level.min_len, both.flags[: len(level)] & ~before).found()
        yield new.found()
        last = new.h[-1]
        rest = new.take(np.flatnonzero(new.h == last)).distinct()
        if last != new.h[0]:
            self.levels = []
        while self.levels and len(self.levels[-1]) <= len(rest):
            rest = Level.merge(self.levels.pop(), rest)
        self.levels.append(rest)


def _twins(held: pa.RecordBatch | None, windows: pa.RecordBatch, min_len: int) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Of windows sorted by hash, after those held of the last hash: key, start and end of each that another one equals,
    and the windows (one, or two if they are given already) to hold for the next batch."""
    if held is not None:
        windows = pa.concat_batches([held, windows])
    one, two, p = (windows.column(windows.schema.get_field_index(k)).to_numpy() for k in "hap")
    same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
    hit = np.append(same, False) | np.append(False, same)
    keep = 2 if len(same) and same[-1] else 1
    key = windows.column(windows.schema.get_field_index("key")).filter(pa.array(hit))
    return pa.RecordBatch.from_arrays([key, pa.array(p[hit]), pa.array(p[hit] + min_len)], names=["key", "s", "e"]), windows.slice(windows.num_rows - keep)


def _match(min_len: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, held = Family(), None
        for batch in batches:
            ctx = batch.column(batch.schema.get_field_index("ctx"))
            empty = pc.fill_null(pc.equal(pc.binary_length(ctx), 0), False)
            windows = batch.filter(empty)
            if windows.num_rows:
                got, held = _twins(held, windows, min_len)
                yield got
                batch = batch.filter(pc.invert(empty))
                ctx = batch.column(batch.schema.get_field_index("ctx"))
            if ctx.null_count:
                ready = batch.filter(ctx.is_null())
                yield pa.RecordBatch.from_arrays([ready.column(ready.schema.get_field_index(k)) for k in ("key", "a", "p")], names=["key", "s", "e"])
                batch = batch.filter(ctx.is_valid())
            for x in range(0, batch.num_rows, 8192):
                for got in family.add(Level.of(batch.slice(x, 8192), min_len, anchor)):
                    if got.num_rows:
                        yield got

    return run


def removed_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of the ranges; ranges that touch are one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(np.flatnonzero(new)[1:], len(end)) - 1]


def _cut(min_len: int, as_text: bool):
    kind = pa.string() if as_text else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            key, n = part.column(part.schema.get_field_index("key")), part.column(part.schema.get_field_index("n")).to_pylist()
            data, off = buffer_of(part.column(part.schema.get_field_index("text")))
            runs = part.column(part.schema.get_field_index("found"))
            size = np.nan_to_num(runs.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            edge = np.append(0, np.cumsum(size))
            flat = runs.flatten()
            s, e = flat.field("s").to_numpy(), flat.field("e").to_numpy()
            out = []
            for i in range(part.num_rows):
                raw = data[off[i] : off[i + 1]]
                a, b = removed_runs(s[edge[i] : edge[i + 1]], e[edge[i] : edge[i + 1]])
                if n[i] > 1 and len(raw) >= min_len:
                    a, b = np.array([0]), np.array([len(raw)])
                stay = b"".join(raw[x:y].tobytes() for x, y in zip(np.append(0, b), np.append(a, len(raw)), strict=True))
                out.append((len(raw), int((b - a).sum()), len(a), hashlib.sha256(stay).hexdigest(), stay.decode("utf-8", "ignore") if as_text else stay))
            cols = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([key, *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), kind), strict=True))], names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup_texts(docs: DataFrame, min_len: int = MIN_LEN, anchor: int = ANCHOR, hot: int = HOT_RUNS, as_text: bool = False) -> DataFrame:
    """A row for each distinct text: key (its digest), n_bytes, n_removed, n_spans, kept_sha256, kept (bytes; as_text: a string of
    the whole code points that are left)."""
    n = partitions(docs.sparkSession)
    texts = docs_of(docs).select(key_of(F.col("text")).alias("key"), "text").groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    kind = "h long, key binary, runs array<struct<a:bigint,p:bigint,q:bigint>>"
    runs = texts.mapInArrow(lean(_anchor_rows(min_len, anchor)), kind).repartition(n, "h").sortWithinPartitions("h").mapInArrow(lean(_marked(hot)), kind + ", hot boolean")
    runs = runs.groupBy("key").agg(F.collect_list(F.struct("h", "runs", "hot")).alias("runs"))
    sent = texts.join(runs.hint("shuffle_hash"), "key").mapInArrow(lean(_contexts(min_len)), "h long, key binary, a long, p long, ctx binary")
    found = sent.repartition(n, "h").sortWithinPartitions("h", "a").mapInArrow(lean(_match(min_len, anchor)), "key binary, s long, e long")
    found = found.groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    return texts.join(found.hint("shuffle_hash"), "key", "left").mapInArrow(lean(_cut(min_len, as_text)), f"key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept {'string' if as_text else 'binary'}")


def dedup(docs: DataFrame, min_len: int = MIN_LEN, anchor: int = ANCHOR, hot: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row."""
    rows = docs_of(docs).select("doc_id", key_of(F.col("text")).alias("key"))
    return rows.join(dedup_texts(docs, min_len, anchor, hot).drop("kept"), "key").drop("key")


def strip(docs: DataFrame, min_len: int = PASSAGE_LEN, anchor: int = PASSAGE_ANCHOR) -> DataFrame:
    """The rows of docs with repeated strings cut from text, n_chars following if it is a column."""
    k, t = fresh(docs, "suffix_key"), fresh(docs, "suffix_text")
    marked = docs.withColumn(k, key_of(F.coalesce(F.col("text").cast("string"), F.lit("")))).drop("text")
    clean = dedup_texts(docs, min_len, anchor, as_text=True)  # by one function: of two in a stage, each keeps a Python worker a core
    got = marked.join(clean.select(F.col("key").alias(k), F.col("kept").alias(t)), k)
    cols = {c: F.col(t) if c == "text" else F.length(t).cast("long") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns}
    return got.select(*(v.alias(c) for c, v in cols.items()))


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
