"""Near duplicates by ProbMinHash over weighted word shingles.

A text is its runs of five words (a shorter text is one run), weighted by how often each occurs. Each shingle's
arrivals form a Poisson process whose rate is its weight; an arrival falls on a random register, a register keeps
the earliest arrival's shingle, and a shingle stops once its next arrival is later than every register's. The share
of equal registers estimates the probability Jaccard similarity. Bands of registers deal texts into buckets.

In a bucket each text is first paired with the bucket's leader alone; four orders of texts take turns over the bands,
so that a text meets several leaders. These pairs are verified, by the exact probability Jaccard similarity of the whole
texts, and joined to classes. A bucket whose other texts are then of one class is done: each of its pairs is verified, or
its texts are in one class already. The texts of the others are cut into blocks of at most about BLOCK texts or BLOCK_BYTES,
and every pair of blocks is searched for pairs of different classes. Classes are the connected components of the verified pairs.

Equal texts collapse first, by digest, with partial aggregation, so that a large group of copies costs one text. A
bucket is read as a sorted stream and needs no memory; a leader with many members is repeated for each SALT_EVERY
of them. A pair of blocks is a task's unit of work, of bounded memory; the number of them grows with the square of the blocks
of a bucket that no class joins, and only of such a bucket. Components come from joins on written tables; nothing of them reaches the driver but a count.

Edge cases: null text counts as empty; texts without words are alike only to equal ones; equal texts, empty ones
too, are always one class; class_id is the least doc_id of the class (nulls aside, null if there is none); repeated
rows give a row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import BASE, GOLDEN, buffer_of, discard, docs_of, lean, mix, partitions, prefix_hash, ragged, range_hash, shared_dir, slices, table, window_hash, word_spans

WORDS, THRESHOLD = 5, 0.8
REGISTERS, BANDS = 128, 32
SALT_EVERY = 512
#: Texts, and bytes of text, in a block of a bucket that holds several classes.
BLOCK, BLOCK_BYTES = 512, 2_000_000
#: Keys that a task remembers, to send a text that it meets again once.
SEEN_KEYS = 200_000


def shingles(data: np.ndarray, off: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each shingle occurrence, by row."""
    start, end, doc = word_spans(data, off)
    words = range_hash(prefix_hash(data), start, end)
    run = window_hash(words, size)
    inside = np.flatnonzero(doc[: len(run)] == doc[size - 1 :]) if len(run) else np.zeros(0, np.int64)
    out, row = [run[inside]], [doc[inside]]
    count = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(count) - count
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            out.append(window_hash(words, n)[first[short]])
            row.append(short)
    h, r = np.concatenate(out), np.concatenate(row)
    order = np.argsort(r, kind="stable")
    return h[order], r[order]


def weighted(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row, with counts, ordered by row and hash."""
    if not len(h):
        return h, row, np.zeros(0)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
    return h[new], row[new], np.diff(np.append(new, len(h))).astype(float)


def signatures(elem: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """The shingle in each register of each row; zeros for rows without shingles."""
    best = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, np.uint64)
    alone = np.bincount(row, minlength=n) == 1
    for i in np.flatnonzero(alone[row]):  # one shingle takes every register
        kept[row[i] * registers : (row[i] + 1) * registers] = elem[i]
    act = np.flatnonzero(~alone[row])
    time, turn = np.zeros(len(elem)), 0
    limit = np.full(n, np.inf)
    while len(act):
        turn += 1
        r = mix(elem[act] + np.uint64(turn * GOLDEN & (1 << 64) - 1))
        time[act] -= np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / weight[act]
        on = time[act] < limit[row[act]]
        act, r = act[on], r[on]
        slot = row[act] * registers + (mix(r) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, slot, time[act])
        won = best[slot] == time[act]
        kept[slot[won]] = elem[act[won]]
        live = np.unique(row[act])
        limit[live] = best.reshape(n, registers)[live].max(1)
    return kept.reshape(n, registers)


def probability_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Sum over shared i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    x, y = wa[ia], wb[ib]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio)
    above = np.append(np.cumsum(x[order][::-1])[::-1], 0.0)
    below = np.append(0.0, np.cumsum(y[order]))
    at = np.searchsorted(ratio[order], ratio, "left")
    return float((x / (only_a + above[at] + ratio * (below[at] + only_b))).sum())


def key_of(text):
    """128-bit digest of a text."""
    return F.unhex(F.md5(text))


def _keys(column: pa.Array) -> np.ndarray:
    return buffer_of(column)[0].reshape(-1, 16)


def _key_array(keys: np.ndarray) -> pa.Array:
    off = np.arange(0, 16 * len(keys) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(keys))])


def _bands(words: int, registers: int, bands: int):
    turn = mix(np.arange(bands, dtype=np.uint64) % np.uint64(4) + np.uint64(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part in slices(batches, limit=1_000_000):
            names = part.column(0).to_pylist()
            fresh = [i for i, k in enumerate(names) if k not in seen and not seen.add(k)]
            if len(seen) > SEEN_KEYS:
                seen.clear()
            part = part.take(pa.array(fresh, pa.int64()))
            key = _keys(part.column(0))
            data, off = buffer_of(part.column(1))
            elem, row, weight = weighted(*shingles(data, off, words))
            some = np.unique(row)
            if not len(some):
                continue
            sig = signatures(elem, np.searchsorted(some, row), weight, len(some), registers).reshape(len(some), bands, -1)
            h = np.zeros(sig.shape[:2], np.uint64) + mix(np.arange(bands, dtype=np.uint64))
            for i in range(sig.shape[2]):
                h = (h * np.uint64(BASE)) + mix(sig[:, :, i])
            keys = key[some]
            order = mix(keys.view("<u8")[:, :1] ^ turn)
            yield pa.RecordBatch.from_arrays([pa.array(mix(h.reshape(-1)).view(np.int64)), pa.array(order.reshape(-1).view(np.int64)), _key_array(np.repeat(keys, bands, axis=0))], names=["band", "ord", "key"])

    return run


def _pairs(salt_every: int):
    """Of rows sorted by band and order: a row for each text of a band but the first, with the first as its leader. salt
    numbers the runs of salt_every rows of a band, which go to the leader by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lead, held, seen = None, None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            band, key = batch.column(0).to_numpy(), _keys(batch.column(2))
            again = np.append(False, (band[1:] == band[:-1]) & (key[1:] == key[:-1]).all(1))
            again[0] = last == band[0] and bool((held == key[0]).all())
            new = ~again
            band, key = band[new], key[new]
            if not len(band):
                continue
            first = np.append(band[0] != last, band[1:] != band[:-1])
            at = np.maximum.accumulate(np.where(first, np.arange(len(band)), -1))
            leads = np.where((at < 0)[:, None], key[:1] if lead is None else lead, key[at])
            place = np.where(at < 0, seen + np.arange(len(band)), np.arange(len(band)) - at)
            ask = np.flatnonzero(place)
            if len(ask):
                yield pa.RecordBatch.from_arrays([pa.array(band[ask]), _key_array(key[ask]), _key_array(leads[ask]), pa.array(place[ask] // salt_every)], names=["band", "key", "leader", "salt"])
            last, lead, held, seen = band[-1], leads[-1:].copy(), key[-1].copy(), int(place[-1]) + 1

    return run


def _verify(words: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, held = None, None
        for part in slices(batches, limit=1_000_000):
            leader, role, key = part.column("leader").to_pylist(), part.column("role").to_pylist(), part.column("key").to_pylist()
            data, off = buffer_of(part.column(part.schema.get_field_index("text")))
            elem, row, weight = weighted(*shingles(data, off, words))
            edge = np.searchsorted(row, np.arange(part.num_rows + 1))
            found = []
            for i in range(part.num_rows):
                own = elem[edge[i] : edge[i + 1]], weight[edge[i] : edge[i + 1]]
                if role[i] == 0:
                    lead, held = leader[i], own
                elif lead != leader[i]:
                    raise RuntimeError("a leader's text is missing; the job must run again")
                else:
                    s = probability_jaccard(*held, *own)
                    if s >= threshold - 1e-12:
                        found.append((key[i], leader[i], s))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.binary(), pa.binary(), pa.float64()), strict=True)], names=["key", "leader", "similarity"])

    return run


def verify(texts: DataFrame, pairs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """key, leader, similarity of the pairs (key, leader, salt) of texts (key, text) that reach the threshold; a written
    table. A leader's text goes to each salt of its members once and is held while they stream by."""
    n = partitions(texts.sparkSession)
    members = pairs.select("key", "leader", "salt", F.lit(1).alias("role"))
    leaders = pairs.select("leader", "salt").distinct().select(F.col("leader").alias("key"), "leader", "salt", F.lit(0).alias("role"))
    asked = members.unionByName(leaders)
    sent = texts.dropDuplicates(["key"]).join(asked.hint("shuffle_hash"), "key")
    sent = sent.select("leader", "salt", "role", "key", "text").repartition(n, "leader", "salt").sortWithinPartitions("leader", "salt", "role")
    at = shared_dir(texts.sparkSession, "near-links")
    sent.mapInArrow(lean(_verify(words, threshold)), "key binary, leader binary, similarity double").write.parquet(at)
    return texts.sparkSession.read.parquet(at)


def _shared(x: tuple, y: tuple) -> np.ndarray:
    """Sum of the weights in x (elements, rows, weights, number of rows) of the elements that rows of x and y share, for each two rows; y's weights do not count."""
    both = np.intersect1d(x[0], y[0])
    total = np.zeros((x[3], y[3]), np.float32)
    for i in range(0, len(both), 2048):
        some, dense = both[i : i + 2048], []
        for elem, row, weight, n in (x, (*y[:2], np.ones(len(y[0])), y[3])):
            at = np.minimum(np.searchsorted(some, elem), len(some) - 1)
            on = some[at] == elem
            d = np.zeros((n, len(some)), np.float32)
            d[row[on], at[on]] = weight[on]
            dense.append(d)
        total += dense[0] @ dense[1].T
    return total


def _bound(x: list, y: list) -> np.ndarray:
    """An upper bound of the similarity of each text (key, root, shingles, weights) of x with each of y; the similarity itself where no shingle repeats in a text.

    With a and b the weights, the term of a shared shingle is at most its share of either text, and at most max(a_i, b_i) over
    the weight of one text and of what the other has alone. The sum of min(a_i, b_i) counts equal (shingle, n-th occurrence)."""
    sides, ranked, total = [], [], []
    for z in (x, y):
        elem, weight = np.concatenate([t[2] for t in z]), np.concatenate([t[3] for t in z])
        row = np.repeat(np.arange(len(z)), [len(t[2]) for t in z])
        sides.append((elem, row, weight, len(z)))
        times = weight.astype(np.int64)
        nth = ragged(np.zeros(len(times), np.int64), times).astype(np.uint64)
        ranked.append((mix(np.repeat(elem, times) + nth * np.uint64(GOLDEN)), np.repeat(row, times), np.ones(len(nth)), len(z)))
        total.append(np.bincount(row, weights=weight, minlength=len(z)))
    a, b, least = _shared(*sides), _shared(*sides[::-1]).T, _shared(*ranked)
    whole_a, whole_b = total[0][:, None], total[1][None, :]
    return np.minimum(np.minimum(a / whole_a, b / whole_b), (a + b - least) / (whole_a + whole_b - np.maximum(a, b)))


def _within(x: list, y: list, same: bool, threshold: float) -> list[tuple[bytes, bytes, float]]:
    """Links between texts (key, root, shingles, weights) of x and of y (or among x) that have different roots, enough to
    join every pair that reaches the threshold: pairs whose bound does are computed exactly."""
    name = {r: i for i, r in enumerate(dict.fromkeys(t[1] for t in (*x, *y)))}
    apart = np.array([name[t[1]] for t in x])[:, None] != np.array([name[t[1]] for t in y])
    bound = _bound(x, y)
    one, two = np.nonzero(apart & (bound >= threshold - 1e-4))  # of sums in single precision
    if same:
        one, two = one[one < two], two[one < two]
    up: dict[bytes, bytes] = {}

    def find(r: bytes) -> bytes:
        while r in up:
            r = up[r]
        return r

    found = []
    for k in np.argsort(-bound[one, two], kind="stable"):
        s, t = x[one[k]], y[two[k]]
        p, q = find(s[1]), find(t[1])
        if p != q:
            similar = probability_jaccard(s[2], s[3], t[2], t[3])
            if similar >= threshold - 1e-12:
                up[p] = q
                found.append((s[0], t[0], similar))
    return found


def _search(words: int, threshold: float):
    def solve(held: list) -> Iterator[pa.RecordBatch]:
        x, y = [t for side, *t in held if side == 0], [t for side, *t in held if side == 1]
        found = _within(x, y or x, not y, threshold)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.binary(), pa.binary(), pa.float64()), strict=True)], names=["key", "leader", "similarity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for part in slices(batches, limit=1_000_000):
            names = list(zip(*(part.column(c).to_pylist() for c in ("band", "a", "b")), strict=True))
            side, key, root = (part.column(c).to_pylist() for c in ("side", "key", "root"))
            elem, row, weight = weighted(*shingles(*buffer_of(part.column("text")), words))
            edge = np.searchsorted(row, np.arange(part.num_rows + 1))
            for i in range(part.num_rows):
                if names[i] != group:
                    if held:
                        yield from solve(held)
                    group, held = names[i], []
                held.append((side[i], key[i], root[i], elem[edge[i] : edge[i + 1]], weight[edge[i] : edge[i + 1]]))
        if held:
            yield from solve(held)

    return run


def search(texts: DataFrame, members: DataFrame, root: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame | None:
    """key, leader, similarity of verified pairs of texts (key, text) of one band in members (band, key), enough to join,
    with the classes of root (id, root), all pairs of a band that reach the threshold; a written table, or None if all
    bands are of one class each. Bands with the same texts are searched once."""
    spark = texts.sparkSession
    named = members.join(root.select(F.col("id").alias("key"), "root"), "key", "left").select("band", "key", F.coalesce("root", "key").alias("root"))
    of = named.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
    mixed = of.where("lo <> hi").groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band")
    mixed_at, texts_at, blocks_at, at = (shared_dir(spark, x) for x in ("near-mixed", "near-left", "near-blocks", "near-links"))
    named.join(mixed, "band").write.parquet(mixed_at)
    left = spark.read.parquet(mixed_at)
    if not left.limit(1).count():
        discard(spark, mixed_at)
        return None
    texts.dropDuplicates(["key"]).join(left.select("key").distinct().hint("shuffle_hash"), "key").write.parquet(texts_at)
    texts = spark.read.parquet(texts_at)
    # A text's share of a block. A class of more than a block has blocks of its own, by key; the others are dealt by class, so that few blocks hold several.
    share = F.greatest(F.octet_length("text") / F.lit(BLOCK_BYTES), F.lit(1 / block)).alias("share")
    sized = left.join(texts.select("key", share), "key")
    own = sized.groupBy("band", "root").agg(F.ceil(F.sum("share")).alias("parts"), F.sum("share").alias("w"))
    small = own.where("parts = 1").groupBy("band").agg(F.ceil(F.sum("w")).alias("deal"))
    own = own.join(small, "band", "left").select("band", "root", "parts", "deal")
    block_of = F.when(F.col("parts") > 1, F.xxhash64("root", F.pmod(F.xxhash64("key"), "parts"))).otherwise(F.pmod(F.xxhash64("root"), "deal"))
    left.join(own, ["band", "root"]).select("band", "key", "root", block_of.alias("block")).write.parquet(blocks_at)
    placed = spark.read.parquet(blocks_at)
    blocks = placed.groupBy("band", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    side = lambda c: blocks.select("band", F.col("block").alias(c), F.col("lo").alias(f"{c}_lo"), F.col("hi").alias(f"{c}_hi"))
    todo = side("a").join(side("b"), "band").where("a <= b and (a_lo <> a_hi or b_lo <> b_hi or a_lo <> b_lo)").select("band", "a", "b")
    asked = placed.join(todo.withColumn("block", F.col("a")), ["band", "block"]).withColumn("side", F.lit(0))
    asked = asked.unionByName(placed.join(todo.where("a < b").withColumn("block", F.col("b")), ["band", "block"]).withColumn("side", F.lit(1)))
    sent = texts.join(asked, "key").select("band", "a", "b", "side", "key", "root", "text")
    sent = sent.repartition(partitions(spark), "band", "a", "b").sortWithinPartitions("band", "a", "b")
    sent.mapInArrow(lean(_search(words, threshold)), "key binary, leader binary, similarity double").write.parquet(at)
    discard(spark, mixed_at, texts_at, blocks_at)
    return spark.read.parquet(at)


def links(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, registers: int = REGISTERS, bands: int = BANDS, salt_every: int = SALT_EVERY, block: int = BLOCK) -> DataFrame:
    """key, leader, similarity of verified pairs of different texts, enough to join every class."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    texts = docs_of(docs).select(key_of(F.col("text")).alias("key"), "text").where("text <> ''")
    dealt = texts.mapInArrow(lean(_bands(words, registers, bands)), "band long, ord long, key binary").repartition(n, "band").sortWithinPartitions("band", "ord")
    at = shared_dir(spark, "near-members")
    dealt.mapInArrow(lean(_pairs(salt_every)), "band long, key binary, leader binary, salt long").write.parquet(at)
    members = spark.read.parquet(at)
    found = verify(texts, members.groupBy("key", "leader").agg(F.min("salt").alias("salt")), words, threshold)
    more = search(texts, members.select("band", "key"), components(found, "key", "leader"), words, threshold, block)
    discard(spark, at)
    return found if more is None else found.unionByName(more)


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """id and root (the least id of its component) of each id in pairs. Least labels spread along pairs, to all
    ids of the same label at once, and jump to their own labels' labels, over tables written each round, until no label falls."""
    spark = pairs.sparkSession
    both = pairs.select(F.col(a).alias("id"), F.col(b).alias("to")).union(pairs.select(F.col(b).alias("id"), F.col(a).alias("to"))).distinct()
    edges = shared_dir(spark, "edges")
    both.write.parquet(edges)
    both = spark.read.parquet(edges)
    labels, last = both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("root")), None
    while True:
        now = shared_dir(spark, "labels")
        labels.write.parquet(now)
        labels = spark.read.parquet(now)
        near = both.join(labels.select(F.col("id").alias("to"), "root"), "to").groupBy("id").agg(F.min("root").alias("m"))
        met = labels.join(near, "id")
        hook = met.groupBy("root").agg(F.min("m").alias("hook"))  # a chain takes few rounds
        fell = met.join(hook, "root").select("id", F.col("root").alias("was"), F.least("root", "m", "hook").alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("next"))
        fell = fell.join(jump, "root", "left").select("id", "was", F.least("root", "next").alias("root"))
        new = shared_dir(spark, "labels")
        fell.write.parquet(new)
        discard(spark, now, *([last] if last else []))
        last, fell = new, spark.read.parquet(new)
        labels = fell.select("id", "root")
        if not fell.where("root <> was").limit(1).count():
            discard(spark, edges)
            return labels


def classes(docs: DataFrame, **parameters) -> DataFrame:
    """key (digest of a text), class_id, chosen (the least doc_id and key of the class), n_class (rows of the class)."""
    texts = docs_of(docs).select(key_of(F.col("text")).alias("key"), "doc_id").groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    root = components(links(docs, **parameters), "key", "leader")
    texts = texts.join(root.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    of = texts.groupBy("root").agg(F.min("least").alias("class_id"), F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("doc_id"), F.col("key").alias("key"))).alias("chosen"), F.sum("n").alias("n_class"))
    return texts.select("key", "root").join(of, "root").select("key", "class_id", "chosen", "n_class")


def near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, class_id, n_class of each row of docs."""
    rows = docs_of(docs).select("doc_id", key_of(F.col("text")).alias("key"))
    return rows.join(classes(docs, **parameters).drop("chosen"), "key").select("doc_id", "class_id", "n_class")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def keep(docs: DataFrame, **parameters) -> DataFrame:
    """One row of docs, with all its columns, for each class: the one with the least doc_id."""
    k = fresh(docs, "near_key")
    marked = docs.withColumn(k, key_of(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    chosen = classes(docs, **parameters).select(F.col("chosen.key").alias("c_key"), F.col("chosen.doc_id").alias("c_id")).distinct()
    got = marked.join(chosen.hint("shuffle_hash"), (marked[k] == F.col("c_key")) & marked["doc_id"].cast("long").eqNullSafe(F.col("c_id")), "left_semi")
    return got.dropDuplicates([k, "doc_id"]).drop(k)


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
