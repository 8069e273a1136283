"""Near duplicates, repeated strings, archives, chats, media and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cytolake.llm import chat, media, minhash, suffix, warc
from cytolake.llm.catalog import ORACLES, QUERIES
from tests.llm.helpers import awkward, by_key, frame, ordered, prose, shingle_counts


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, awkward())


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def jaccard_p(a: Counter, b: Counter) -> float:
    keys = a.keys() | b.keys()
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in a.keys() & b.keys())


def brute_classes(rows):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingle_counts(t or "") for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            a, b = sets[i], sets[j]
            if same or (a and b and len(a.keys() & b.keys()) * 2 >= min(len(a), len(b)) and jaccard_p(a, b) >= 0.8):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        known = [x for x in (least.get(r), d) if x is not None]
        least[r] = min(known) if known else None
    return [(d, least[find(i)]) for i, (d, _) in enumerate(rows)]


def test_near_duplicates(docs, empty):
    assert ordered(minhash.near_duplicates(docs), "doc_id", "class_id") == by_key(brute_classes(awkward()))
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(x for (x,) in ordered(kept, "doc_id") if x is not None) == [1, 4, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16]
    assert minhash.keep(empty).count() == 0


def test_near_duplicates_large_group(spark):
    """Near copies of one text, more than a leader's salt, and far variants that are linked only by a chain."""
    base = prose(11, 200).split()
    rows = []
    for i in range(90):
        w = list(base)
        w[(7 * i) % 200] = f"edit{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(100 + i, 80)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(df, salt_every=16).collect()}
    assert {got[i].class_id for i in range(90)} == {0} and got[0].n_class == 90
    assert all(got[1000 + i].class_id == 1000 + i for i in range(20))


def test_near_duplicates_star_and_chain(spark):
    """Over 300 texts that are each close to one or two others only, in buckets that hold very many of them."""
    base = prose(21, 240, 100_000).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 321):  # spokes: 4 words, at places of their own, differ from the base
        w = list(base)
        for j in range(4):
            w[(i * 7 + j * 60 + (i // 60) * 13) % 240] = f"spoke{i}x{j}"
        rows.append((i, " ".join(w)))
    w = prose(22, 240, 100_000).split()
    for i in range(320):  # links: each differs from the last by 3 words
        w = list(w)
        for j in range(3):
            w[(i * 11 + j * 80) % 240] = f"link{i}x{j}"
        rows.append((1000 + i, " ".join(w)))
    sets = [set(shingle_counts(t)) for _, t in rows]  # no shingle repeats in a text: plain Jaccard
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert all(alike(0, i) for i in range(1, 321)) and sum(alike(1, i) for i in range(2, 321)) < 20
    assert all(alike(i, i + 1) for i in range(321, 640)) and not any(alike(321, i) for i in range(330, 641))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parameters in ({}, {"block": 16}):
        got = minhash.near_duplicates(df, **parameters).groupBy("class_id").count().collect()
        assert sorted(tuple(r) for r in got) == [(0, 321), (1000, 320)], parameters


def test_unjoined_bucket_is_searched_whole(spark):
    """A bucket of many texts that no leader joins, with two links in it and a class of more than a block, in several blocks."""
    rows = [(i, prose(500 + i, 60, 100_000)) for i in range(60)]
    for i in (7, 41):
        w = rows[i][1].split()
        w[30] = "other"
        rows.append((100 + i, " ".join(w)))
    big = prose(900, 80, 100_000).split()
    rows += [(200 + i, " ".join([*big[:40], f"edit{i}", *big[41:]])) for i in range(12)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").select(minhash.key_of(minhash.F.col("text")).alias("key"), "text", "doc_id")
    key = {r.doc_id: bytes(r.key) for r in texts.collect()}
    members = texts.selectExpr("explode(array(1L, 2L)) AS band", "key")
    root = spark.createDataFrame([(bytearray(key[200 + i]), bytearray(key[200])) for i in range(12)], "id binary, root binary")
    for block in (4, 16, 512):
        got = minhash.search(texts.drop("doc_id"), members, root, block=block).collect()
        assert sorted({tuple(sorted((bytes(r.key), bytes(r.leader)))) for r in got}) == sorted(tuple(sorted((key[i], key[100 + i]))) for i in (7, 41))
    assert minhash.search(texts.drop("doc_id"), members.join(root.selectExpr("id AS key"), "key"), root) is None


def test_bound_of_similarity():
    """Never below the similarity; equal to it where no shingle repeats."""
    rng = np.random.default_rng(8)
    pool = np.sort(rng.integers(1, 2**63, 60).astype(np.uint64))
    for flat in (True, False):
        texts = []
        for i in range(24):
            on = np.sort(rng.choice(60, int(rng.integers(20, 60)), replace=False))
            texts.append((b"%d" % i, b"", pool[on], np.ones(len(on)) if flat else rng.integers(1, 5, len(on)).astype(float)))
        bound = minhash._bound(texts[:10], texts[10:])
        exact = np.array([[minhash.probability_jaccard(*x[2:], *y[2:]) for y in texts[10:]] for x in texts[:10]])
        assert (bound >= exact - 1e-5).all() and (not flat or np.abs(bound - exact).max() < 1e-5)


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(5)
    pool = rng.integers(1, 2**63, 400).astype(np.uint64)
    a, b = np.sort(pool[:300]), np.sort(pool[60:400])
    wa, wb = rng.integers(1, 4, len(a)).astype(float), rng.integers(1, 4, len(b)).astype(float)
    elem, row, weight = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), np.concatenate([wa, wb])
    sig = minhash.signatures(elem, row, weight, 2, 4096)
    ca, cb = Counter(dict(zip(a.tolist(), wa, strict=True))), Counter(dict(zip(b.tolist(), wb, strict=True)))
    exact = jaccard_p(ca, cb)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04
    assert abs(minhash.probability_jaccard(a, wa, b, wb) - exact) < 1e-9
    one = minhash.signatures(elem, row, weight * np.where(row == 0, 7.0, 1.0), 2, 4096)
    assert ((one[0] == sig[0]).mean()) > 0.999  # scale of a text's weights is of no account


def test_near_duplicates_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = ordered(QUERIES["op10_near_duplicates"](spark, sf_dir), "doc_id", "class_id")
    assert got == by_key(brute_classes(rows))


def brute_repeats(rows, n=400):
    count = Counter(t[i : i + n] for _, t in rows for i in range(len(t) - n + 1))
    out = []
    for d, t in rows:
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                cover[i] += 1
                cover[i + n] -= 1
        cover = np.cumsum(cover)[: len(t)] > 0
        spans = int((np.diff(np.append(0, cover.astype(int))) == 1).sum())
        out.append((d, len(t), int(cover.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~cover].tobytes()).hexdigest()))
    return out


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_dedup(docs, empty):
    rows = [(d, (t or "").encode()) for d, t in awkward() if d != 11]
    assert ordered(suffix.dedup(docs.where("doc_id is null or doc_id <> 11")), *COLUMNS) == by_key(brute_repeats(rows))
    assert suffix.dedup(empty).count() == 0
    clean = suffix.strip(docs)
    assert clean.columns == docs.columns
    got = {r.doc_id: r for r in clean.where("doc_id in (2, 9, 11)").collect()}
    assert got[2].text == "" and got[2].n_chars == 0
    assert len(got[11].text) == len(dict(awkward())[11])


def test_suffix_contract_length(spark):
    """Strings of 400 bytes go, of 399 (here over 50 words) stay; n_bytes is the whole text's length, whatever goes."""
    shared = ("é" + " word of it" * 60)[:398]  # 399 bytes
    assert len(shared.encode()) == 399 and len(shared.split()) > 50
    rows = [(1, "A" + shared + "B"), (2, "C" + shared + "D"), (3, "E" + shared[::-1] + "FG"), (4, "H" + shared[::-1] + "FI")]
    got = ordered(suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string")), *COLUMNS)
    assert got == by_key(brute_repeats([(d, t.encode()) for d, t in rows]))
    assert [r[:4] for r in got] == [(1, 401, 0, 0), (2, 401, 0, 0), (3, 402, 400, 1), (4, 402, 400, 1)]


def python_nodes_in_a_stage(plan: str) -> int:
    """The most Python nodes that one path of a plan's tree has between exchanges."""
    most, above = 0, []  # depth, Python nodes from the last exchange on
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x[0] < depth]
        n = above[-1][1] if above else 0
        name = line.lstrip(" :+-")
        n = 0 if name.startswith("Exchange") else n + ("InArrow" in name.split("(")[0].split(" ")[0])
        above.append((depth, n))
        most = max(most, n)
    return most


def test_strip_keeps_one_worker_a_core(docs):
    """Each further Python node of a stage keeps a Python worker of its own for each core; the text is as before."""
    clean = suffix.strip(docs, 24, 8)
    assert python_nodes_in_a_stage(clean._jdf.queryExecution().executedPlan().toString()) == 1
    kept = {bytes(r.key): bytes(r.kept).decode("utf-8", "ignore") for r in suffix.dedup_texts(docs, 24, 8).collect()}
    keys = docs.selectExpr("doc_id", "n_chars", "text").withColumn("key", suffix.key_of(F.coalesce("text", F.lit("")))).collect()
    got = Counter((r.doc_id, r.text, r.n_chars) for r in clean.collect())
    assert got == Counter((r.doc_id, kept[bytes(r.key)], len(kept[bytes(r.key)])) for r in keys)


@pytest.mark.parametrize("min_len,anchor", [(24, 8), (40, 16)])
def test_suffix_dedup_random(spark, min_len, anchor):
    """Low-entropy texts, shared passages and a hash that goes on over many batches."""
    rng = np.random.default_rng(min_len)
    shared = "".join(rng.choice(list("abcd"), 90))
    rows = []
    for i in range(160):
        own = lambda n: "".join(rng.choice(list("abcdefgh"), n))  # noqa: E731, B023
        rows.append((i, own(rng.integers(0, 90)) + shared[rng.integers(0, 30) : 90 - rng.integers(0, 30)] + own(rng.integers(0, 60))))
    rows += [(900, "ab" * 80), (901, "é" * 60), (902, ""), (903, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = by_key(brute_repeats([(d, t.encode()) for d, t in rows], min_len))
    assert ordered(suffix.dedup(df, min_len, anchor), *COLUMNS) == want
    for hot in (0, 5):  # all hashes by windows, or those of more than five runs
        assert ordered(suffix.dedup(df, min_len, anchor, hot), *COLUMNS) == want


@pytest.mark.parametrize("seed", range(3))
def test_suffix_hot_streams(seed):
    """Marks and equal windows are the same however the sorted rows are cut into batches."""
    rng = np.random.default_rng(seed)
    h = np.sort(rng.integers(0, 12, 70))
    lengths = rng.integers(1, 4, 70)
    runs = [[{"a": i, "p": 0, "q": 1}] * int(n) for i, n in enumerate(lengths)]
    rows = pa.RecordBatch.from_arrays([pa.array(h), pa.array([b"k" * 16] * 70, pa.binary()), pa.array(runs, pa.list_(suffix._RUN))], names=["h", "key", "runs"])
    cut = lambda n: sorted({0, n, *rng.integers(0, n, 9).tolist()})
    c = cut(70)
    got = {r["runs"][0]["a"]: r["hot"] for b in suffix._marked(10)(rows.slice(x, y - x) for x, y in zip(c, c[1:])) for r in b.to_pylist()}
    assert got == {i: bool(lengths[h == h[i]].sum() > 10) for i in range(70) if lengths[h == h[i]].sum() > 1}
    one, two = np.sort(rng.integers(0, 25, 60)), rng.integers(0, 2, 60)
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    rows = pa.RecordBatch.from_pydict({"h": pa.array(one), "key": pa.array([bytes([i]) * 16 for i in range(60)], pa.binary()), "a": pa.array(two), "p": pa.array(range(60), pa.int64()), "ctx": pa.array([b""] * 60, pa.binary())})
    c = cut(60)
    got = {(r["s"], r["e"]) for b in suffix._match(5, 2)(rows.slice(x, y - x) for x, y in zip(c, c[1:])) for r in b.to_pylist()}
    assert got == {(i, i + 5) for i in range(60) if ((one == one[i]) & (two == two[i])).sum() > 1}


def test_suffix_family_over_batches():
    """Batches of the same hash give the same flags as one batch."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    n, anchor, size = 64, 8, 24
    ctx = []
    for _ in range(n):  # one byte of each side differs from what most share
        text = ["a"] * (size - anchor) + list("ANCHORED") + ["b"] * (size - anchor)
        text[rng.integers(0, size - anchor)] = rng.choice(list("xyz"))
        text[size + rng.integers(0, size - anchor)] = rng.choice(list("xyz"))
        ctx.append("".join(text).encode())
    make = lambda ids: pa.RecordBatch.from_pydict({"h": pa.array([7] * len(ids), pa.int64()), "key": pa.array([i.to_bytes(16, "little") for i in ids], pa.binary()), "a": pa.array([size - anchor] * len(ids), pa.int64()), "p": pa.array([0] * len(ids), pa.int64()), "ctx": pa.array([ctx[i] for i in ids], pa.binary())})

    def run(batches):
        family, cover = suffix.Family(), {}
        for b in batches:
            for got in family.add(suffix.Level.of(b, size, anchor)):
                for r in got.to_pylist():
                    cover.setdefault(int.from_bytes(r["key"], "little"), set()).update(range(r["s"], r["e"]))
        return cover, len(family.levels)

    whole, _ = run([make(list(range(n)))])
    parts, levels = run([make(list(range(i, i + 4))) for i in range(0, n, 4)])
    assert whole == parts and whole
    assert levels <= 6


def test_suffix_whole_table(spark, sf_dir):
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert ordered(QUERIES["op4_suffix_dedup"](spark, sf_dir), *COLUMNS) == by_key(brute_repeats(rows))


def test_warc(spark, tmp_path):
    html = "<p>" + prose(20, 60) + "</p>"
    rows = [(5, "http://a/x y\r\n", html), (3, "http://a/é", html), (9, None, html), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (None, "u", html), (3, "u", html), (7, "u", "<p>" + prose(21, 90))]
    pages = spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id long, url string, html string, size int, digest string")
    listed = warc.write_archives(pages, f"file://{tmp_path}/w", archive_bytes=600)
    assert listed.count() > 1
    got = ordered(warc.read_archives(listed, f"file://{tmp_path}/w"), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for page, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and h == html and page != 3
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == by_key(want)
    full = warc.read_archives(listed, f"file://{tmp_path}/w", with_payload=True).where("page_id = 7").first()
    assert bytes(full.payload).decode() == rows[-1][2]
    none = warc.write_archives(pages.where("false"))
    assert warc.read_archives(none, "file:///tmp").count() == 0


def test_warc_repeated_attempt(tmp_path):
    """An attempt that reads the same rows in another order leaves the files of the listed one alone."""
    rows = [{"page_id": i, "url": f"u{i}", "html": prose(i, 30), "digest": hashlib.sha256(prose(i, 30).encode()).hexdigest(), "size": len(prose(i, 30)), "first_id": None, "revisit": False} for i in range(12)]
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("digest", pa.string()), ("size", pa.int64()), ("first_id", pa.int64()), ("revisit", pa.bool_())])
    write = lambda r: [x for b in warc._write(f"file://{tmp_path}/w", 900)(iter([pa.RecordBatch.from_pylist(r, kind)])) for x in b.to_pylist()]
    listed = write(rows)
    assert len(listed) > 2
    other = write(rows[::-1]) + write(rows)
    assert {x["path"] for x in listed} < {x["path"] for x in other}
    got = [r["Page-ID"] for x in listed for r in warc.read_archive(open(x["path"], "rb").read())]
    assert sorted(map(int, got)) == list(range(12))


def test_warc_orphans_and_clashing_columns(spark, tmp_path):
    html = "<p>" + prose(31, 60)
    pages = spark.createDataFrame([(i, "u", html, "x", 1, 2, True, "t") for i in range(5)], "page_id long, url string, html string, digest string, size int, first_id int, revisit boolean, t_page string")
    uri = f"file://{tmp_path}/w"
    listed = warc.write_archives(pages, uri)
    assert warc.orphans(listed, uri) == []
    (tmp_path / "w" / "lost.warc.zst.7-0").write_bytes(b"half")
    assert warc.orphans(listed, uri) == [f"{tmp_path}/w/lost.warc.zst.7-0"]
    got = warc.read_archives(listed, uri).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [(0, "response", None), *((i, "revisit", 0) for i in range(1, 5))]


def test_warc_file_is_framed():
    data = warc.archive([warc.record(1, "http://a", b"x" * 500, "d", 500, None, False), warc.record(2, "http://b", b"", "d", 500, 1, True)])
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    got = list(warc.read_archive(data))
    assert [r["WARC-Type"] for r in got] == ["response", "revisit"]
    assert got[0]["block"].endswith(b"x" * 500)
    with pytest.raises(ValueError):
        list(warc.read_archive(b"\0" * 16))


def test_chat(spark):
    rows = [
        (1, 0, "user", "hi # <b> : \\ \\h \\\\h ###"), (1, 1, "assistant", "</turn>\n### user: x\\"), (2, 1, "assistant", "late"), (2, 0, "user", None), (3, 0, "assistant", "first"), (3, 1, "assistant", "again"),
        (4, 0, "tool:#x", "t"), (5, None, None, None), (None, 0, "user", "u"), (6, 0, "system", "s"), (6, 1, "user", "u"), (6, 2, "assistant", ""), (7, 0, "user", "same"), (7, 0, "user", "same"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat.read_chat(chat.format_chat(df)).collect()}
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r)):
        want.setdefault(c, []).append((r or "", x or ""))
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss_text == "".join(x for r, x in turns if r == "assistant")
        assert got[c].formatted.count("</turn>\n") == len(turns)
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: True, 3: False, 4: False, 5: False, None: False, 6: True, 7: False}
    assert chat.format_chat(df.where("false")).count() == 0


def test_chat_is_native(spark, sf_dir):
    plan = QUERIES["op7_chat"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(want.columns)
    assert ordered(df, *sorted(df.columns)) == by_key(con.sql(f"SELECT {', '.join(sorted(df.columns))} FROM ({ORACLES[name]})").fetchall())


def test_media_items():
    html = '<h1>T</h1>a <b>b</b><script>x</script><figure><img src="media:sha256:AB" alt="alt" data-bytes="7"><figcaption>cap &amp; tion</figcaption></figure><img src="http://x/y.png" alt="second">tail<p>end'
    items = media.parse_items(html)
    assert [(i["kind"], i.get("text"), i.get("digest"), i.get("caption")) for i in items] == [("text", "T", None, None), ("text", "a b", None, None), ("media", None, "ab", "cap & tion"), ("media", None, None, "second"), ("text", "tail", None, None), ("text", "end", None, None)]
    assert media.parse_items(None) == []


def test_media(spark, sf_dir, docs, empty):
    payload = docs.select(media.payload_of(media.F.coalesce("text", media.F.lit(""))).alias("p")).collect()
    assert all(len(r.p) % 576 == 0 and r.p for r in payload)
    for n in (576, 576 * 7):
        raw = bytes(range(256)) * (n // 256) + b"\xff" * (n % 256)
        assert media.from_png(media.to_png(raw)) == (576, n // 576, raw)
    got = {r.doc_id: r for r in QUERIES["op8_media"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        b = (r.text or "").encode()
        p = b + b"\xff" * (-len(b) % 576 if b else 576)
        stored, x = media.to_png(p), got[r.doc_id]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32, x.media_bytes, x.media_sha256, x.feature) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), media.feature(*media.from_png(stored)))
        assert x.caption == f"Text of document {r.doc_id}" and x.pos == 2


def test_media_sequences_of_real_pages(spark, sf_dir):
    """Every page parses; media, given a digest and two of them a payload, keep their places and captions among the texts."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    seq = {r.doc_id: r["items"] for r in media.sequences(pages, "page_id").collect()}
    assert len(seq) == pages.count() and sum(map(len, seq.values())) > len(seq)
    for r in pages.collect():
        items = seq[r.page_id]
        assert [i.pos for i in items] == list(range(len(items)))
        whole = " ".join(i.text for i in items if i.kind == "text")
        assert all(w in (r.html or "").replace("&amp;", "&") or "&" in (r.html or "") for w in whole.split()[:50])
    figure = lambda d, c: f'<figure><img src="media:sha256:{d}" alt="alt {c}" data-bytes="9"><figcaption>{c}</figcaption></figure>'
    html = pages.where("html is not null").orderBy("page_id").first().html
    mixed = f"<p>before</p>{figure('AA', 'one')}{html}{figure('bb', 'two')}<p>between{figure('cc', 'three')}<video src='clip.mp4'></video><p>after"
    features = spark.createDataFrame([(d, 576, d * 32, 1, 9, d * 32, "f" + d) for d in ("aa", "bb")], media._FEATURES)
    got = media.resolve(media.sequences(spark.createDataFrame([(1, mixed)], "doc_id long, html string")), features).orderBy("pos").collect()
    ours = [(r.digest, r.caption, r.feature) for r in got if r.kind == "media" and r.digest]
    assert ours == [("aa", "one", "faa"), ("bb", "two", "fbb"), ("cc", "three", None)]
    assert got[0].text == "before" and got[-1].text == "after" and any(r.src == "clip.mp4" for r in got)


def test_media_malformed_html():
    deep = "<div>" * 20_000 + "in <b>deep" + "<img src=x.png>" + "</p>" * 5 + "<figcaption>stray</figcaption><script>never closed <img src=y.png>"
    assert [(i["kind"], i.get("text") or i.get("src")) for i in media.parse_items(deep)] == [("text", "in deep"), ("media", "x.png")]
    assert media.parse_items("<<<>>&#xZZ; </ <!-- <![CDATA[ x")  # no exception, some text


def test_media_missing_payload(spark):
    pages = spark.createDataFrame([(1, '<img src="media:sha256:00" alt="x">'), (2, None)], "doc_id long, html string")
    features = spark.createDataFrame([], media._FEATURES)
    got = media.resolve(media.sequences(pages), features).collect()
    assert [(r.doc_id, r.digest, r.caption, r.feature) for r in got] == [(1, "00", "x", None)]


def test_pipeline_stages(spark, sf_dir):
    """Each stage does to its own input what the operator's brute force says."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "near_duplicates", "repeated_strings", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name == "packing":
            want = {r.doc_id for r in docs.select("doc_id").collect()}
            assert {r.doc_id for r in out.select("doc_id").collect()} == want
            continue
        assert out.columns == docs.columns
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        at = corpus_pipeline.shared_dir(spark, "test-stage")
        out.write.parquet(at)
        docs = spark.read.parquet(at)
        after = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name == "near_duplicates":
            assert set(after) == {c for _, c in brute_classes(list(before.items()))}
        elif name == "repeated_strings":
            want = {r[0]: r[1] - r[2] for r in brute_repeats([(d, t.encode()) for d, t in before.items()], suffix.PASSAGE_LEN)}
            assert set(after) == set(before)
            assert all(0 <= want[d] - len(t.encode()) <= 6 * 4 for d, t in after.items())
        else:
            assert set(after) <= set(before) and len(after) > 0.7 * len(before)


def test_pipeline_empty(spark, tmp_path):
    empty = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != "packing":
            assert out.columns == empty.columns


def test_anchors_of_long_texts(monkeypatch):
    """A text cut into stretches gives each window the anchor that it has in the whole text."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcd"), 5000))
    data = np.frombuffer(text.encode(), np.uint8)
    spread = lambda rows: sorted((s, h, a) for h, a, p, q in rows for s in range(p, q + 1))
    h, _, a, p, q = suffix.anchors(data, np.array([0, len(data)]), 24, 8)
    want = spread(zip(h.tolist(), a.tolist(), p.tolist(), q.tolist(), strict=True))
    assert [s for s, _, _ in want] == list(range(5000 - 23))
    monkeypatch.setattr(suffix, "BUFFER_BYTES", 700)
    batch = pa.RecordBatch.from_pydict({"key": pa.array([b"k" * 16], pa.binary()), "text": [text], "n": [1]})
    got = [(r["h"], x["a"], x["p"], x["q"]) for b in suffix._anchor_rows(24, 8)(iter([batch])) for r in b.to_pylist() for x in r["runs"]]
    assert spread(got) == want


def test_window_minimum():
    rng = np.random.default_rng(4)
    for n, size in ((1, 1), (10, 3), (57, 8), (5, 9)):
        x = rng.integers(0, 50, n).astype(np.uint64)
        assert suffix.window_minimum(x, size).tolist() == [int(x[i : i + size].min()) for i in range(n - size + 1)]


@pytest.mark.parametrize("seed", range(4))
def test_streams_over_batches(seed):
    """Sorted streams give the same rows however they are cut into batches."""
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    cut = lambda n: sorted({0, n, *rng.integers(0, n, 6).tolist()})
    h = np.sort(rng.integers(0, 25, 40))
    runs = [[{"a": int(i), "p": 0, "q": 1}] * int(rng.integers(1, 3)) for i in range(40)]
    kind = pa.list_(suffix._RUN)
    rows = pa.RecordBatch.from_arrays([pa.array(h), pa.array([b"k" * 16] * 40, pa.binary()), pa.array(runs, kind)], names=["h", "key", "runs"])
    c = cut(40)
    got = [(r["h"], r["runs"][0]["a"]) for b in suffix._repeated(iter([rows.slice(x, y - x) for x, y in zip(c, c[1:])])) for r in b.to_pylist()]
    assert got == [(int(h[i]), i) for i in range(40) if (h == h[i]).sum() > 1 or len(runs[i]) > 1]

    n = 60
    band = np.sort(rng.integers(0, 9, n))
    names = rng.integers(0, 12, n)
    order = np.lexsort((names, band))
    band, names = band[order], names[order]
    key = [int(k).to_bytes(1, "big") * 16 for k in names]
    rows = pa.RecordBatch.from_pydict({"band": pa.array(band), "ord": pa.array(names), "key": pa.array(key, pa.binary())})
    c = cut(n)
    got = [(r["band"], r["key"][0], r["leader"][0], r["salt"]) for b in minhash._pairs(4)(iter([rows.slice(x, y - x) for x, y in zip(c, c[1:])])) for r in b.to_pylist()]
    want = []
    for k in np.unique(band):
        mine = list(dict.fromkeys(names[band == k].tolist()))
        want += [(int(k), m, mine[0], i // 4) for i, m in enumerate(mine) if i]
    assert got == want
