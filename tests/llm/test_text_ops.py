"""Packing, quality, BPE, language and licence operators against brute force."""

from __future__ import annotations

import hashlib
import json
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cytolake.llm import bpe, langid, license, packing, quality
from tests.llm.helpers import awkward, by_key, frame, ordered, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, awkward())


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")}


def test_room_tree_and_best_fit():
    tree = packing.RoomTree(16)
    for room in (3, 7, 7, 16):
        tree.add(room, 1)
    assert [tree.tightest(x) for x in (0, 3, 4, 8, 16)] == [3, 3, 7, 16, 16]
    tree.add(16, -1)
    assert tree.tightest(8) == -1
    rng = np.random.default_rng(1)
    lengths = sorted(rng.integers(1, 101, 400).tolist(), reverse=True)
    sequence, offset = packing.best_fit(lengths, 100)
    room, plain = [], []
    for n in lengths:  # the tightest open window by search
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            i = min(fits)[1]
            room[i] -= n
        else:
            room.append(100 - n)
        plain.append(n)
    assert max(sequence) + 1 == len(room)
    used = defaultdict(list)
    for s, o, n in zip(sequence, offset, lengths, strict=True):
        used[s].append((o, n))
    for pieces in used.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 100


def check_packing(got, rows, window=2048):
    t = Tokenizer.from_file(packing.default_vocabulary())
    want = Counter()
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), window):
            piece = ids[a : a + window]
            want[d, a, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= window
    return len(held)


def test_packing(docs, empty):
    assert check_packing(packing.pack(docs).collect(), awkward()) > 0
    assert check_packing(packing.pack(docs, window=64, group_docs=5).collect(), awkward(), 64) > 0
    assert packing.pack(empty).count() == 0
    piece = packing.pack(docs, with_ids=True).where("doc_id = 7").first()
    assert zlib.crc32(bytes(piece.ids)) == piece.ids_crc32


def test_packing_whole_table(tables):
    rows = [(r.doc_id, r.text) for r in tables["documents"].select("doc_id", "text").collect()]
    n = check_packing(packing.pack(tables["documents"]).collect(), rows)
    total = sum(r.length for r in packing.pack(tables["documents"]).collect())
    assert total / (n * 2048) > 0.98


def test_packing_ids_are_the_tokenizers():
    """Marks of the vocabulary, cases, joined signs and odd white space, against a tokenizer made here."""
    plain, encode = Tokenizer.from_file(packing.default_vocabulary()), packing.ChunkEncoder(packing.default_vocabulary())
    r = random.Random(4)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "a", "It's", "don'T", " ", "  ", "\n", "\u00a0", "\u2028", "é", "ñ", "1234", "3.5", "!?", "x_y", "日本", "ß", "İ", "A\u0301", "...", "\t", "word"]
    texts = ["a <|endoftext|> b", "hello<|endoftext|>you", "<|startoftext|>", *("".join(r.choice(bits) for _ in range(r.randrange(1, 14))) for _ in range(4000))]
    for x in range(0, len(texts), 500):
        part = texts[x : x + 500]
        for text, ids in zip(part, packing.encode_rows(encode, pa.array(part)), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_packing_loads_a_vocabulary_once():
    """A worker keeps its tokenizer between tasks: one of them, with marks and without."""
    path = packing.default_vocabulary()
    (ids,) = packing.encode_rows(packing.ChunkEncoder(path), pa.array(["a <|endoftext|> b"]))
    with_marks, without = (packing.tokenizer(path, x).encode("<|endoftext|>", add_special_tokens=False).ids for x in (True, False))
    assert len(with_marks) == 1 < len(without) and with_marks[0] in ids.tolist()
    assert packing.tokenizer(path, True) is packing.tokenizer(path, False)


def test_packing_other_vocabulary(spark, tmp_path):
    """A file that normalises otherwise goes to the tokenizer itself."""
    said = json.load(open(packing.default_vocabulary(), encoding="utf-8"))
    said["normalizer"] = None
    path = str(tmp_path / "cased.json")
    json.dump(said, open(path, "w", encoding="utf-8"))
    assert packing.by_chunks(packing.default_vocabulary()) and not packing.by_chunks(path)
    plain, text = Tokenizer.from_file(path), "Some CASED Words, and Signs!"
    (ids,) = packing.encode_rows(packing.ChunkEncoder(path), pa.array([text]))
    assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def base_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeats, len(cover), failed


def test_quality_counts(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (None, 0), (5, None)], "doc_id long, quality int")
    got = ordered(quality.score(docs, labels), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == by_key([(d, *base_counts(t or "")) for d, t in awkward()])
    assert all(r.kept == (not r.base_failed) for r in quality.score(docs, labels).collect())  # nothing to learn from
    assert quality.score(empty, labels).count() == 0
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns
    assert ordered(kept, "doc_id") == by_key([(d,) for d, t in awkward() if t is not None and not base_counts(t)[-1]])


def test_quality_verdict(tables):
    docs, labels = tables["documents"], tables["labels"]
    got = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for d, t in rows:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(t or "")
        assert r.kept == (not r.base_failed and r.p_good >= quality.KEEP_AT)
    known = [(r.quality, got[r.doc_id].p_good >= quality.KEEP_AT) for r in labels.collect() if r.doc_id in got]
    assert np.mean([q == p for q, p in known]) > 0.9


def test_quality_scores_are_linear_in_shares():
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=quality.FEATURES).astype(np.float32))
    texts = ["alpha beta beta", "é ß alpha", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    spans = quality.word_spans(data, off)
    words = quality.range_hash(quality.prefix_hash(data), *spans[:2])
    got = quality.raw_scores(model, data, off, words, spans[2])
    want = np.full(3, float(model.weights[0]))
    for index, row in quality.features(data, off, words, spans[2]):
        for i in range(3):
            if (row == i).any():
                want[i] += model.weights[index[row == i]].astype(float).mean()
    assert np.allclose(got, want)
    grams = list(quality.features(data, off, words, spans[2]))
    assert [len(x[0]) for x in grams] == [6, 4, 13 + 7, 12 + 6]


def test_bpe(docs, empty):
    enc = bpe.encoder(*bpe.default_paths())
    got = ordered(bpe.encode(docs, block_bytes=3000), "doc_id", "n_tokens", "ids", "decoded")
    want = []
    for d, t in awkward():
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), bytearray(np.array(ids, "<u4").tobytes()), bytearray((t or "").encode())))
    assert got == by_key(want)
    assert bpe.encode(empty).count() == 0
    short = bpe.token_ids(bpe.encode(docs)).where("doc_id in (5, 7, 12)").collect()
    text = dict(awkward())
    assert all(list(r.token_ids) == enc.encode_ordinary(text[r.doc_id]) for r in short)


def test_bpe_shares_one_exchange(docs):
    plan = bpe.encode(docs)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_bpe_rejects_unknown_ids():
    with pytest.raises(ValueError):
        bpe.decode_ids(np.array([50_300], np.uint32), bpe.token_table(bpe.default_paths()[0]))


def test_viterbi_matches_one_pass():
    rng = np.random.default_rng(2)
    score = rng.normal(size=(400, 3)).astype(np.float32) * 3
    row = np.sort(rng.integers(0, 9, 400))
    want = []
    for r in np.unique(row):
        s = score[row == r].astype(float)
        best, back = s[0].copy(), []
        for x in s[1:]:
            ways = best[:, None] - 4.0 * (1 - np.eye(3))
            back.append(ways.argmax(0))
            best = ways.max(0) + x
        label = [int(best.argmax())]
        for b in reversed(back):
            label.append(int(b[label[-1]]))
        want += label[::-1]
    for run in (1, 7, 1000):
        assert langid.viterbi(score, row, 4.0, run).tolist() == want


def test_language(spark, tables, docs, empty):
    d = tables["documents"]
    model = langid.fit(langid.may_learn(d))
    got = {r.doc_id: r for r in langid.identify(d, model).join(d.select("doc_id", "lang", langid.held_out().alias("held")), "doc_id").collect()}
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())
    assert np.mean([r.lang_pred == r.lang for r in got.values() if r.held]) > 0.97
    odd = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for k in (4, 5, 6):
        assert (odd[k].lang_pred, odd[k].score, odd[k].spans) == ("und", 0.0, [])
    assert 0 <= odd[12].score <= 1
    assert langid.identify(empty, model).count() == 0
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.keep(docs, model).columns == docs.columns
    text = {r.lang: r.text for r in d.where("length(text) between 1500 and 4000 and lang in ('de', 'es')").orderBy("doc_id").collect()}
    both = spark.createDataFrame([(1, text["de"] + " " + text["es"])], "doc_id long, text string")
    spans = langid.identify(both, model).first().spans
    assert [s.lang for s in spans] == ["de", "es"]
    assert abs(spans[1].start - len(text["de"])) < 40


def test_language_selects(spark, tables):
    """What keep() lets through of held-out documents, of mixtures of them, of shuffled letters and of unwanted languages."""
    d = tables["documents"]
    model = langid.fit(langid.may_learn(d))
    held = [(r.doc_id, r.text, r.lang) for r in d.where(langid.held_out()).where("length(text) > 400").orderBy("doc_id").collect()]
    by = defaultdict(list)
    for _, text, lang in held:
        by[lang].append(text)
    pairs = [(a[:n], b[:n]) for x, y in (("en", "de"), ("de", "fr"), ("es", "en")) for a, b in zip(by[x], by[y]) for n in (min(len(a), len(b), 2000),)]
    mixed = [a + "\n" + b for a, b in pairs]
    r = random.Random(2)
    noise = ["".join(r.sample(t, len(t))) for _, t, _ in held] + ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)) for _ in range(20)]
    passed = lambda texts, **p: langid.keep(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, **p).count() / len(texts)
    assert passed([t for _, t, _ in held]) > 0.97
    assert passed(mixed) < 0.2 and len(mixed) > 5
    assert passed(noise) < 0.05
    kept = {x.doc_id for x in langid.keep(d, model, wanted=["en"]).select("doc_id").collect()}
    truth = {x.doc_id for x in d.where("lang = 'en'").select("doc_id").collect()}
    assert len(kept & truth) > 0.97 * len(kept) and len(kept & truth) > 0.95 * len(truth)
    assert langid.keep(d, model, wanted=[]).count() == 0


def test_license(spark, docs, empty):
    got = ordered(license.scan(docs), "doc_id", "first_line", "license_id")
    assert got == [(16, 0, "MIT"), (16, 1, "CC-BY-NC-4.0")]
    assert license.scan(empty).count() == 0
    cases = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "foo // SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "You need a driving licence and a warranty to take part in this.": None,
        "Licensed under CC BY 3.0.": None,
    }
    assert {k: next((r[0] for r in license.judge(k)), None) for k in cases} == cases
    wrapped = "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software, a copyright work, and associated documentation files\n(the \"Software\"), to deal in the Software without restriction under this licence"
    df = spark.createDataFrame([(1, wrapped)], "doc_id long, text string")
    assert [r.license_id for r in license.scan(df).collect()] == ["MIT"]


def test_license_wrapped_headers(spark):
    """The standard 80-column MIT and BSD headers, plain and in comments, with lines that name nothing."""
    mit = """MIT License

Copyright (c) 2024 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
    bsd = """Copyright (c) 2024, A. Author. All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice."""
    gpl = """This program is free software: you can
redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software
Foundation, either version 3 of the License, or (at your
option) any later version."""
    comment = lambda t: "\n".join(f" * {x}" for x in t.split("\n"))
    rows = [(1, mit), (2, bsd), (3, gpl), (4, comment(mit)), (5, comment(bsd)), (6, mit + "\n\n" + mit), (7, prose(40, 400) + "\n" + mit[mit.index("Permission") :])]
    got = ordered(license.scan(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "first_line", "license_id")
    assert got == [(1, 4, "MIT"), (2, 0, "Proprietary"), (2, 1, "BSD-3-Clause"), (3, 0, "GPL-3.0"), (4, 4, "MIT"), (5, 0, "Proprietary"), (5, 1, "BSD-3-Clause"), (6, 4, "MIT"), (6, 18, "MIT"), (7, 1, "MIT")]


WHOLE = {"MIT": license._MIT, "ISC": license._ISC, "Zlib": license._ZLIB, "Unlicense": license._UNLICENSE, "Apache-2.0": license._APACHE, "BSD-2-Clause": license._BSD_HEAD + license._BSD_TWO + license._BSD_TAIL, "BSD-3-Clause": license._BSD_HEAD + license._BSD_TWO + license._BSD_THIRD + license._BSD_TAIL}


def test_license_layouts(spark):
    """Unaltered wordings wrapped, in comments, on one line and deep in a long line; and with a deciding word changed."""
    lines = {
        "Released under the Apache License 2.0": "Apache-2.0", "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause", "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0", "Licensed under the ISC License.": "ISC",
        "Released under the MIT License.": "MIT", "Licensed under the zlib License.": "Zlib", "This work is licensed under the Eclipse Public License 2.0.": "EPL-2.0", "Released under the BSD 2-Clause License": "BSD-2-Clause",
    }
    rows, want = [], set()
    for text, name in lines.items():
        for layout in (text, f"{prose(1, 30)} {text} {prose(2, 30)}", f"{prose(3, 3000)} {text} {prose(4, 3000)}"):
            want.add((len(rows), name))
            rows.append((len(rows), layout))
    for name, text in WHOLE.items():
        wrap = "\n".join(textwrap.fill(x, 72) for x in text.split("\n"))
        for layout in (wrap, "\n".join(f" * {x}" for x in wrap.split("\n")), " ".join(text.split()), prose(5, 50) + "\n\n" + wrap + "\n\n" + prose(6, 50)):
            want.add((len(rows), name))
            rows.append((len(rows), layout))
    none = ["Licensed under the BSD 4-Clause License.", "Licensed under CC BY-NC-SA 4.0.", "Released under the Apache License 1.1", prose(7, 400) + " the licence of the warranty " + prose(8, 400)]
    rows += [(len(rows) + i, x) for i, x in enumerate(none)]
    got = license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license_id) for r in got} == want and len(got) == len(want)
    twice = license.scan(spark.createDataFrame([(1, f"{prose(9, 20)} All rights reserved. Licensed under the MIT License. {prose(9, 9)} Licensed under the MIT License.")], "doc_id long, text string")).collect()
    assert sorted(r.license_id for r in twice) == ["MIT", "MIT", "Proprietary"]


def test_license_against_every_template(tables):
    """The first notice of a line is the wording that saves most on the line's words round it, among all that the words confirm."""
    lines = {line for r in tables["documents"].collect() for line in (r.text or "").split("\n") if len(line) < 2000 and re.search(license.TRIGGER, line)}
    lines |= {w for some in license.TEMPLATES.values() for w in some if len(w) < 300}
    for line in lines:
        held, ranked = license.words_of(line), []
        for name, wording, t, _, c, _ in license.wordings():
            if license.confirmed(t, held)[0]:
                low, high = license.around(t, held)
                m = license.spots(line)
                raw = (line if high - low == len(held) else line[m[low].start() : m[high - 1].end()]).encode()
                ranked.append((len(c.compress(raw)) - license._press(raw), name, wording))
        assert next((x[0] for x in license.judge(line)), None) == (min(ranked)[1] if ranked else None), line
    assert len(lines) > 80


def test_license_whole_table(tables):
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "Proprietary"}
    want = {(r.doc_id, v) for r in tables["documents"].collect() for k, v in lines.items() if k in (r.text or "")}
    assert {(r.doc_id, r.license_id) for r in license.scan(tables["documents"]).collect()} == want


def test_digests_of_registered_bpe(spark, sf_dir):
    enc = bpe.encoder(*bpe.default_paths())
    got = {r.doc_id: r for r in bpe.op5_byte_bpe(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = enc.encode_ordinary(r.text or "")
        x = got[r.doc_id]
        assert (x.n_tokens, x.ids_sha256, x.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
