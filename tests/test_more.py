"""Operators and helpers without a DuckDB twin, against brute force or files made here."""

from __future__ import annotations

import json
import math
import os
import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytolake.operators import embedding, neighbors, ordering, ranking, reads
from cytolake.plans import upkeep, validation
from cytolake.sources import bam, services


def test_placed(spark):
    rng = np.random.default_rng(1)
    v = rng.permutation(1000).tolist()
    got = ordering.placed(spark.createDataFrame([(x, x % 7) for x in v], "a long, b long"), ["b", "a"]).collect()
    want = {x: i for i, x in enumerate(sorted(v, key=lambda x: (x % 7, x)))}
    assert {r.a: r.place for r in got} == want
    assert ordering.placed(spark.createDataFrame([], "a long"), ["a"]).count() == 0


def test_quantiles(spark):
    rng = np.random.default_rng(3)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 501), (None, 40)) for v in rng.integers(0, 60, n) / 7] + [("d", None), ("c", None), ("c", float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double")
    at = {"least": 0.0, "q33": 0.33, "mid": 0.5, "most": 1.0}
    for by in ([], ["g"]):
        want = df.groupBy(*by).agg(*[F.percentile("v", q).alias(k) for k, q in at.items()]).where("mid is not null").collect()
        assert sorted(map(repr, ordering.quantiles(df, "v", at, by).collect())) == sorted(map(repr, want))
    assert ordering.quantiles(df.where("v is null"), "v", at).collect() == [(None,) * 4]
    assert ordering.quantiles(df.where("v is null"), "v", at, ["g"]).count() == 0
    assert ordering.quantiles(spark.createDataFrame([(2.5,)] * 1000, "v double"), "v", at).collect() == [(2.5,) * 4]


def test_knn_2d_of_coincident_points(spark):
    """50,000 points at one place and a dense spot beside it, without a row for each pair."""
    n = 50_000
    spot = spark.range(n).selectExpr("id", "1.0D AS x", "2.0D AS y")
    rng = np.random.default_rng(2)
    near = [(n + i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(1, 1e-7, (300, 2)))] + [(n + 300 + i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-50, 50, (100, 2)))]
    points = spot.unionByName(spark.createDataFrame(near, "id long, x double, y double"))
    got = neighbors.knn_2d(points, 3).where(f"id in (0, 5, {n - 1}) or id >= {n}").collect()
    by = {}
    for r in sorted(got, key=lambda r: r.rank):
        by.setdefault(r.id, []).append((r.dist, r.nbr))
    assert [b for _, b in by[0]] == [1, 2, 3] and [b for _, b in by[5]] == [0, 1, 2] and [b for _, b in by[n - 1]] == [0, 1, 2]
    every = [(i, 1.0, 2.0) for i in range(4)] + near
    for i, x, y in near[::40]:
        want = sorted((math.hypot(x - a, y - b), j) for j, a, b in every if j != i)[:3]
        assert [b for _, b in by[i]] == [b for _, b in want]
        assert np.allclose([a for a, _ in by[i]], [a for a, _ in want])


def test_knn_cells_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 4, (12, 16))
    x = np.concatenate([c + rng.normal(0, 1, (120, 16)) for c in centres])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    exact = {(r.id, r.nbr) for r in neighbors.knn_blocks(df, 10).collect()}
    got = {(r.id, r.nbr) for r in neighbors.knn_cells(df, 10).collect()}
    assert len(got & exact) >= 0.95 * len(exact)
    assert {(r.id, r.nbr) for r in neighbors.knn_cells(df, 10, cells=6, probes=6).collect()} == exact
    uniform = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(0, 1, (1500, 8)))], "id long, vec array<double>")
    exact = {(r.id, r.nbr) for r in neighbors.knn_blocks(uniform, 10).collect()}
    assert len({(r.id, r.nbr) for r in neighbors.knn_cells(uniform, 10).collect()} & exact) >= 0.9 * len(exact)


def test_absorption(spark):
    """A walk on a line of 6 ends left or right with probabilities that are linear in the place."""
    edges = [(i, j, 1.0) for i in range(6) for j in (i - 1, i + 1) if 0 <= j < 6] + [(7, 8, 1.0)]
    term = spark.createDataFrame([(0, "left"), (5, "right")], "id long, fate string")
    got = {(r.id, r.fate): r.probability for r in neighbors.absorption(spark.createDataFrame(edges, "src long, dst long, weight double"), term, tolerance=1e-4, rounds=40).collect()}
    for i in range(6):
        assert abs(got[i, "right"] - i / 5) < 0.01 and abs(got[i, "left"] - 1 + i / 5) < 0.01
    assert got[7, "left"] == got[8, "right"] == 0


def test_graph_layout_separates_groups(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 1, (60, 6)) for c in (0, 9)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    e = neighbors.connectivities(neighbors.knn_blocks(df, 10))
    start = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (120, 2)))], "id long, x double, y double")
    p = {r.id: (r.x, r.y) for r in neighbors.graph_layout(e, start, rounds=12).collect()}
    p = np.array([p[i] for i in range(120)])
    d = np.linalg.norm(p[:, None] - p[None], axis=2)
    np.fill_diagonal(d, np.inf)
    assert np.mean((d.argmin(1) < 60) == (np.arange(120) < 60)) > 0.9
    again = {r.id: (r.x, r.y) for r in neighbors.graph_layout(e, start, rounds=2).collect()}
    assert again == {r.id: (r.x, r.y) for r in neighbors.graph_layout(e, start, rounds=2).collect()}


def test_align_batches(spark):
    rng = np.random.default_rng(5)
    base = np.concatenate([rng.normal(c, 0.6, (40, 5)) for c in (0, 7)])
    shift = np.array([2.0, -1.0, 1.5, 0.0, 1.0])
    rows = [(i, v.tolist(), "a") for i, v in enumerate(base)] + [(1000 + i, (v + shift + rng.normal(0, 0.1, 5)).tolist(), "b") for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, batch string")
    got = {r.id: np.array(r.vec) for r in neighbors.align_batches(df, "batch").collect()}
    assert len(got) == 160 and all(np.allclose(got[i], base[i]) for i in range(80))
    off = np.mean([got[1000 + i] - base[i] for i in range(80)], axis=0)
    assert np.linalg.norm(off) < 0.35 * np.linalg.norm(shift)
    pairs = neighbors.mutual_neighbors(df, "batch", 8).collect()
    assert pairs and all(p.a < 1000 <= p.b for p in pairs)


def test_negative_binomial(spark):
    """Against the score equations at the fitted values, and for the right genes."""
    rng = np.random.default_rng(6)
    depth = rng.uniform(0.5, 2, 12)
    mean = rng.uniform(20, 200, 40)
    rows = []
    for g in range(40):
        fold = 4.0 if g < 4 else 1.0
        for s in range(12):
            mu = mean[g] * depth[s] * (fold if s < 6 else 1.0)
            rows.append((g, f"s{s:02d}", "x" if s < 6 else "y", float(rng.negative_binomial(10, 10 / (10 + mu)))))
    df = spark.createDataFrame(rows, "gene_id long, sample string, condition string, value double")
    factor = {r["sample"]: r.factor for r in ranking.size_factors(df, "sample").collect()}
    ratio = np.array([factor[f"s{s:02d}"] for s in range(12)]) / depth
    assert ratio.std() / ratio.mean() < 0.15
    got = {r.gene_id: r for r in ranking.negative_binomial(df, "sample", "condition", "x").collect()}
    assert all(abs(got[g].log2fc - 2) < 1 and got[g].padj < 0.05 for g in range(4))
    assert sum(got[g].padj < 0.05 for g in range(4, 40)) <= 3
    f = np.array([factor[f"s{s:02d}"] for s in range(12)])
    first = np.arange(12) < 6
    for g in (0, 7):
        y = np.array([v for k, _, _, v in rows if k == g])
        alpha, beta1 = got[g].dispersion, got[g].log2fc * math.log(2)
        grid = np.linspace(beta1 - 0.5, beta1 + 0.5, 101)

        def profile(b1, y=y, alpha=alpha):
            best = -np.inf
            for b0 in np.linspace(np.log((y / f).mean()) - 3, np.log((y / f).mean()) + 3, 1201):
                mu = f * np.exp(b0 + b1 * first)
                best = max(best, float((y * np.log(mu) - (y + 1 / alpha) * np.log(1 + alpha * mu)).sum()))
            return best

        assert abs(grid[np.argmax([profile(b) for b in grid])] - beta1) < 0.02


def bgzf(data: bytes, block: int = 700) -> bytes:
    out = []
    for x in range(0, len(data), block):
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = z.compress(data[x : x + block]) + z.flush()
        out.append(b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data[x : x + block]), len(data[x : x + block])))
    return b"".join(out) + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def record(ref, pos, mapq, flag, cigar, tags):
    name, seq = b"r\0", 10
    ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(op)) for n, op in cigar)
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), mapq, 0, len(cigar), flag, seq, -1, -1, 0) + name + ops + bytes((seq + 1) // 2) + bytes(seq) + tags
    return struct.pack("<i", len(body)) + body


def test_bam(spark, tmp_path):
    head = b"@HD\tVN:1.6\n"
    data = b"BAM\1" + struct.pack("<i", len(head)) + head + struct.pack("<i", 2) + b"".join(struct.pack("<i", len(n)) + n + struct.pack("<i", 9999) for n in (b"chr1\0", b"chr2\0"))
    t = b"NHi" + struct.pack("<i", 1) + b"BXBs" + struct.pack("<I", 2) + bytes(4) + b"CBZACGT-1\0" + b"xfA+" + b"GNZABC\0"
    want = []
    for i in range(200):
        cigar = [(20, "M"), (100, "N"), (30, "M")] if i % 2 else [(5, "S"), (45, "M")]
        data += record(i % 2, 10 * i, 255 if i % 3 else 60, 256 if i % 5 == 0 else 0, cigar, t if i % 4 else b"")
        want.append((f"chr{1 + i % 2}", 10 * i, 10 * i + (150 if i % 2 else 45), 255 if i % 3 else 60, False, i % 5 == 0, False, "ACGT-1" if i % 4 else None, "ABC" if i % 4 else None, "20M100N30M" if i % 2 else "5S45M"))
    data += record(-1, -1, 0, 4, [], b"")
    want.append((None, -1, -1, 0, True, False, False, None, None, ""))
    (tmp_path / "a.bam").write_bytes(bgzf(data))
    got = bam.read_bam(spark, [str(tmp_path / "a.bam")])
    assert [tuple(r) for r in got.collect()] == want
    assert reads.usable(got).count() == sum(w[3] == 255 and not w[5] and w[7] is not None for w in want)
    (tmp_path / "b.bam").write_bytes(bgzf(data[:-7]))
    with pytest.raises(Exception, match="ends within a record"):
        bam.read_bam(spark, [str(tmp_path / "b.bam")]).count()


def test_validation():
    ticks = iter(range(100))
    fine = validation.validate(lambda: {"cells": 100.0, "ari": 0.9}, lambda: {"cells": 100.0, "ari": 0.9}, repeats=3)
    assert fine.decision == "PASS" and fine.reasons == [] and json.loads(fine.to_json())["metrics"]["ari"]["ratio"] == 1.0
    lost = validation.validate(lambda: {"ari": 1.0, "x": 1.0}, lambda: {"ari": 0.9}, warm_ups=0, repeats=3)
    assert lost.decision == "ROLLBACK_REQUIRED" and lost.reasons == ["ari: mean ratio 0.9000", "x: missing"]
    shaky = validation.validate(lambda: {"ari": 1.0}, lambda: {"ari": 1.0 if next(ticks) % 2 else 0.995}, warm_ups=0, repeats=4)
    assert shaky.reasons and "interval" in shaky.reasons[0]
    slow = validation.validate(lambda: {}, lambda: time.sleep(0.02) or {}, warm_ups=0, repeats=2, limits=validation.Limits(least_gain=0.5))
    assert slow.decision == "ROLLBACK_REQUIRED" and slow.reasons[0].startswith("time")


def test_upkeep(tmp_path, monkeypatch):
    assert upkeep.soft_import("json")[0] is json and upkeep.soft_import("no_such_module_here")[0] is None
    assert isinstance(upkeep.soft_import("no_such_module_here")[1], ImportError)
    monkeypatch.setenv("SOME_FLAG", "1")
    upkeep.require_settings({"SOME_FLAG": "1"})
    with pytest.raises(RuntimeError, match="OTHER_FLAG=1"):
        upkeep.require_settings({"SOME_FLAG": "1", "OTHER_FLAG": "1"})
    steps = upkeep.run_steps([("a", ["true"]), ("b", ["false"]), ("c", ["true"])])
    assert [(s["name"], s["returncode"]) for s in steps] == [("a", 0), ("b", 1)]
    old, new = tmp_path / "old", tmp_path / "new.txt"
    old.mkdir()
    (old / "x").write_text("x")
    new.write_text("y")
    os.utime(old, (1, 1))
    assert upkeep.retire(str(tmp_path)) == ["old"] and new.exists()
    assert upkeep.retire(str(tmp_path), everything=True) == ["new.txt"] and upkeep.retire(str(tmp_path / "none")) == []


def test_services():
    fetch = lambda url: [{"studyId": "lusc_b", "name": "B", "allSampleCount": 5}, {"studyId": "x", "name": "other"}, {"studyId": "a", "name": "A LUSC study"}]
    assert [x["studyId"] for x in services.studies("lusc", fetch)] == ["a", "lusc_b"]

    def broken(url):
        raise OSError

    assert services.studies("lusc", broken) == []
    work = {"message": {"title": ["On | cells"], "author": [{"family": "Roe"}, {"family": "Poe"}], "container-title": ["J"], "issued": {"date-parts": [[2020, 1]]}}}
    got = services.citation("10.1/x", lambda url: work)
    assert got == {"doi": "10.1/x", "title": "On | cells", "authors": "Roe et al.", "journal": "J", "year": "2020"}
    assert set(services.citation("10.1/x", broken).values()) == {"10.1/x", "Unknown"}
    table = services.citation_table([got])
    assert "On \\| cells" in table
    text = "# T\n\n## References\n\nold\n\n### sub\n\n## Next\n\nmore\n"
    assert services.rewrite_section(text, "## References", table) == f"# T\n\n## References\n\n{table}\n\n## Next\n\nmore\n"
    assert services.rewrite_section("# T\n", "## References", "b") == "# T\n\n## References\n\nb\n"


def test_explained_and_root():
    total, n = embedding.explained([0.5, 0.3, 0.15, 0.05])
    assert n == 3 and abs(total[-1] - 1) < 1e-9
