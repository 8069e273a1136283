"""Neighbours, embeddings and iterative graph operators against plain numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytolake.operators import cnv, embedding, neighbors, reads, scoring


def brute(x, k, q=None, qi=None):
    out = []
    for i, p in enumerate(x if q is None else q):
        d = ((x - p) ** 2).sum(1)
        if q is None:
            d[i] = np.inf
        out.append(np.lexsort((np.arange(len(x)), d))[:k].tolist())
    return out


def points(spark, x, pt=None):
    rows = [(i, float(a), float(b), None if pt is None else float(pt[i])) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x double, y double, pt double")


def lists(df):
    got: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.id, r["rank"])):
        got.setdefault(r.id, []).append(r.nbr)
    return got


@pytest.mark.parametrize("shape", ["cloud", "clumps", "line", "tiny", "same"])
def test_knn_2d(spark, shape):
    rng = np.random.default_rng(42)
    x = {"cloud": rng.normal(size=(150, 2)), "clumps": np.concatenate([rng.normal(size=(70, 2)) * 0.01, rng.normal(size=(5, 2)) * 50]), "line": np.c_[np.arange(60.0), np.zeros(60)], "tiny": rng.normal(size=(4, 2)), "same": np.ones((12, 2))}[shape]
    k = 5
    got = lists(neighbors.knn_2d(points(spark, x).select("id", "x", "y"), k))
    assert [got[i] for i in range(len(x))] == brute(x, min(k, len(x) - 1))


def test_knn_2d_queries(spark):
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(80, 2)), rng.normal(size=(30, 2)) * 4
    got = lists(neighbors.knn_2d(points(spark, x).select("id", "x", "y"), 7, points(spark, q).select("id", "x", "y")))
    assert [got[i] for i in range(30)] == brute(x, 7, q)


def vectors(spark, x, batch=None):
    rows = [(i, [float(v) for v in r], None if batch is None else str(batch[i])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, vec array<double>, batch string")


def test_knn_blocks(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(90, 6))
    got = lists(neighbors.knn_blocks(vectors(spark, x), 5, block_rows=20))
    assert [got[i] for i in range(90)] == brute(x, 5)
    b = rng.integers(0, 2, 90)
    per = neighbors.knn_by_batch(vectors(spark, x, b), "batch", 3).collect()
    assert len(per) == 90 * 2 * 3 and all(str(b[r.nbr]) == r.batch and r.nbr != r.id for r in per)


def test_pseudo_velocity_matches_loop(spark):
    rng = np.random.default_rng(42)
    x, pt = rng.normal(size=(120, 2)), np.sort(rng.random(120))
    got = {r.id: (r.vx, r.vy, r.speed) for r in neighbors.pseudo_velocity(points(spark, x, pt)).collect()}
    near = brute(x, 14)
    for i in range(120):
        v = np.mean([(x[j] - x[i]) * (pt[j] - pt[i]) for j in near[i]], axis=0)
        assert np.allclose(got[i], [*v, np.linalg.norm(v)], atol=1e-10)
    p = points(spark, x, pt)
    scale = neighbors.arrow_scale(p, neighbors.pseudo_velocity(p)).first().scale
    speed = np.array([got[i][2] for i in range(120)])
    assert scale == pytest.approx(np.median(speed) / (np.ptp(x, axis=0).max() * 0.05))


def test_connectivities(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 3))
    knn = neighbors.knn_blocks(vectors(spark, x), 6)
    w = np.zeros((40, 40))
    for r in neighbors.connectivities(knn).collect():
        w[r.src, r.dst] = r.weight
    assert np.allclose(w, w.T) and (w >= 0).all() and w.max() <= 1 + 1e-12
    raw = pd.DataFrame([r.asDict() for r in knn.collect()])
    for _, g in raw.groupby("id"):
        d = np.sort(g["dist"].to_numpy())
        band = next(neighbors._bandwidths([pd.DataFrame({"id": [0], "d": [d]})]))
        s = np.exp(-np.maximum(0, d - d[0]) / band["sigma"][0]).sum()
        assert s == pytest.approx(np.log2(7), abs=1e-6)


def test_fate_and_consistency(spark):
    e = spark.createDataFrame([(0, 1, 1.0), (0, 2, 3.0), (1, 2, 2.0), (2, 0, 1.0)], "src long, dst long, weight double")
    c = spark.createDataFrame([(0, "a", 0.1), (1, "b", 0.5), (2, "c", 0.9)], "id long, label string, pt double")
    got = {(r.id, r.fate): r.probability for r in neighbors.fate_probabilities(e, c).collect()}
    assert got == {(0, "c"): 1.0, (1, "c"): 1.0, (2, "c"): 0.0}
    assert neighbors.direction_consistency(e, e).first().consistency == 1.0
    assert neighbors.direction_consistency(e, e.where("false")).first().consistency is None


def clusters(n=3, size=25, seed=0, dim=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n, dim)) * 6
    return np.concatenate([c + rng.normal(size=(size, dim)) for c in centre]), np.repeat(np.arange(n), size)


def test_pca(spark):
    x, _ = clusters()
    scores, ratio = embedding.pca(vectors(spark, x).select("id", "vec"), 4)
    got = np.stack([r.vec for r in scores.orderBy("id").collect()])
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :4] * s[:4]), atol=1e-6)
    assert np.allclose(ratio, (s**2 / (s**2).sum())[:4])
    assert embedding.explained([0.5, 0.3, 0.15]) == (pytest.approx([0.5, 0.8, 0.95]), 3)


@pytest.mark.parametrize("driver_nodes", [5000, 0])
def test_communities(spark, driver_nodes):
    x, lab = clusters(size=14)
    e = neighbors.connectivities(neighbors.knn_blocks(vectors(spark, x).select("id", "vec"), 6))
    got = {r.id: r.cluster for r in embedding.communities(e, 0.5, rounds=6, driver_nodes=driver_nodes).collect()}
    pure = [len({got[i] for i in range(len(x)) if lab[i] == k}) for k in range(3)]
    ids = spark.createDataFrame([(i, str(k)) for i, k in enumerate(lab)], "id long, cluster string")
    best = embedding.modularity(e, ids, 0.5)
    mine = embedding.modularity(e, spark.createDataFrame(list(got.items()), "id long, cluster string"), 0.5)
    assert mine > best - 0.1 and max(pure) <= 4
    if driver_nodes:
        assert pure == [1, 1, 1]


def test_diffusion(spark):
    rng = np.random.default_rng(3)
    t = np.sort(rng.random(50))
    x = np.c_[t * 10, rng.normal(size=50) * 0.05]
    e = neighbors.connectivities(neighbors.knn_blocks(vectors(spark, x).select("id", "vec"), 10))
    maps, eigen = embedding.diffusion_map(e, 5, 24)
    w = np.zeros((50, 50))
    for r in e.collect():
        w[r.src, r.dst] = r.weight
    q = w.sum(1)
    k = w / np.outer(q, q)
    d = k.sum(1)
    want = np.sort(np.linalg.eigvalsh(k / np.sqrt(np.outer(d, d))))[::-1][:3]
    assert np.allclose(eigen[:3], want, atol=5e-3)
    pt = np.array([r.pt for r in embedding.diffusion_pseudotime(maps, eigen, 0).orderBy("id").collect()])
    rank = lambda v: np.argsort(np.argsort(v))
    assert np.corrcoef(rank(pt), rank(t))[0, 1] > 0.95 and pt[0] == 0 and pt.max() == 1


def test_harmony_mixes_batches(spark):
    x, lab = clusters(2, 40, dim=5)
    b = np.arange(80) % 2
    x = x + b[:, None] * np.array([3.0, 0, 0, 0, 0])
    v = vectors(spark, x, b)
    got = np.stack([r.vec for r in embedding.harmony(v, "batch", clusters=4, rounds=4).orderBy("id").collect()])
    gap = lambda z: np.abs(z[b == 0].mean(0) - z[b == 1].mean(0)).max()
    assert gap(got) < 0.6 * gap(x)
    assert np.linalg.norm(got[lab == 0].mean(0) - got[lab == 1].mean(0)) > 3


def test_combat_takes_batch_means_out(spark):
    rng = np.random.default_rng(8)
    n, m = 40, 12
    b = np.arange(n) % 2
    x = rng.gamma(2, 1, (n, m)) + b[:, None] * 2
    e = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(n) for j in range(m)], "cell_id long, gene_id long, value double")
    c = spark.createDataFrame([(i, str(b[i])) for i in range(n)], "cell_id long, batch string")
    got = np.zeros((n, m))
    for r in embedding.combat(e, c, "batch").collect():
        got[r.cell_id, r.gene_id] = r.value
    gap = lambda z: np.abs(z[b == 0].mean(0) - z[b == 1].mean(0)).mean()
    assert gap(got) < 0.3 * gap(x)


def test_doublets_small_data_are_singlets(spark):
    c = spark.createDataFrame([(1,), (2,)], "cell_id long")
    e = spark.createDataFrame([(1, 1, 1.0)], "cell_id long, gene_id long, value double")
    assert [(r.score, r.predicted) for r in embedding.doublet_scores(e, c, [1]).collect()] == [(0.0, False)] * 2


def test_doublets_score_mixtures(spark):
    rng = np.random.default_rng(0)
    rate = np.ones((2, 60)) * 0.3
    rate[0, :30], rate[1, 30:] = 6, 6
    x = np.concatenate([rng.poisson(rate[np.arange(80) % 2]), rng.poisson(rate.sum(0), (6, 60))])
    e = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "cell_id long, gene_id long, value double")
    c = spark.createDataFrame([(i,) for i in range(86)], "cell_id long")
    s = np.array([r.score for r in embedding.doublet_scores(e, c, list(range(60)), components=5).orderBy("cell_id").collect()])
    assert s[80:].mean() > 2 * s[:80].mean()


def test_window_cnv(spark):
    rng = np.random.default_rng(1)
    n, m = 12, 130
    x = rng.poisson(0.8, (n, m)).astype(float)
    chrom = np.array(["1"] * 70 + ["2"] * 58 + ["3"] * 2)
    e = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "cell_id long, gene_id long, value double")
    c = spark.createDataFrame([(i, "ref" if i < 11 else "x") for i in range(n)] + [(99, "x")], "cell_id long, cell_type string")
    g = spark.createDataFrame([(j, str(chrom[j]), j) for j in range(m)], "gene_id long, chromosome string, start long")
    got = {r.cell_id: r for r in cnv.window_cnv(e, c, g, 20, "ref").collect()}
    full = np.vstack([x, np.zeros(m)]) - x[:11].mean(0)
    for i, cell in enumerate([*range(n), 99]):
        want = full[i].copy()
        for a, b in ((0, 70), (70, 128)):
            pad = np.pad(full[i, a:b], (10, 9), mode="edge")
            want[a:b] = [pad[t : t + 20].mean() for t in range(b - a)]
        assert np.allclose(got[cell].profile, want) and got[cell].cnv_score == pytest.approx(want.var())
    with pytest.raises(ValueError):
        cnv.window_cnv(e, c, g.limit(50), 20)


@pytest.mark.parametrize("parameters, seen", [({}, 2100), ({"limit": 500, "sample": 200}, 200)])
def test_clones_cluster_all_cells_up_to_limit(spark, monkeypatch, parameters, seen):
    rng = np.random.default_rng(3)
    means = rng.normal(size=(3, 12))
    x = (means[np.arange(2100) % 3] + 0.3 * rng.normal(size=(2100, 12))).astype(np.float32)
    df = spark.createDataFrame([(f"c{i:04d}", v.tolist()) for i, v in enumerate(x)], "cell_id string, profile array<double>").repartition(3)
    sizes, ward = [], cnv.ward
    monkeypatch.setattr(cnv, "ward", lambda x, n: sizes.append(len(x)) or ward(x, n))
    got = {r.cell_id: r.clone for r in cnv.hierarchical_clones(df, **parameters).collect()}
    assert sizes == [seen] and len(got) == 2100
    if seen == 2100:
        assert [got[f"c{i:04d}"] for i in range(2100)] == [f"Clone_{i}" for i in ward(x, 3)]


def test_linear_activity(spark):
    rng = np.random.default_rng(6)
    n, m = 10, 40
    x, w = rng.random((n, m)), rng.normal(size=(m, 2)) * (rng.random((m, 2)) < 0.5)
    e = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(n) for j in range(m)], "cell_id long, gene_id long, value double")
    wf = spark.createDataFrame([(f"p{k}", j, float(w[j, k])) for k in range(2) for j in range(m) if w[j, k]], "regulator string, gene_id long, weight double")
    got = {(r.cell_id, r.regulator): r.activity for r in scoring.linear_activity(e, wf, ["p0", "p1"], m).collect()}
    one = {(r.cell_id, r.regulator): r.activity for r in scoring.univariate_activity(e, wf, m).collect()}
    d = np.c_[np.ones(m), w]
    inv = np.linalg.inv(d.T @ d)
    for i in range(n):
        b = inv @ d.T @ x[i]
        rss = ((x[i] - d @ b) ** 2).sum()
        for k in range(2):
            assert got[i, f"p{k}"] == pytest.approx(b[k + 1] / np.sqrt(rss / (m - 3) * inv[k + 1, k + 1]))
            r = np.corrcoef(w[:, k], x[i])[0, 1]
            assert one[i, f"p{k}"] == pytest.approx(r * np.sqrt((m - 2) / (1 - r * r)))


def test_velocity(spark):
    rng = np.random.default_rng(9)
    n, m = 15, 6
    s, u = rng.random((n, m)), rng.random((n, m))
    v = spark.createDataFrame([(i, j, float(s[i, j]), float(u[i, j])) for i in range(n) for j in range(m)], "cell_id long, gene_id long, s double, u double")
    e = spark.createDataFrame([(i, (i + 1) % n, 1.0) for i in range(n)], "src long, dst long, weight double")
    got = np.zeros((n, m, 2))
    mom = reads.moments(v, e)
    for r in mom.collect():
        got[r.cell_id, r.gene_id] = r.ms, r.mu
    nxt = (np.arange(n) + 1) % n
    assert np.allclose(got[:, :, 0], (s + s[nxt]) / 2)
    vel = reads.velocity(mom)
    vv = np.zeros((n, m))
    for r in vel.collect():
        vv[r.cell_id, r.gene_id] = r.v
    conf = {r.cell_id: r.velocity_confidence for r in reads.velocity_confidence(vel, e, m).collect()}
    graph = {(r.src, r.dst): r.weight for r in reads.velocity_graph(vel, e).collect()}
    length = {r.cell_id: r.velocity_length for r in reads.velocity_length(vel).collect()}
    x = got[:, :, 0]
    for i in range(n):
        j = int(nxt[i])
        assert conf[i] == pytest.approx(np.corrcoef(vv[i], vv[j])[0, 1])
        step = x[j] - x[i]
        assert graph[i, j] == pytest.approx(step @ vv[i] / np.linalg.norm(step) / np.linalg.norm(vv[i]))
        assert length[i] == pytest.approx(np.linalg.norm(vv[i]))
    t = reads.transfer(spark.range(n).withColumnRenamed("id", "cell_id"), vel.groupBy("cell_id").agg(F.count("*").alias("k")), ["k", "absent"])
    assert t.columns == ["cell_id", "k"]


def test_logistic_ranking(spark):
    rng = np.random.default_rng(0)
    lab = np.arange(90) % 3
    x = rng.poisson(0.5, (90, 9)).astype(float)
    for k in range(3):
        x[lab == k, k] += 4
    ids = spark.createDataFrame([(i, f"c{k}") for i, k in enumerate(lab.tolist())], "id long, grp string")
    got = embedding.logistic_ranking(vectors(spark, x).select("id", "vec"), ids, list(range(9))).collect()
    for k in range(3):
        mine = {r.gene_id: r.score for r in got if r.grp == f"c{k}"}
        assert max(mine, key=mine.get) == k


@pytest.mark.parametrize("size", [5, 20, 100])
def test_cnv_scores_without_profiles(spark, monkeypatch, size):
    """Scores need no dense profile: each is the variance of one, at every kind of chromosome, and values at the ends."""
    rng = np.random.default_rng(11)
    n, m = 15, 130
    x = rng.poisson(0.3, (n, m)) * rng.random((n, m))
    x[:, [0, 69, 70, 127]] = 1.5
    x[3] = 0
    chrom = np.array(["1"] * 70 + ["2"] * 54 + ["3"] * 3 + ["4"] * 2 + ["5"])
    e = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "cell_id long, gene_id long, value double")
    c = spark.createDataFrame([(i,) for i in range(n)], "cell_id long")
    g = spark.createDataFrame([(j, str(chrom[j]), 7 * j % 131) for j in range(m)], "gene_id long, chromosome string, start long")
    want = {r.cell_id: r for r in cnv.window_cnv(e, c, g, size).collect()}
    monkeypatch.setattr(cnv, "_smooth", lambda *_: pytest.fail("dense"))
    got = {r.cell_id: r.cnv_score for r in cnv.window_cnv(e, c, g, size, with_profile=False).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(np.var(want[k].profile), rel=1e-10) for k in got)


def test_simulated_neighbors_are_counted_by_place(spark, monkeypatch):
    """Points at one place are asked and sent once, and the counts are those of a plain search, ties by id included."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (300, 3)).astype(float)
    x[:120] = 1.0
    ids = rng.permutation(300) - 150
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "id long, vec array<double>")
    monkeypatch.setattr(embedding, "ASKED", 5)
    monkeypatch.setattr(embedding, "SEEN", 7)
    for k in (1, 20, 130, 299, 400):
        near = [np.lexsort((ids, ((x - v) ** 2).sum(1)))[:k] for v in x]
        want = {int(i): int((ids[n] < 0).sum()) for i, n in zip(ids, near, strict=True) if i >= 0}
        assert {r.id: r.d for r in embedding.simulated_neighbors(df, k).collect()} == want
    seen = []
    monkeypatch.setattr(embedding, "written", lambda t, name: seen.append(t.count()) or t)
    embedding.simulated_neighbors(df, 5).count()
    assert seen == [len(np.unique(x, axis=0))]


def test_box_products():
    rng = np.random.default_rng(8)
    lo = rng.integers(0, 90, 400)
    cell, hi, v = rng.integers(0, 6, 400), lo + rng.integers(1, 20, 400), rng.normal(size=400)
    x = np.zeros((6, 120))
    for a, i, j, w in zip(cell, lo, hi, v, strict=True):
        x[a, i:j] += w
    assert np.allclose(cnv.box_products(cell, lo, hi, v, 6), x @ x.T)  # blocks
    y = np.zeros((900, 120))
    y[:6] = x
    assert np.allclose(cnv.box_products(cell, lo, hi, v, 900), y @ y.T)  # pairs


@pytest.mark.parametrize("limits", [(1000, 1000), (60, 40)])
def test_window_clones_are_those_of_the_profiles(spark, monkeypatch, limits):
    rng = np.random.default_rng(12)
    n, m = 400, 130
    x = rng.poisson(0.2, (n, m)) * rng.random((n, m))
    x[::2, :60] *= 4
    x[1::4, 80:] *= 6
    x[5] = 0
    e = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "cell_id long, gene_id long, value double")
    c = spark.createDataFrame([(i,) for i in range(n)], "cell_id long")
    g = spark.createDataFrame([(j, "1" if j < 70 else "2", j) for j in range(m)], "gene_id long, chromosome string, start long")
    want = {r.cell_id: r.clone for r in cnv.hierarchical_clones(cnv.window_cnv(e, c, g, 20), *limits).collect()}
    monkeypatch.setattr(cnv, "_smooth", lambda *_: pytest.fail("dense"))
    got = {r.cell_id: r.clone for r in cnv.window_clones(e, c, g, 20, limit=limits[0], sample=limits[1]).collect()}
    assert len(set(got.values())) > 1 and got == want


def test_least_is_a_stable_sort_that_sorts_only_ties(monkeypatch):
    rng = np.random.default_rng(9)
    free, tied = rng.random((40, 200)), rng.integers(0, 5, (40, 200)).astype(float)
    tied[3, :150] = np.inf
    for d in (free, tied):
        for k in (1, 14, 199, 200, 300):
            assert (neighbors._least(d, k) == np.argsort(d, axis=1, kind="stable")[:, :k]).all()
    sizes, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *r, **q: sizes.append(a.size) or sort(a, *r, **q))
    neighbors._least(free, 14)
    assert max(sizes) <= 40 * 14
