"""Numeric expressions and statistics against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytolake import catalog
from cytolake.functions import numeric as N
from cytolake.functions import panels
from cytolake.operators import cnv, groups, matrix, ranking, reads
from cytolake.sources import gtf, tables


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_erfc(spark):
    z = [0.0, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0]
    got = [r[0] for r in frame(spark, [(x,) for x in z], "z double").select(N.erfc(F.col("z"))).collect()]
    assert all(abs(a / math.erfc(x) - 1) < 2e-7 for a, x in zip(got, z, strict=True))


def test_tails():
    assert N.student_two_sided(2.0, 10) == pytest.approx(0.07338803477074, abs=1e-10)
    assert N.student_two_sided(0.0, 5) == pytest.approx(1.0)
    assert N.student_two_sided(-3.5, 2.5) == pytest.approx(N.student_two_sided(3.5, 2.5))
    assert N.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-10)
    assert N.chi2_tail(0.5, 4) == pytest.approx(0.97350097883, abs=1e-9)
    assert N.chi2_tail(40.0, 5) == pytest.approx(1.4943e-7, rel=1e-3)


def test_exact_mann_whitney():
    from itertools import combinations

    n1, n2 = 3, 4
    every = [sum(c) - n1 * (n1 + 1) // 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
    for u, p in enumerate(N.exact_mann_whitney(n1, n2)):
        low, high = np.mean(np.array(every) <= u), np.mean(np.array(every) >= u)
        assert p == pytest.approx(min(1, 2 * min(low, high)))


def test_small_expressions(spark):
    df = frame(spark, [(4.0, 9.0, 0.0005), (-1.0, 9.0, 0.02), (1.0, 1.0, 0.2)], "a double, b double, p double")
    assert [r[0] for r in df.select(N.cyt(F.col("a"), F.col("b"))).collect()] == [6.0, 0.0, 1.0]
    assert [r[0] for r in df.select(N.stars(F.col("p"))).collect()] == ["***", "*", "ns"]
    assert [r[0] for r in df.select(N.digitize(F.lit(2.0) + F.col("a") - F.col("a"), [2, 3])).collect()] == [2, 2, 2]
    labels = frame(spark, [("10",), ("9",), ("b",), ("a",)], "l string")
    assert [r.l for r in labels.orderBy(*N.natural_key(F.col("l"))).collect()] == ["9", "10", "a", "b"]
    cig = frame(spark, [("10M5N3M",), ("10M",), (None,)], "c string")
    assert [r[0] for r in cig.select(N.has_skip(F.col("c"))).collect()] == [True, False, False]
    x = frame(spark, [(1, 8), (1, 0)], "a int, b int")
    assert [r[0] for r in x.select(N.percent(F.col("a"), F.col("b"))).collect()] == [12.5, 0.0]


def test_bh(spark):
    p = [0.001, 0.01, 0.05, 0.1, 0.5]
    df = frame(spark, [(i, x) for i, x in enumerate(p)], "i int, p double")
    got = [r.padj for r in ranking.bh_adjust(df, "p", ["i"]).orderBy("i").collect()]
    assert got == pytest.approx([0.005, 0.025, 0.05 * 5 / 3, 0.125, 0.5])
    rng = np.random.default_rng(0)
    p = np.round(rng.random(200) ** 3, 3)
    df = frame(spark, [(i, float(x)) for i, x in enumerate(p)], "i int, p double")
    got = np.array([r.padj for r in ranking.bh_adjust(df, "p", ["i"]).orderBy("i").collect()])
    order = np.argsort(p, kind="stable")
    adj = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1].clip(max=1)
    want = np.empty(len(p))
    want[order] = adj
    assert np.allclose(got, want) and (got >= p).all()


@pytest.mark.parametrize("mode", ["nearest", "reflect"])
@pytest.mark.parametrize("size", [4, 5, 10, 23])
def test_sliding_mean(spark, mode, size):
    x = np.random.default_rng(42).normal(size=17)
    df = frame(spark, [("g", i, float(v)) for i, v in enumerate(x)] + [("h", 0, 3.0)], "g string, i int, v double")
    got = {(r.g, r.i): r.smoothed for r in cnv.sliding_mean(df, ["g"], ["i"], "v", size, mode).collect()}
    s = min(size, len(x))
    pad = np.pad(x, (s // 2, s - s // 2 - 1), mode="edge" if mode == "nearest" else "symmetric")
    want = [pad[i : i + s].mean() for i in range(len(x))]
    assert [got["g", i] for i in range(len(x))] == pytest.approx(want) and got["h", 0] == 3.0


def test_sliding_mean_micro(spark):
    df = frame(spark, [(0, i, float(i + 1)) for i in range(4)], "g int, i int, v double")
    assert [r.smoothed for r in cnv.sliding_mean(df, ["g"], ["i"], "v", 4).orderBy("i").collect()] == [1.25, 1.75, 2.5, 3.25]


def dense_ranks(v):
    order = np.argsort(v, kind="stable")
    r = np.empty(len(v))
    r[order] = np.arange(1, len(v) + 1)
    for x in np.unique(v):
        r[v == x] = r[v == x].mean()
    return r


def test_wilcoxon_matches_dense_ranks(spark):
    rng = np.random.default_rng(1)
    n, m = 60, 8
    x = rng.poisson(0.7, (n, m)).astype(float)
    x[:, 7] = 0
    x[:20, 7] = 1.5
    lab = rng.integers(0, 3, n)
    e = frame(spark, [(i, j, float(x[i, j])) for i in range(n) for j in range(m) if x[i, j]], "cell_id long, gene_id long, value double")
    c = frame(spark, [(i, f"g{lab[i]}") for i in range(n)], "cell_id long, grp string")
    got = {(r.gene_id, r.grp): r for r in ranking.wilcoxon(e, c, "grp").collect()}
    assert len(got) == m * 3
    for j in range(m):
        ranks = dense_ranks(x[:, j])
        _, t = np.unique(x[:, j], return_counts=True)
        tie = 1 - (t**3 - t).sum() / (n**3 - n)
        for k in range(3):
            a = lab == k
            z = (ranks[a].sum() - a.sum() * (n + 1) / 2) / math.sqrt(tie * a.sum() * (~a).sum() * (n + 1) / 12)
            r = got[j, f"g{k}"]
            assert r.score == pytest.approx(z)
            assert r.pval == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-6)
            assert r.pct == pytest.approx((x[a, j] > 0).mean()) and r.pct_rest == pytest.approx((x[~a, j] > 0).mean())
            assert r.lfc == pytest.approx(math.log2((np.expm1(x[a, j]).mean() + 1e-9) / (np.expm1(x[~a, j]).mean() + 1e-9)))
    t = {(r.gene_id, r.grp): r for r in ranking.ttest(e, c, "grp").collect()}
    a = lab == 0
    v1, v2 = x[a, 0].var(ddof=1) / a.sum(), x[~a, 0].var(ddof=1) / (~a).sum()
    assert t[0, "g0"].score == pytest.approx((x[a, 0].mean() - x[~a, 0].mean()) / math.sqrt(v1 + v2))
    ranked = ranking.rank_genes(ranking.ttest_p(ranking.ttest(e, c, "grp")), "grp", 3)
    assert ranked.groupBy("grp").count().select("count").distinct().collect()[0][0] == 3


def test_mann_whitney_and_kruskal(spark):
    rows = [("a", "x", 1.0), ("a", "x", 2.0), ("a", "x", 3.0), ("a", "y", 4.0), ("a", "y", 5.0), ("a", "y", 6.0), ("b", "x", 1.0), ("b", "x", 1.0), ("b", "y", 1.0), ("b", "y", 2.0)]
    df = frame(spark, rows, "f string, g string, v double")
    got = {r.f: r for r in ranking.mann_whitney(df, ["f"], "g", "v", "x").collect()}
    assert (got["a"].u, got["a"].pval) == (0.0, pytest.approx(0.1))
    assert 0 < got["b"].pval <= 1
    k = {r.f: r for r in ranking.kruskal(df, ["f"], "g", "v").collect()}
    assert k["a"].h == pytest.approx(3.857142857) and k["a"].pval == pytest.approx(0.04953461, abs=1e-6)
    one = frame(spark, [(f"t{i}", n) for i, n in enumerate((5, 10, 25))], "t string, n long")
    assert all(r.z_score == 0 and r.null_sd > 0 for r in ranking.permutation_z(one, "t").collect())


def test_composition_tests(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{i}", "case" if i < 6 else "control", t, float(p)) for i in range(12) for t, p in (("T", 0.3 + 0.4 * (i < 6) + rng.random() / 50), ("B", rng.random()))]
    got = {r.t: r for r in ranking.composition_tests(frame(spark, rows, "s string, c string, t string, proportion double"), "s", "c", "t").collect()}
    assert got["T"].significant and got["T"].pval < 0.01


def test_enrichment_micro(spark):
    sel = frame(spark, [("c", g) for g in "abx"], "grp string, gene string")
    sets = frame(spark, [("S", g) for g in "abcd"], "set_name string, gene string")
    bg = frame(spark, [(g,) for g in "abcdxyzuvw"], "gene string")
    r = ranking.enrichment(sel, sets, bg, "grp").first()
    assert (r.overlap, r.gene_set_size, r.genes) == (2, 4, "a,b") and r.pval == pytest.approx(40 / 120, rel=1e-9)


def test_agreement(spark):
    df = frame(spark, [("c1", "0", "0"), ("c2", "1", "1"), ("c3", "1", "1")], "c string, a string, b string")
    assert ranking.adjusted_rand(df, "a", "b").first().ari == 1.0
    assert ranking.adjusted_rand(df.where("false"), "a", "b").first().ari is None
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 4, 80), rng.integers(0, 3, 80)
    df = frame(spark, [(i, int(x), int(y)) for i, (x, y) in enumerate(zip(a, b, strict=True))], "i int, a int, b int")
    same = lambda v: v[:, None] == v[None]
    up = np.triu_indices(80, 1)
    sa, sb = same(a)[up], same(b)[up]
    tp = (sa & sb).sum()
    got = ranking.pairwise_f1(df, "a", "b").first()
    assert got.precision == pytest.approx(tp / sb.sum()) and got.recall == pytest.approx(tp / sa.sum())
    assert ranking.pairwise_f1(df.limit(2), "a", "b").first().f1 == 1.0


def test_correlation_with_zeros(spark):
    rng = np.random.default_rng(5)
    x = rng.poisson(0.5, (40, 5)).astype(float)
    x[:, 4] = 0
    x[0, 4] = 1
    t = rng.random(40)
    e = frame(spark, [(i, j, float(x[i, j])) for i in range(40) for j in range(5) if x[i, j]], "cell_id long, gene_id long, value double")
    c = frame(spark, [(i, float(t[i])) for i in range(40)], "cell_id long, pt double")
    got = {r.gene_id: r.corr for r in ranking.pearson_with_cells(e, c, "pt").collect()}
    assert all(got[j] == pytest.approx(np.corrcoef(x[:, j], t)[0, 1]) for j in range(5))


def test_qc_limits_are_inclusive(spark):
    m = frame(spark, [(1, 200, 500.0, 20.0, 50.0), (2, 199, 500.0, 0.0, 0.0), (3, 300, 600.0, 20.1, 0.0)], "cell_id int, n_genes_by_counts int, total_counts double, mt double, ribo double")
    assert [r.cell_id for r in m.where(matrix.qc_pass(matrix.QCLimits(), "mt", "ribo")).collect()] == [1]
    assert [r.cell_id for r in m.where(matrix.standard_pass("mt")).collect()] == []
    g = frame(spark, [(1, "MT-CO1"), (2, "RPS6"), (3, "HBA1"), (4, "mt-nd1"), (5, "CD3D")], "gene_id int, symbol string")
    assert [(r.mt, r.ribo, r.hb) for r in matrix.gene_flags(g).orderBy("gene_id").collect()] == [(True, False, False), (False, True, False), (False, False, True), (True, False, False), (False, False, False)]


def test_regress_out(spark):
    rng = np.random.default_rng(2)
    n = 30
    a, b = rng.normal(size=n), rng.normal(size=n)
    x = np.maximum(0, 1 + a[:, None] * [1, 0, 2] + b[:, None] * [0, 1, -1] + rng.normal(size=(n, 3)))
    e = frame(spark, [(i, j, float(x[i, j])) for i in range(n) for j in range(3) if x[i, j]], "cell_id long, gene_id long, value double")
    c = frame(spark, [(i, float(a[i]), float(b[i])) for i in range(n)], "cell_id long, s double, g double")
    got = np.zeros((n, 3))
    for r in matrix.regress_out(e, c, ("s", "g")).collect():
        got[r.cell_id, r.gene_id] = r.value
    design = np.c_[np.ones(n), a, b]
    want = x - design @ np.linalg.lstsq(design, x, rcond=None)[0]
    assert np.allclose(got, want, atol=1e-8)


def test_coo_sums_and_symbols(spark):
    got = sorted(tuple(r) for r in tables.coo([0, 0, 1, 1, 1], [0, 0, 2, 2, 3], [1.0] * 5, spark).collect())
    assert got == [(0, 0, 2.0), (1, 2, 2.0), (1, 3, 1.0)]
    g = frame(spark, [(1, "A"), (2, "B"), (3, "A"), (4, "A")], "gene_id int, symbol string")
    assert [r.symbol for r in matrix.unique_symbols(g).orderBy("gene_id").collect()] == ["A", "B", "A-1", "A-2"]


def test_10x_folder(spark, tmp_path):
    import gzip

    for name, text in (("barcodes.tsv.gz", "C1-1\nC2-1\n"), ("features.tsv.gz", "E1\tMT-CO1\tGene Expression\nE2\tCD3D\tGene Expression\n"), ("matrix.mtx.gz", "%%MatrixMarket matrix coordinate integer general\n%x\n2 2 3\n1 1 1\n1 2 2\n2 2 3\n")):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(text)
    cells, genes, expr = tables.read_any(spark, str(tmp_path))
    assert [r.barcode for r in cells.orderBy("cell_id").collect()] == ["C1-1", "C2-1"]
    assert [r.symbol for r in genes.orderBy("gene_id").collect()] == ["MT-CO1", "CD3D"]
    assert sorted(tuple(r) for r in expr.collect()) == [(1, 1, 1.0), (2, 1, 2.0), (2, 2, 3.0)]
    with pytest.raises(FileNotFoundError):
        tables.read_any(spark, str(tmp_path / "none"))


def test_gtf(spark, tmp_path):
    (tmp_path / "genes").mkdir()
    p = tmp_path / "genes" / "genes.gtf"
    p.write_text('#c\nchr1\tX\texon\t101\t200\t.\t+\t.\tgene_id "g"; gene_name "A";\nchr1\tX\texon\t1\t2\nchr1\tX\tCDS\t1\t2\t.\t+\t.\tgene_name "A";\n')
    assert [tuple(r) for r in gtf.read_exons(spark, str(p)).collect()] == [("chr1", "A", 100, 200)]
    assert gtf.resolve_path(None, str(tmp_path)) == p
    assert gtf.resolve_path(str(tmp_path / "no.gtf"), str(tmp_path)) is None
    assert gtf.resolve_path(None, None) is None


def test_exon_containment(spark):
    ex = frame(spark, [("c", 1, 100, 200), ("c", 1, 300, 400), ("c", 2, 0, 50)], "chrom string, gene long, start long, end long")
    rows = [(100, 200, "100M", 255, 1, 1), (150, 201, "51M", 255, 1, 1), (99, 120, "21M", 255, 1, 1), (150, 350, "50M100N50M", 255, 1, 1), (100, 200, "100M", 60, 1, 1), (10, 20, "10M", 255, None, 2), (110, 120, "10M", 255, 1, 2)]
    r = frame(spark, [("c", s, e, q, False, False, False, cb, g, c) for s, e, c, q, cb, g in rows], "chrom string, start long, end long, mapq int, is_unmapped boolean, is_secondary boolean, is_supplementary boolean, cb long, gn long, cigar string")
    got = {(x.start, x.end, x.gn): x.spliced for x in reads.classify_reads(r, ex).collect()}
    assert got == {(100, 200, 1): True, (150, 201, 1): False, (99, 120, 1): False, (150, 350, 1): True, (110, 120, 2): False}
    with pytest.raises(ValueError):
        reads.shared_genes(frame(spark, [(1, 1, 3, 1)], "cell_id long, gene_id long, spliced long, unspliced long"))


def test_gamma(spark):
    rng = np.random.default_rng(4)
    x = rng.random((25, 3))
    y = 0.5 * x + 0.1 + rng.random((25, 3)) / 10
    df = frame(spark, [(i, j, float(x[i, j]), float(y[i, j])) for i in range(25) for j in range(3)], "cell_id long, gene_id long, x double, y double")
    g = {r.gene_id: r for r in reads.gamma_offset(df, "x", "y", 25.0).collect()}
    o = {r.gene_id: r.gamma for r in reads.gamma_origin(df, "x", "y").collect()}
    for j in range(3):
        slope, offset = np.polyfit(x[:, j], y[:, j], 1)
        assert g[j].gamma == pytest.approx(slope) and g[j].offset == pytest.approx(offset)
        assert o[j] == pytest.approx((x[:, j] @ y[:, j]) / (x[:, j] @ x[:, j]))


def test_ward_separates_profiles():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(3, 40))
    x = np.concatenate([b + 0.2 * rng.normal(size=(15, 40)) for b in base])
    lab = cnv.ward(x, 3)
    assert [len(set(lab[i : i + 15])) for i in (0, 15, 30)] == [1, 1, 1] and len(set(lab)) == 3


def test_groups(spark):
    df = frame(spark, [("a", "x", 1.0), ("a", "y", 2.0), ("a", "y", None), ("b", "z", float("nan")), ("b", "w", 3.0)], "g string, l string, v double")
    assert {r.g: r.majority for r in groups.majority(df, "g", "l").collect()} == {"a": "y", "b": "w"}
    s = {r.g: r for r in groups.stats(df, "g", "v").collect()}
    assert (s["a"]["count"], s["a"]["mean"], s["b"]["count"], s["b"]["max"]) == (2, 1.5, 1, 3.0)
    assert groups.first_column(df, ["q", "g"]) == "g" and groups.first_column(df.where("g = 'a'"), ["g"], several=True) is None
    h = groups.histogram(frame(spark, [(float(i),) for i in range(101)], "v double"), "v", 10)
    assert {r.bin: r.n for r in h.collect()} == {**{i: 10 for i in range(9)}, 9: 11}


def test_panels():
    assert (len(panels.CELL_TYPES), len(panels.S_PHASE), len(panels.G2M_PHASE), len(panels.IMMUNE_SUBTYPES), len(panels.IMMUNE_PARENTS)) == (10, 43, 54, 15, 7)
    assert [len(v) for v in panels.MICROENVIRONMENT.values()] == [2, 18, 10, 9, 13, 12]
    assert (len(panels.CHECKPOINTS), len(panels.SIGNATURES), len(panels.REGULONS), len(panels.HALLMARKS), len(panels.LIGAND_RECEPTOR)) == (10, 10, 12, 10, 18)


def test_cache(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    key = tables.cache_key(a=1, b=[2])
    assert key == tables.cache_key(b=[2], a=1) != tables.cache_key(a=2, b=[2])
    for _ in range(2):
        assert tables.cached(spark, str(tmp_path), key, make).count() == 3
    assert made == [1]


@pytest.mark.parametrize("slope", [1.0, 0.0])
def test_residual_squares_are_those_of_the_residuals(spark, slope):
    rng = np.random.default_rng(5)
    n = 25
    a = rng.normal(size=n)
    b = slope * rng.normal(size=n) + 2 * a * (slope == 0)
    x = np.maximum(0, rng.normal(size=(n, 4)) + a[:, None])
    e = frame(spark, [(i, j, float(x[i, j])) for i in range(n) for j in range(4) if x[i, j]], "cell_id long, gene_id long, value double")
    c = frame(spark, [(i, float(a[i]), float(b[i])) for i in range(n)], "cell_id long, s double, g double")
    want = {r.gene_id: r.ss for r in matrix.regress_out(e, c, ("s", "g")).groupBy("gene_id").agg(F.sum(F.col("value") * F.col("value")).alias("ss")).collect()}
    got = matrix.residual_squares(e, c, ("s", "g"))
    assert "Generate" not in got._jdf.queryExecution().toString()
    assert {r.gene_id: r.residual_ss for r in got.collect()} == pytest.approx(want, rel=1e-6)


def test_clone_stats_needs_no_profiles(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(cnv, "_smooth", lambda *_: pytest.fail("dense"))
    assert catalog.QUERIES["clone_stats"](spark, sf_dir).count() == 3


def test_clone_quantile_bins_needs_no_profiles(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(cnv, "_smooth", lambda *_: pytest.fail("dense"))
    assert catalog.QUERIES["clone_quantile_bins"](spark, sf_dir).count() == 150


def test_cnv_classify_needs_no_profiles(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(cnv, "_smooth", lambda *_: pytest.fail("dense"))
    assert catalog.QUERIES["cnv_classify"](spark, sf_dir).count() == 150


def _scores(spark, n: int):
    v = np.random.default_rng(11).integers(0, 500, n) / 977
    return frame(spark, [(i, float(x)) for i, x in enumerate(v)], "cell_id long, cnv_score double"), v


def test_classify_holds_no_scores_in_one_task(spark):
    scores, v = _scores(spark, 1001)
    got = cnv.classify(scores)
    assert "percentile" not in got._jdf.queryExecution().toString()
    assert {r.cell_id for r in got.where("cnv_class = 'Malignant'").collect()} == set(np.flatnonzero(np.round(v, 12) > np.round(np.quantile(v, 0.75), 12)).tolist())


def test_score_clones_holds_no_scores_in_one_task(spark):
    scores, v = _scores(spark, 1003)
    got = cnv.score_clones(scores)
    assert got.columns == ["cell_id", "cnv_score", "clone"] and "percentile" not in got._jdf.queryExecution().toString()
    want = np.digitize(np.round(v, 12), np.round(np.quantile(v, [0.33, 0.66]), 12)) + 1
    assert {r.cell_id: r.clone for r in got.collect()} == {i: f"Clone_{k}" for i, k in enumerate(want)}


def test_clone_stats_holds_no_pseudotimes_in_one_task(spark):
    v = np.random.default_rng(12).integers(0, 300, 400) / 7
    rows = [(f"Clone_{i % 3}", i / 10, float(x), "ab"[i % 2]) for i, x in enumerate(v)] + [("Clone_0", 1.0, x, None) for x in (None, math.nan, math.inf)] + [("Clone_9", 2.0, None, None), (None, 3.0, 4.0, "a")]
    got = cnv.clone_stats(frame(spark, rows, "clone string, cnv_score double, pt double, cell_type string"))
    assert got.columns == ["clone", "n_cells", "mean_cnv_score", "mean_pseudotime", "median_pseudotime", "dominant_cell_type", "fraction"] and "percentile" not in got._jdf.queryExecution().toString()
    s = {r.clone: r for r in got.collect()}
    assert {c: r.n_cells for c, r in s.items()} == {"Clone_0": 137, "Clone_1": 133, "Clone_2": 133, "Clone_9": 1, None: 1}
    assert [s[f"Clone_{k}"].median_pseudotime for k in range(3)] == pytest.approx([np.median(v[k::3]) for k in range(3)])
    assert s["Clone_9"].median_pseudotime is None and s[None].median_pseudotime == 4.0


def test_residual_squares_come_from_residuals(spark):
    rng = np.random.default_rng(7)
    n = 40
    a, b = rng.normal(size=n), rng.normal(size=n)
    x = rng.normal(scale=1e-3, size=(n, 6)) + 1e6 * (np.arange(6) < 5) + 1e-3 * a[:, None]  # of squares of 1e6, sums keep no digit of these
    x[rng.random((n, 6)) < np.arange(6) / 20] = 0
    e = frame(spark, [(i, j, float(x[i, j])) for i in range(n) for j in range(6) if x[i, j]] + [(n, 0, 1.0)], "cell_id long, gene_id long, value double")
    c = frame(spark, [(i, float(a[i]), float(b[i])) for i in range(n)], "cell_id long, s double, g double")
    design = np.c_[np.ones(n), a, b]
    want = ((x - design @ np.linalg.lstsq(design, x, rcond=None)[0]) ** 2).sum(axis=0)
    for block in (1 << 16, 7, 1):
        got = {r.gene_id: r.residual_ss for r in matrix.residual_squares(e, c, ("s", "g"), block).collect()}
        assert [got[j] for j in range(6)] == pytest.approx(list(want), rel=1e-5)
    assert matrix.residual_squares(e.where("false"), c, ("s", "g")).count() == 0


def test_residual_squares_of_cells_at_one_place(spark):
    rng = np.random.default_rng(8)
    n = 60
    a, b = rng.integers(0, 3, n).astype(float), rng.integers(0, 2, n).astype(float)
    x = np.where(rng.random((n, 40)) < np.arange(40) / 39, 1 + a[:, None] + rng.normal(size=(n, 40)), 0)  # from no cell of a place to all of them
    x[0, 0] = 1
    e = frame(spark, [(i, j, float(x[i, j])) for i in range(n) for j in range(40) if x[i, j]], "cell_id long, gene_id long, value double")
    c = frame(spark, [(i, float(a[i]), float(b[i])) for i in range(n)], "cell_id long, s double, g double")
    design = np.c_[np.ones(n), a, b]
    want = ((x - design @ np.linalg.lstsq(design, x, rcond=None)[0]) ** 2).sum(axis=0)
    for block in (1 << 16, 4):
        got = {r.gene_id: r.residual_ss for r in matrix.residual_squares(e, c, ("s", "g"), block).collect()}
        assert [got[j] for j in range(40)] == pytest.approx(list(want), rel=1e-9)
