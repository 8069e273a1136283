"""Tables behind figures, comparison tables and perturbations."""

from __future__ import annotations

import math

import numpy as np
import pytest

from cytolake.operators import views


def test_comparison(spark):
    rng = np.random.default_rng(0)
    rows = [(g, float(v)) for g, shift in (("a", 0), ("b", 0.2), ("c", 3)) for v in rng.normal(size=15) + shift]
    got = views.comparison(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()
    by = {r.cluster: r for r in got}
    assert by["c"].star == "***" and by[None].comparison == "kruskal" and by[None].p_value < 0.001
    assert set(by) == {None, "b", "c"} and all(r.q_value >= r.p_value - 1e-15 for r in got)


def test_perturbations(spark):
    e = spark.createDataFrame([(i, j, float("nan") if i == j else 1.0) for i in range(60) for j in range(50)], "cell_id long, gene_id long, value double")
    assert 200 < views.dropout(e).count() < 400
    assert views.without_nan(e).count() == 60 * 50 - 50
    kept = lambda df: sorted((r.cell_id, r.gene_id) for r in views.dropout(df, 0.5).collect())
    assert kept(e) == kept(e.repartition(7))
    c = e.select("cell_id").distinct()
    assert views.subsample(c, 8).count() == 8


def test_small_tables(spark):
    a = spark.createDataFrame([(1, 5.0)], "cell_id long, n double")
    assert sorted(r.stage for r in views.qc_stages(a, a).collect()) == ["after", "before"]
    lay = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, 1.0)], "id long, x double, y double")
    v = spark.createDataFrame([(1, "T")], "id long, kind string")
    assert [(r.id, r.value) for r in views.scatter(lay, v, "kind").orderBy("id").collect()] == [(1, "T"), (2, None)]
    long = spark.createDataFrame([("c", "t", 1.0), ("c", "u", 2.0), ("d", "t", 3.0)], "c string, t string, v double")
    assert sorted(tuple(r) for r in views.heatmap(long, "c", "t", "v", ["t", "u"]).collect()) == [("c", 1.0, 2.0), ("d", 3.0, None)]
    prof = spark.createDataFrame([("a", 1, 0.5, 10.0), ("a", 2, 0.1, 5.0)], "l string, gene_id long, mean double, pct double")
    assert [r.gene_id for r in views.dot_plot(prof, prof.where("gene_id = 1"), "l").collect()] == [1]
    layer = spark.createDataFrame([(1, "A", 2.0), (1, "Z", 1.0)], "cell_id long, symbol string, value double")
    genes = spark.createDataFrame([(7, "A"), (8, "B")], "gene_id long, symbol string")
    assert [tuple(r) for r in views.project_layer(layer, genes).collect()] == [(1, 7, 2.0)]


def test_driver_statistics():
    m, lo, hi = views.confidence95([1.0, 2.0, 3.0, 4.0])
    assert m == 2.5 and hi - m == pytest.approx(3.182446305284263 * math.sqrt(5 / 3) / 2, rel=1e-9) and m - lo == pytest.approx(hi - m)
    t, p = views.one_sample_t([1.0, 2.0, 3.0, 4.0], 2.0)
    assert t == pytest.approx(0.7745966692) and p == pytest.approx(0.4950253, abs=1e-6)
    w, p = views.signed_rank([1, 2, 3, 4, 5, 6], [0, 0, 0, 0, 0, 0])
    assert (w, p) == (0.0, pytest.approx(2 / 64))
    w, p = views.signed_rank([1.0] * 30, [0.0] * 30)
    assert w == 0 and p < 1e-6
    assert views.signed_rank([1, 2], [1, 2]) == (0.0, 1.0)
