"""Dependency plan, runner, command line, streaming, and a whole run over synthetic cells."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytolake.functions import panels
from cytolake.plans import dag
from cytolake.plans.cli import parse
from cytolake.plans.config import Run
from cytolake.plans.modules import REGISTRY
from cytolake.plans.runner import Engine
from cytolake.sources.files import read_text
from cytolake.streaming import events


def test_dag():
    assert len(dag.DEPENDS) == 24 == len(REGISTRY) and set(REGISTRY) == set(dag.DEPENDS)
    assert dag.closure(["evolution"]) == {"evolution", "cnv_inference", "trajectory", "clustering", "doublet_detection", "qc", "cellranger"}
    o = dag.order(["evolution", "pathway_analysis"])
    assert all(o.index(d) < o.index(m) for m in o for d in dag.DEPENDS[m])
    assert o[:3] == ["cellranger", "qc", "doublet_detection"]
    t = dag.tiers(["rna_velocity", "annotation", "trajectory", "cell_fate"])
    assert t[4] == ["rna_velocity", "trajectory", "annotation"] and t[5] == ["cell_fate"]
    with pytest.raises(ValueError, match="cyclic"):
        dag.order(["a"], {"a": ("b",), "b": ("a",)})
    with pytest.raises(KeyError):
        dag.closure(["nothing"])


def test_cli():
    cfg = parse(["--project", "p", "--output-dir", "/o", "--modules", "clustering, annotation", "--min-genes", "5", "--batch-method", "bbknn", "--keep-doublets", "--parallel-workers", "3"])
    assert (cfg.modules, cfg.qc.min_genes, cfg.batch.method, cfg.doublet.remove, cfg.workers) == (["clustering", "annotation"], 5, "bbknn", False, 3)
    assert parse(["--project", "p", "--output-dir", "/o"]).modules == ["clustering", "differential_expression", "annotation", "trajectory", "pseudo_velocity"]
    for bad in (["--modules", "clusterin"], ["--min-genes", "9000"], ["--max-mito-pct", "101"], ["--resolution", "0"], ["--parallel-workers", "0"]):
        with pytest.raises(SystemExit):
            parse(["--project", "p", "--output-dir", "/o", *bad])


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Three kinds of cells with marker genes, two samples, positions, reads' layers and mutations."""
    rng = np.random.default_rng(0)
    top = tmp_path_factory.mktemp("cells")
    every = [panels.CELL_TYPES, panels.IMMUNE_SUBTYPES, panels.MICROENVIRONMENT, panels.SIGNATURES, panels.REGULONS, panels.HALLMARKS, panels.IMMUNE_STATES]
    names = dict.fromkeys(g for p in every for v in p.values() for g in v)
    names |= dict.fromkeys([*panels.S_PHASE, *panels.G2M_PHASE, *(g for p in panels.LIGAND_RECEPTOR for g in p), *panels.CHECKPOINTS.values(), "MT-CO1", "RPS6", "HBA1"])
    genes = [(i, g, str(1 + i % 5), i * 100) for i, g in enumerate(names)]
    kinds = ["T cell", "Fibroblast", "Tumor epithelial"]
    n, at = 150, {g: i for i, g, _, _ in genes}
    rate = np.full((3, len(genes)), 0.35)
    for k, kind in enumerate(kinds):
        rate[k, [at[g] for g in panels.CELL_TYPES[kind]]] = 9
        rate[k, rng.choice(len(genes), 30, replace=False)] += 4
    lab = np.arange(n) % 3
    x = rng.poisson(rate[lab])
    spark.createDataFrame([(i, f"B{i}", f"s{i % 4}", "case" if i % 4 < 2 else "control") for i in range(n)], "cell_id long, barcode string, sample string, condition string").write.parquet(f"{top}/cells")
    spark.createDataFrame(genes, "gene_id long, symbol string, chromosome string, start long").write.parquet(f"{top}/genes")
    stored = [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)]
    spark.createDataFrame(stored, "cell_id long, gene_id long, value double").write.parquet(f"{top}/expr")
    layers = [(i, j, int(v), int(rng.poisson(v * 0.6 + 0.3))) for i, j, v in stored if j < 60]
    spark.createDataFrame(layers, "cell_id long, gene_id long, spliced long, unspliced long").write.parquet(f"{top}/layers")
    spark.createDataFrame([("TP53", f"p{i % 7}", "Missense" if i % 3 else None) for i in range(20)], "gene string, sample_id string, mutation_type string").write.parquet(f"{top}/mutations")
    return str(top), lab


def config(top, out, **more) -> Run:
    cfg = Run("lung", str(out), modules=list(dag.DEPENDS), workers=1, **more)
    cfg.ingest.source = top
    cfg.qc.min_genes, cfg.qc.min_counts, cfg.qc.max_mito_pct = 10, 20, 60.0
    cfg.clustering.n_top_genes, cfg.clustering.n_pcs, cfg.clustering.n_neighbors, cfg.clustering.resolution = 120, 8, 10, 0.4
    cfg.doublet.remove = False
    cfg.velocity.layers, cfg.velocity.min_shared_counts = f"{top}/layers", 5
    cfg.mutations.table, cfg.mutations.genes = f"{top}/mutations", ["TP53", "KRAS"]
    cfg.regress_cell_cycle = True
    return cfg


@pytest.fixture(scope="module")
def ran(spark, data, tmp_path_factory):
    out = tmp_path_factory.mktemp("run")
    return Engine(spark, config(data[0], out)).run(), out


def test_whole_run(spark, ran, data):
    ctx, _ = ran
    assert [s for s in ctx.status if not s["ok"]] == []
    assert {s["module"] for s in ctx.status} == set(dag.DEPENDS)
    body = json.loads(read_text(spark, f"{ctx.run_dir}/run_manifest.json"))
    assert {"project", "generated_at", "run_dir", "optional_modules", "module_status", "metadata"} == set(body)
    m = body["metadata"]
    keys = "raw_cells raw_genes cells_after_qc genes_after_qc qc_removed_cells doublets_detected doublet_rate_pct n_clusters pca_cumulative_var_90pct de_significant_genes annotation_unknown_pct cell_cycle_phases pseudotime_mean pseudo_velocity_mean_speed velocity_mean_confidence cnv_mean_score cnv_malignant_cells n_clones clone_sizes grn_top_tfs gene_signatures_scored immune_subtypes_detected n_metacells pathway_top_terms pseudobulk_de_status n_terminal_states tme_mean_cyt composition_n_groups cbioportal_validation cc_top_interactions batch_method module_runtime_sec pipeline_wall_seconds"
    assert set(keys.split()) <= set(m)
    assert m["raw_cells"] == 150 and m["pseudobulk_de_status"] == "completed"


def test_run_finds_the_kinds(ran, data):
    ctx, _ = ran
    kinds = np.array(["T cell", "Fibroblast", "Tumor epithelial"])[data[1]]
    got = {r.cell_id: r.cell_type for r in ctx["cell_types"].collect()}
    assert np.mean([got[i] == kinds[i] for i in got]) > 0.9
    top = {r.symbol for r in ctx["marker_genes"].collect()}
    assert top & set(panels.CELL_TYPES["T cell"]) and top & set(panels.CELL_TYPES["Fibroblast"])
    s = ctx["fate_probabilities"].groupBy("id").agg(F.sum("probability").alias("p"))
    assert all(abs(r.p - 1) < 1e-9 or r.p == 0 for r in s.collect())
    mut = {r.gene: r for r in ctx["mutation_summary"].collect()}
    assert mut["TP53"].mutated_samples == 7 and mut["KRAS"].error == "gene not found"
    assert ctx["composition_proportions"].groupBy("grp").agg(F.sum("proportion").alias("p")).where("abs(p - 1) > 1e-9").count() == 0
    assert {"cell_type", "pval", "padj", "significant"} <= set(ctx["composition_tests"].columns)


def test_resume(spark, ran, data):
    ctx, out = ran
    cfg = config(data[0], out, resume_from="composition")
    cfg.modules = ["composition"]
    again = Engine(spark, cfg).run()
    assert [s["message"] for s in again.status if s["module"] == "clustering"] == ["resumed"]
    assert [s["message"] for s in again.status if s["module"] == "composition"] == ["completed"]
    assert again.metadata["n_clusters"] == ctx.metadata["n_clusters"]
    other = config(data[0], out, resume_from="clustering", run_id="new")
    with pytest.raises(ValueError, match="resume"):
        Engine(spark, other).run()


def test_failures(spark, tmp_path):
    def ok(ctx):
        ctx.put("a", "t", spark.range(3))

    def bad(ctx):
        raise RuntimeError("no")

    registry = {"a": ok, "b": bad, "c": ok, "d": lambda ctx: ctx.note(d=ctx["t"].count())}
    depends = {"a": (), "b": ("a",), "c": ("b",), "d": ("a",)}
    cfg = Run("p", str(tmp_path), modules=["b", "c", "d"], workers=2)
    e = Engine(spark, cfg, registry, depends)
    e.mandatory = ["a"]
    ctx = e.run()
    state = {s["module"]: s["ok"] for s in ctx.status}
    assert state == {"a": True, "b": False, "c": False, "d": True} and ctx.metadata["d"] == 3
    e = Engine(spark, cfg, registry, depends)
    e.mandatory = ["b"]
    with pytest.raises(RuntimeError):
        e.run()
    with pytest.raises(ValueError):
        Engine(spark, Run("p", str(tmp_path), workers=0))


def test_streaming(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    batch.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    batch.coalesce(1).write.parquet(f"{tmp_path}/one")
    part = next((tmp_path / "one").glob("part-*.parquet"))
    (tmp_path / "alone").mkdir()
    part.rename(tmp_path / "alone" / "events.parquet")
    for name, make, at in (("counts", events.window_counts, tmp_path), ("counts", events.window_counts, tmp_path / "alone"), ("sess", events.sessions, tmp_path)):
        q = make(events.read_events(spark, str(at))).writeStream.format("memory").queryName(name).outputMode("complete" if name == "counts" else "append").trigger(availableNow=True).start()
        q.awaitTermination(120)
        if name == "counts":
            assert spark.table("counts").agg(F.sum("n")).first()[0] == batch.count()
    got = {(r.start, r.event_type): r.n for r in spark.table("counts").collect()}
    want = batch.withColumn("at", F.col("ts").cast("timestamp")).groupBy(F.window("at", "1 hour").alias("w"), "event_type").count()
    assert got == {(r.w.start, r.event_type): r["count"] for r in want.collect()}
