"""The modules of a run. Each reads tables of the context and puts its own; errors in optional ones are recorded by the runner."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.functions import panels
from cytolake.functions.numeric import cyt, finite
from cytolake.operators import cnv, embedding, groups, matrix, neighbors, ranking, reads, scoring
from cytolake.plans.runner import Context
from cytolake.sources import bam, gtf
from cytolake.sources.tables import read_any

REGISTRY: dict[str, Callable[[Context], None]] = {}


def module(f: Callable[[Context], None]) -> Callable[[Context], None]:
    REGISTRY[f.__name__] = f
    return f


def _need(ctx: Context, *names: str) -> list[DataFrame]:
    return [ctx[n] for n in names]


def _sets(ctx: Context, sets: dict[str, list[str]], least: int) -> tuple[DataFrame, list[str]]:
    """The available sets, and their names in the order given."""
    have = scoring.available(scoring.sets_frame(ctx.spark, sets), ctx["genes"], least)
    names = set(scoring.set_names(have))
    return have, [n for n in sets if n in names]


def _scored(ctx: Context, sets: dict[str, list[str]], least: int = 2, controls: int = 50) -> tuple[DataFrame, list[str]]:
    have, names = _sets(ctx, sets, least)
    if not names:
        raise ValueError("none of the gene sets is in the data")
    return scoring.score_sets(ctx["lognorm"], have, ctx["genes"], ctx["cells"], names, controls=controls), names


def _per_cluster(ctx: Context, scores: DataFrame) -> DataFrame:
    return scores.join(ctx["clusters"], "cell_id").groupBy("cluster", "set_name").agg(F.avg("score").alias("score"))


@module
def cellranger(ctx: Context) -> None:
    cells, genes, expr = read_any(ctx.spark, ctx.cfg.ingest.source)
    if "sample" not in cells.columns:
        cells = cells.withColumn("sample", F.lit(ctx.cfg.ingest.sample))
    ctx.put("cellranger", "raw_genes", genes)
    ctx.put("cellranger", "raw_cells", cells)
    ctx.put("cellranger", "raw_expr", expr)
    ctx.note(raw_cells=ctx["raw_cells"].count(), raw_genes=ctx["raw_genes"].count(), cellranger_outs=ctx.cfg.ingest.source)


@module
def qc(ctx: Context) -> None:
    cells, genes, expr = _need(ctx, "raw_cells", "raw_genes", "raw_expr")
    q = ctx.cfg.qc
    metrics = ctx.put("qc", "qc_metrics", matrix.qc_metrics(expr, matrix.gene_flags(genes), ["mt", "ribo", "hb"]))
    if q.preset == "standard":
        ok = matrix.standard_pass("pct_counts_mt")
    else:
        ok = matrix.qc_pass(matrix.QCLimits(q.min_genes, q.max_genes, q.min_counts, q.max_counts, q.max_mito_pct, q.max_ribo_pct), "pct_counts_mt", "pct_counts_ribo")
    kept = ctx.put("qc", "cells", cells.join(metrics.where(ok), "cell_id"))
    sub = expr.join(kept.select("cell_id"), "cell_id", "left_semi")
    good = matrix.filter_genes(sub, q.min_cells)
    ctx.put("qc", "genes", genes.join(good.select("gene_id"), "gene_id", "left_semi"))
    ctx.put("qc", "expr", sub.join(good.select("gene_id"), "gene_id", "left_semi"))
    n = kept.count()
    ctx.note(cells_after_qc=n, genes_after_qc=ctx["genes"].count(), qc_removed_cells=cells.count() - n)


def _top_genes(expr: DataFrame, cells: DataFrame, n: int) -> list[int]:
    return [r.gene_id for r in matrix.highly_variable(expr, matrix.count_cells(cells), n).select("gene_id").collect()]


@module
def doublet_detection(ctx: Context) -> None:
    cells, expr = _need(ctx, "cells", "expr")
    n = cells.count()
    genes = _top_genes(matrix.normalize(expr), cells, 200) if n >= 20 else []
    scores = ctx.put("doublet_detection", "doublets", embedding.doublet_scores(expr, cells, genes, ctx.cfg.doublet.expected_rate, components=min(30, max(2, min(n, len(genes) or 2) - 1))))
    found = scores.where("predicted").count()
    ctx.note(doublet_method="simulated neighbours" if len(genes) >= 50 else "too small, all singlets", doublets_detected=found, doublet_rate_pct=round(100 * found / n, 2) if n else 0.0)
    if ctx.cfg.doublet.remove:
        one = ctx.put("doublet_detection", "cells", cells.join(scores.where("predicted").select("cell_id"), "cell_id", "left_anti"))
        ctx.put("doublet_detection", "expr", expr.join(one.select("cell_id"), "cell_id", "left_semi"))
        ctx.note(doublets_removed=found, cells_after_doublet_removal=n - found)


def _graph(ctx: Context, owner: str, vectors: DataFrame, k: int) -> None:
    n = vectors.count()
    c = ctx.cfg.clustering
    find = {"exact": neighbors.knn_blocks, "cells": neighbors.knn_cells}[c.neighbors]
    near = ctx.put(owner, "knn", find(vectors, max(1, min(k, n) - 1)))
    graph = ctx.put(owner, "graph", neighbors.connectivities(near))
    start = vectors.select("id", F.col("vec")[0].alias("x"), F.coalesce(F.get("vec", F.lit(1)), F.lit(0.0)).alias("y"))
    ctx.put(owner, "layout", neighbors.graph_layout(graph, start) if c.layout == "graph" else start)


@module
def clustering(ctx: Context) -> None:
    c = ctx.cfg.clustering
    cells, expr = _need(ctx, "cells", "expr")
    lognorm = ctx.put("clustering", "lognorm", matrix.normalize(expr, c.target_sum))
    genes = _top_genes(lognorm, cells, c.n_top_genes)
    ctx.put("clustering", "variable_genes", ctx["genes"].where(F.col("gene_id").isin(genes)).select("gene_id"))
    x = matrix.scale(lognorm, matrix.gene_moments(lognorm, matrix.count_cells(cells))) if c.scale else lognorm
    k = max(1, min(c.n_pcs, len(genes), cells.count() - 1))
    scores, ratios = embedding.pca(embedding.dense(x, cells, genes), k)
    vectors = ctx.put("clustering", "pca", scores)
    total, enough = embedding.explained(ratios)
    ctx.put("clustering", "pca_variance", ctx.spark.createDataFrame([(i + 1, float(r), float(t)) for i, (r, t) in enumerate(zip(ratios, total, strict=True))], "pc int, ratio double, cumulative double"))
    _graph(ctx, "clustering", vectors, c.n_neighbors)
    lab = embedding.communities(ctx["graph"], c.resolution)
    lab = ctx.put("clustering", "clusters", lab.select(F.col("id").alias("cell_id"), "cluster"))
    ctx.note(n_clusters=lab.select("cluster").distinct().count(), clustering_backend="spark", pca_cumulative_var_90pct=enough)


@module
def batch_correction(ctx: Context) -> None:
    key, method = ctx.cfg.batch.key, ctx.cfg.batch.method
    cells = ctx["cells"]
    if key not in cells.columns:
        ctx.note(batch_correction_status=f"skipped: no column {key}")
        return
    n = cells.select(key).distinct().count()
    if n < 2:
        ctx.note(batch_correction_status="skipped: one batch")
        return
    vectors = ctx["pca"].join(cells.select(F.col("cell_id").alias("id"), F.col(key).cast("string").alias("batch")), "id")
    k = ctx.cfg.clustering.n_neighbors
    if method == "harmony":
        _graph(ctx, "batch_correction", ctx.put("batch_correction", "pca", embedding.harmony(vectors, "batch")), k)
    elif method == "bbknn":
        near = ctx.put("batch_correction", "knn", neighbors.knn_by_batch(vectors, "batch", max(1, k // n)).drop("batch"))
        ctx.put("batch_correction", "graph", neighbors.connectivities(near))
    elif method == "combat":
        lognorm = ctx.put("batch_correction", "lognorm_combat", embedding.combat(ctx["lognorm"], cells, key))
        genes = [r.gene_id for r in ctx["variable_genes"].collect()]
        scores, _ = embedding.pca(embedding.dense(lognorm, cells, genes), max(1, min(ctx.cfg.clustering.n_pcs, len(genes))))
        _graph(ctx, "batch_correction", ctx.put("batch_correction", "pca", scores), k)
    elif method == "mutual":
        _graph(ctx, "batch_correction", ctx.put("batch_correction", "pca", neighbors.align_batches(vectors, "batch")), k)
    else:
        raise ValueError(f"unknown batch method {method}; known: harmony, bbknn, combat, mutual")
    lab = embedding.communities(ctx["graph"], ctx.cfg.clustering.resolution)
    lab = ctx.put("batch_correction", "clusters", lab.select(F.col("id").alias("cell_id"), "cluster"))
    ctx.note(batch_correction_status="completed", batch_method=method, n_batches=n, n_clusters_after_batch=lab.select("cluster").distinct().count())


@module
def differential_expression(ctx: Context) -> None:
    cfg = ctx.cfg
    labels = ctx["clusters"].withColumnRenamed("cluster", "grp")
    if cfg.de_method == "wilcoxon":
        tests = ranking.wilcoxon(ctx["lognorm"], labels, "grp")
    elif cfg.de_method in ("t-test", "t-test_overestim_var"):
        t = ranking.ttest_p(ranking.ttest(ctx["lognorm"], labels, "grp", cfg.de_method.endswith("var")))
        fold = ranking.wilcoxon(ctx["lognorm"], labels, "grp").select("gene_id", "grp", "lfc", "pct", "pct_rest")
        tests = t.join(fold, ["gene_id", "grp"])
    elif cfg.de_method == "logreg":  # no p values: nothing counts as significant
        genes = [r.gene_id for r in ctx["variable_genes"].collect()]
        score = embedding.logistic_ranking(embedding.dense(ctx["lognorm"], ctx["cells"], genes), labels.withColumnRenamed("cell_id", "id"), genes)
        fold = ranking.wilcoxon(ctx["lognorm"], labels, "grp").select("gene_id", "grp", "lfc", "pct", "pct_rest")
        tests = score.join(fold, ["gene_id", "grp"]).withColumn("pval", F.lit(1.0))
    else:
        raise ValueError(f"unknown method {cfg.de_method}; known: wilcoxon, t-test, t-test_overestim_var, logreg")
    named = ranking.rank_genes(tests, "grp", cfg.de_n_genes).join(ctx["genes"].select("gene_id", "symbol"), "gene_id")
    ranked = ctx.put("differential_expression", "marker_genes_all", named)
    found = ctx.put("differential_expression", "marker_genes", ranking.significant(ranked, cfg.de_alpha, cfg.de_lfc))
    ctx.put("differential_expression", "marker_top5", groups.top_k(found.drop("rank"), ["grp"], [F.asc("padj"), F.desc("score"), F.asc("gene_id")], 5))
    ctx.note(de_significant_genes=found.count(), de_method=cfg.de_method, de_n_genes=cfg.de_n_genes)


@module
def annotation(ctx: Context) -> None:
    scores, names = _scored(ctx, ctx.cfg.markers or panels.CELL_TYPES, 1)
    ctx.put("annotation", "annotation_scores", scores)
    got = ctx.put("annotation", "cell_types", scoring.annotate(ctx["annotation_scores"], names, ctx.cfg.annotation_threshold))
    ctx.put("annotation", "cluster_cell_types", groups.majority(got.join(ctx["clusters"], "cell_id"), "cluster", "cell_type"))
    n = got.count()
    ctx.note(annotation_unknown_pct=round(100 * got.where("cell_type = 'Unknown'").count() / n, 2) if n else 0.0)


@module
def cell_cycle(ctx: Context) -> None:
    sets = {"S": panels.S_PHASE, "G2M": panels.G2M_PHASE}
    _, names = _sets(ctx, sets, 1)
    if len(names) < 2:
        raise ValueError("the S or the G2M panel is not in the data")
    scores, _ = _scored(ctx, sets, 1, controls=min(len(panels.S_PHASE), len(panels.G2M_PHASE)))
    got = ctx.put("cell_cycle", "cell_cycle", scoring.phase(scores, "S", "G2M"))
    if ctx.cfg.regress_cell_cycle:
        ctx.put("cell_cycle", "lognorm_regressed", matrix.regress_out(ctx["lognorm"], got, ("s_score", "g2m_score")))
    ctx.note(cell_cycle_phases={r.phase: r["count"] for r in got.groupBy("phase").count().collect()})


@module
def trajectory(ctx: Context) -> None:
    maps, eigen = embedding.diffusion_map(ctx["graph"], min(10, max(2, ctx["cells"].count() - 1)))
    cells = maps.join(ctx["clusters"].withColumnRenamed("cell_id", "id"), "id")
    first = F.get("vec", F.lit(0))
    if ctx.cfg.root_cluster is not None:
        root = cells.where(F.col("cluster") == ctx.cfg.root_cluster).agg(F.min_by("id", F.abs(first))).first()[0]
    else:
        root = cells.agg(F.min_by("id", first)).first()[0]
    if root is None:
        raise ValueError(f"no cell is in cluster {ctx.cfg.root_cluster}")
    got = ctx.put("trajectory", "pseudotime", embedding.diffusion_pseudotime(maps, eigen, root).select(F.col("id").alias("cell_id"), "pt"))
    ctx.put("trajectory", "pseudotime_per_cluster", groups.stats(got.join(ctx["clusters"], "cell_id"), "cluster", "pt"))
    cor = ranking.pearson_with_cells(ctx["lognorm"], got.where(finite(F.col("pt"))), "pt")
    top = cor.orderBy(F.desc("variance"), "gene_id").limit(3000).orderBy(F.desc(F.abs("corr")), "gene_id").limit(30)
    ctx.put("trajectory", "pseudotime_top_genes", top.join(ctx["genes"].select("gene_id", "symbol"), "gene_id"))
    ctx.put("trajectory", "cluster_graph", neighbors.cluster_graph(ctx["graph"], ctx["clusters"].select(F.col("cell_id").alias("id"), F.col("cluster").alias("label"))))
    ctx.note(pseudotime_mean=got.agg(F.avg("pt")).first()[0], root_cell=root)


@module
def pseudo_velocity(ctx: Context) -> None:
    p = ctx["layout"].join(ctx["pseudotime"].withColumnRenamed("cell_id", "id"), "id").where(finite(F.col("pt")))
    n = p.count()
    if n < 50:
        raise ValueError(f"only {n} cells have a finite pseudotime; 50 are needed")
    v = ctx.put("pseudo_velocity", "pseudo_velocity", neighbors.pseudo_velocity(p))
    ctx.put("pseudo_velocity", "pseudo_velocity_per_cluster", groups.stats(v.join(ctx["clusters"].withColumnRenamed("cell_id", "id"), "id"), "cluster", "speed"))
    ctx.put("pseudo_velocity", "velocity_grid", neighbors.interpolate_grid(p, v))
    ctx.put("pseudo_velocity", "arrow_scale", neighbors.arrow_scale(p, v))
    ctx.note(pseudo_velocity_mean_speed=v.agg(F.avg("speed")).first()[0])


@module
def rna_velocity(ctx: Context) -> None:
    v = ctx.cfg.velocity
    if v.layers:
        layers = ctx.spark.read.parquet(v.layers)
    elif v.reads:
        path = gtf.resolve_path(v.gtf, v.reference_dir)
        if path is None:
            raise FileNotFoundError("reads need a gene annotation: give its path, or a reference folder that holds genes/genes.gtf[.gz]")
        exons = gtf.read_exons(ctx.spark, str(path))
        who = ctx["cells"].select("cell_id", "barcode")
        table = bam.read_bam(ctx.spark, [v.reads]) if v.reads.endswith(".bam") else ctx.spark.read.parquet(v.reads)
        r = table.join(who.withColumnRenamed("barcode", "cb"), "cb").withColumn("cb", F.col("cell_id"))
        got = reads.classify_reads(r, exons)
        sym = ctx["genes"].select(F.col("symbol").alias("gn"), "gene_id")
        layers = reads.layer_counts(got.join(sym, "gn").withColumn("gn", F.col("gene_id")))
    else:
        raise ValueError("velocity needs a table of layers, or of aligned reads and a gene annotation")
    layers = reads.shared_genes(reads.merge_layers(ctx["expr"], layers), v.min_shared_counts)
    edges = ctx["graph"]
    m = ctx.put("rna_velocity", "moments", reads.moments(reads.size_normalised(layers), edges))
    vel = ctx.put("rna_velocity", "velocity", reads.velocity(m))
    ctx.put("rna_velocity", "velocity_graph", reads.velocity_graph(vel, edges))
    n = vel.select("gene_id").distinct().count()
    conf = ctx.put("rna_velocity", "velocity_confidence", reads.transfer(reads.velocity_length(vel), reads.velocity_confidence(vel, edges, n), ["velocity_confidence"]))
    labels = ctx["clusters"].withColumnRenamed("cluster", "grp")
    tests = ranking.ttest(vel.select("cell_id", "gene_id", F.col("v").alias("value")), labels, "grp")
    ctx.put("rna_velocity", "velocity_top_genes", groups.top_k(tests, ["grp"], [F.desc("score"), F.asc("gene_id")], 10))
    ctx.note(velocity_mean_confidence=conf.agg(F.avg("velocity_confidence")).first()[0], velocity_mode="steady state")


@module
def cnv_inference(ctx: Context) -> None:
    c = ctx.cfg.cnv
    if "chromosome" not in ctx["genes"].columns:
        raise ValueError("copy numbers need chromosome and start columns of the genes")
    known = ctx["genes"].where(F.regexp_replace(F.col("chromosome").cast("string"), "^chr", "").isin(panels.CHROMOSOMES) & F.col("symbol").isNotNull())
    cells = ctx["cells"].select("cell_id")
    if "cell_types" in ctx:
        cells = cells.join(ctx["cell_types"].select("cell_id", "cell_type"), "cell_id", "left")
    got = cnv.window_cnv(ctx["lognorm"], cells, known, c.window_size, c.reference_group)
    got = ctx.put("cnv_inference", "cnv", cnv.classify(ctx.put("cnv_inference", "cnv_profiles", got).drop("profile"), c.percentile))
    ctx.note(cnv_mean_score=got.agg(F.avg("cnv_score")).first()[0], cnv_malignant_cells=got.where("cnv_class = 'Malignant'").count())


@module
def pathway_analysis(ctx: Context) -> None:
    sets = scoring.sets_frame(ctx.spark, panels.HALLMARKS)
    top = groups.top_k(ctx["marker_genes"].drop("rank"), ["grp"], [F.desc("score"), F.asc("gene_id")], 100).select("grp", F.col("symbol").alias("gene"))
    got = ranking.enrichment(top, sets, ctx["genes"].select(F.col("symbol").alias("gene")), "grp")
    got = ctx.put("pathway_analysis", "pathway_enrichment", got.withColumnRenamed("grp", "cluster"))
    have, names = _sets(ctx, panels.HALLMARKS, 2)
    if names:
        w = have.select(F.col("set_name").alias("regulator"), "gene_id", F.lit(1.0).alias("weight"))
        act = scoring.linear_activity(ctx["lognorm"], w, names, ctx["genes"].count())
        ctx.put("pathway_analysis", "pathway_activity", act.join(ctx["clusters"], "cell_id").groupBy("cluster", F.col("regulator").alias("pathway")).agg(F.avg("activity").alias("activity")))
    best = groups.keep_first(got, ["term"], [F.asc("padj"), F.asc("cluster")]).orderBy("padj", "term").limit(15)
    ctx.note(pathway_top_terms=[r.term for r in best.collect()])


@module
def cell_communication(ctx: Context) -> None:
    pairs = ctx.spark.createDataFrame(panels.LIGAND_RECEPTOR, "ligand string, receptor string")
    names = sorted({g for p in panels.LIGAND_RECEPTOR for g in p})
    some = ctx["genes"].where(F.col("symbol").isin(names)).select("gene_id", F.col("symbol").alias("gene"))
    x = ctx["lognorm"].join(some.select("gene_id"), "gene_id", "left_semi")
    means = groups.mean_by_label(x, ctx["cell_types"].select("cell_id", "cell_type"), "cell_type", 5).join(some, "gene_id")
    got = ctx.put("cell_communication", "ligand_receptor", scoring.ligand_receptor(means, pairs, "cell_type"))
    ctx.put("cell_communication", "ligand_receptor_consensus", scoring.consensus_rank(got))
    top = got.orderBy(F.desc("lr_score"), "ligand", "receptor", "source", "target").limit(10).collect()
    ctx.note(cc_top_interactions=[f"{r.ligand}-{r.receptor}: {r.source} → {r.target}" for r in top])


@module
def gene_regulatory_network(ctx: Context) -> None:
    scores, _ = _scored(ctx, panels.REGULONS, 2)
    got = ctx.put("gene_regulatory_network", "tf_activity_per_cluster", _per_cluster(ctx, scores).withColumnRenamed("set_name", "tf"))
    top = ctx.put("gene_regulatory_network", "tf_top_per_cluster", groups.top_k(got, ["cluster"], [F.desc("score"), F.asc("tf")], 5))
    best: dict[str, dict[str, float]] = {}
    for r in top.orderBy("cluster", "rank").collect():
        best.setdefault(r.cluster, {})[r.tf] = round(r.score, 6)
    ctx.note(grn_top_tfs=best)


@module
def validate_cbioportal(ctx: Context) -> None:
    m = ctx.cfg.mutations
    if not m.table:
        raise ValueError("there is no network here: give a table of mutations (gene, sample_id, mutation_type)")
    first = ctx.spark.createDataFrame([(g, i) for i, g in enumerate(m.genes)], "gene string, ord long")
    lists = first
    if m.use_de_genes:
        top = ctx["marker_genes"].groupBy(F.col("symbol").alias("gene")).agg(F.max("score").alias("s")).orderBy(F.desc("s"), "gene").limit(m.top_n)
        names = [r.gene for r in top.collect()]
        lists = groups.merge_lists(first, ctx.spark.createDataFrame([(g, i) for i, g in enumerate(names)], "gene string, ord long"), "gene")
    rows = ctx.spark.read.parquet(m.table)
    total = rows.agg(F.countDistinct("sample_id").alias("total_samples"))
    got = groups.mutation_summary(rows.join(lists, "gene", "left_semi"), "gene", "sample_id", "mutation_type", total)
    empty = lists.select("gene").join(got, "gene", "left").withColumn("study_id", F.lit(m.study)).withColumn("error", F.when(F.col("mutated_samples").isNull(), "gene not found"))
    got = ctx.put("validate_cbioportal", "mutation_summary", empty)
    ctx.note(cbioportal_validation={"study": m.study, "genes": got.count(), "found": got.where("error is null").count()})


@module
def immune_phenotyping(ctx: Context) -> None:
    scores, names = _scored(ctx, panels.IMMUNE_SUBTYPES, 2)
    ann = scoring.annotate(scores, names, float("-inf"))
    got = ctx.put("immune_phenotyping", "immune_subtypes", scoring.immune_subtypes(ann, ctx["cell_types"], panels.IMMUNE_PARENTS))
    states, _ = _sets(ctx, panels.IMMUNE_STATES, 2)
    if states.limit(1).count():
        ctx.put("immune_phenotyping", "immune_states", _scored(ctx, panels.IMMUNE_STATES, 2)[0])
    ctx.put("immune_phenotyping", "immune_summary", groups.counts(got.where("immune_subtype <> 'Non-immune'").join(ctx["clusters"], "cell_id"), "cluster", "immune_subtype"))
    ctx.note(immune_subtypes_detected={r.immune_subtype: r["count"] for r in got.groupBy("immune_subtype").count().collect()})


def _gene_values(ctx: Context, symbols: list[str]) -> DataFrame:
    """Log-normalised values of single genes, one column each, absent values 0."""
    some = ctx["genes"].where(F.col("symbol").isin(symbols)).select("gene_id", "symbol")
    x = ctx["lognorm"].join(some, "gene_id").groupBy("cell_id").pivot("symbol", symbols).agg(F.sum("value"))
    return ctx["cells"].select("cell_id").join(x, "cell_id", "left").na.fill(0.0)


@module
def tumor_microenvironment(ctx: Context) -> None:
    scores, names = _scored(ctx, panels.MICROENVIRONMENT, 2)
    ctx.put("tumor_microenvironment", "tme_scores", scores)
    ctx.put("tumor_microenvironment", "tme_per_cluster", _per_cluster(ctx, ctx["tme_scores"]))
    c = ctx.put("tumor_microenvironment", "cytolytic", _gene_values(ctx, ["GZMA", "PRF1"]).select("cell_id", cyt(F.col("GZMA"), F.col("PRF1")).alias("cyt_score")))
    label = ctx.spark.createDataFrame([(k, g) for k, g in panels.CHECKPOINTS.items()], "checkpoint string, symbol string")
    some = ctx["genes"].join(label, "symbol").select("gene_id", "checkpoint")
    x = ctx["lognorm"].join(some.select("gene_id"), "gene_id", "left_semi")
    prof = groups.mean_by_label(x, ctx["cell_types"].select("cell_id", "cell_type"), "cell_type", 3).join(some, "gene_id")
    ctx.put("tumor_microenvironment", "checkpoint_expression", prof.select("cell_type", "n_cells", "checkpoint", F.bround("mean", 4).alias("mean"), F.bround("pct", 2).alias("pct")))
    ctx.note(tme_signatures_scored=names, tme_mean_cyt=c.agg(F.avg("cyt_score")).first()[0])


@module
def gene_signature_scoring(ctx: Context) -> None:
    sets = (panels.SIGNATURES if ctx.cfg.builtin_signatures else {}) | ctx.cfg.signatures
    scores, names = _scored(ctx, sets, 2)
    scores = ctx.put("gene_signature_scoring", "signature_scores", scores)
    ctx.put("gene_signature_scoring", "signature_per_cluster", _per_cluster(ctx, scores))
    ctx.put("gene_signature_scoring", "signature_correlation", ranking.correlation_matrix(scoring.wide_scores(scores, names), [f"`{n}`" for n in names]))
    top = scores.groupBy("set_name").agg(F.var_samp("score").alias("v")).orderBy(F.desc("v"), "set_name").limit(4)
    ctx.note(gene_signatures_scored=names, gene_signatures_most_variable=[r.set_name for r in top.collect()])


@module
def evolution(ctx: Context) -> None:
    scores = ctx["cnv"].select("cell_id", "cnv_score")
    clones = cnv.hierarchical_clones(ctx["cnv_profiles"]) if "cnv_profiles" in ctx else cnv.score_clones(scores).select("cell_id", "clone")
    clones = ctx.put("evolution", "clones", clones)
    x = clones.join(scores, "cell_id").join(ctx["pseudotime"], "cell_id", "left")
    x = x.join(ctx["cell_types"].select("cell_id", "cell_type"), "cell_id", "left") if "cell_types" in ctx else x.withColumn("cell_type", F.lit(None).cast("string"))
    stats = cnv.clone_stats(x)
    digits = {c: F.bround(c, 4) for c in ("fraction", "mean_cnv_score", "mean_pseudotime", "median_pseudotime")}
    ctx.put("evolution", "clone_stats", stats.withColumns(digits))
    ctx.put("evolution", "clone_composition", groups.proportions(clones.join(ctx["clusters"], "cell_id"), "clone", "cluster"))
    tests = ranking.rank_genes(ranking.wilcoxon(ctx["lognorm"], clones.withColumnRenamed("clone", "grp"), "grp"), "grp", 50)
    ctx.put("evolution", "clone_markers", tests.where("padj < 0.05").orderBy("grp", "rank").limit(200))
    sizes = {r.clone: r["count"] for r in clones.groupBy("clone").count().collect()}
    ctx.note(n_clones=len(sizes), clone_sizes=sizes)


@module
def pseudobulk_de(ctx: Context) -> None:
    cells = ctx["cells"]
    sample = groups.first_column(cells, [ctx.cfg.batch.key, "sample", "batch", "donor", "patient"])
    group = "cell_type" if "cell_types" in ctx else "cluster"
    labels = ctx["cell_types"] if "cell_types" in ctx else ctx["clusters"]
    if sample is None:
        ctx.note(pseudobulk_de_status="skipped_missing_grouping_columns")
        return
    if cells.select(sample).distinct().limit(2).count() < 2:
        ctx.note(pseudobulk_de_status="skipped_single_sample")
        return
    units = cells.select("cell_id", F.col(sample).alias("sample")).join(labels.select("cell_id", F.col(group).alias("grp")), "cell_id")
    bulk = ctx.put("pseudobulk_de", "pseudobulk", groups.pseudobulk(ctx["lognorm"], units, "sample", "grp"))
    if not bulk.limit(1).count():
        ctx.note(pseudobulk_de_status="skipped_no_valid_pseudobulk_groups")
        return
    if ctx.cfg.pseudobulk_backend == "negative_binomial":  # counts of the units of one group against all others
        counts = ctx.put("pseudobulk_de", "pseudobulk_counts", groups.pseudobulk(ctx["expr"], units, "sample", "grp").withColumn("unit", F.concat_ws("|", "sample", "grp")))
        parts = [ranking.negative_binomial(counts, "unit", "grp", r.grp).withColumn("grp", F.lit(r.grp)) for r in counts.select("grp").distinct().orderBy("grp").collect()]
        tests = parts[0]
        for p in parts[1:]:
            tests = tests.unionByName(p)
        got = ctx.put("pseudobulk_de", "pseudobulk_de", tests)
    else:
        got = ctx.put("pseudobulk_de", "pseudobulk_de", ranking.pseudobulk_contrasts(bulk, ctx["genes"], "sample", "grp"))
    ctx.note(pseudobulk_de_status="completed" if got.limit(1).count() else "no_testable_groups", pseudobulk_de_significant_genes=got.where("padj < 0.05").count())


@module
def cell_fate(ctx: Context) -> None:
    cells = ctx["pseudotime"].join(ctx["clusters"], "cell_id").select(F.col("cell_id").alias("id"), F.col("cluster").alias("label"), "pt")
    term = ctx.put("cell_fate", "terminal_states", neighbors.terminal_clusters(cells))
    if ctx.cfg.fate_backend == "absorbing":
        ends = cells.join(term.select(F.col("cluster").alias("label")), "label").select("id", F.col("label").alias("fate"))
        fates = neighbors.absorption(ctx["graph"], ends)
    else:
        fates = neighbors.fate_probabilities(ctx["graph"], cells)
    ctx.put("cell_fate", "fate_probabilities", fates)
    mean = ctx["fate_probabilities"].join(cells.select("id", "label"), "id").groupBy("label", "fate").agg(F.avg("probability").alias("probability"))
    ctx.put("cell_fate", "fate_per_cluster", mean)
    ctx.note(n_terminal_states=term.count())


@module
def composition(ctx: Context) -> None:
    cells = ctx["cells"].join(ctx["clusters"], "cell_id").join(ctx["cell_types"].select("cell_id", "cell_type"), "cell_id")
    key = groups.first_column(cells, [ctx.cfg.batch.key, "sample", "batch", "donor", "patient", "condition"], several=True) or "cluster"
    counts = ctx.put("composition", "composition_counts", groups.counts(cells, key, "cell_type").withColumnRenamed(key, "grp"))
    props = ctx.put("composition", "composition_proportions", groups.proportions(cells, key, "cell_type").withColumnRenamed(key, "grp"))
    n = counts.select("grp").distinct().count()
    if n < 2:
        ctx.put("composition", "composition_tests", ranking.permutation_z(counts, "cell_type"))
    elif "condition" in cells.columns and key != "condition":
        by = cells.select(F.col(key).alias("grp"), "condition").distinct()
        ctx.put("composition", "composition_tests", ranking.composition_tests(props.join(by, "grp"), "grp", "condition", "cell_type"))
    ctx.note(composition_n_groups=n, composition_n_cell_types=counts.select("cell_type").distinct().count())


@module
def metacell(ctx: Context) -> None:
    vectors = ctx["pca"]
    n = vectors.count()
    k = min(embedding.metacell_count(n), max(2, n // 2))
    lab = embedding.kmeans(vectors, k, ctx.cfg.clustering.random_state).select(F.col("id").alias("cell_id"), F.col("cluster").alias("metacell"))
    lab = lab.join(ctx["clusters"], "cell_id")
    lab = lab.join(ctx["cell_types"].select("cell_id", "cell_type"), "cell_id", "left") if "cell_types" in ctx else lab.withColumn("cell_type", F.lit(None).cast("string"))
    lab = ctx.put("metacell", "metacell_assignments", lab)
    ctx.put("metacell", "metacells", groups.metacells(ctx["lognorm"], lab))
    s = ctx.put("metacell", "metacell_summary", groups.metacell_summary(lab))
    ctx.note(n_metacells=s.count(), metacell_median_size=s.agg(F.percentile("n_cells", 0.5)).first()[0])
