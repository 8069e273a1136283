"""Command line of a run: python -m cytolake.plans.cli --project P --source DIR --output-dir OUT"""

from __future__ import annotations

import argparse
import sys

from cytolake.plans import config as C
from cytolake.plans.dag import DEPENDS
from cytolake.sources.tables import read_dictionary

#: Flag, place in the configuration, and type or choices.
FLAGS: list[tuple[str, str, object]] = [
    ("--source", "ingest.source", str), ("--sample-id", "ingest.sample", str), ("--qc-preset", "qc.preset", ["modular", "standard"]),
    ("--min-genes", "qc.min_genes", int), ("--max-genes", "qc.max_genes", int), ("--min-counts", "qc.min_counts", int), ("--max-counts", "qc.max_counts", int),
    ("--max-mito-pct", "qc.max_mito_pct", float), ("--max-ribo-pct", "qc.max_ribo_pct", float), ("--min-cells", "qc.min_cells", int),
    ("--expected-doublet-rate", "doublet.expected_rate", float), ("--n-top-genes", "clustering.n_top_genes", int), ("--n-pcs", "clustering.n_pcs", int), ("--n-neighbors", "clustering.n_neighbors", int),
    ("--resolution", "clustering.resolution", float), ("--de-method", "de_method", ["wilcoxon", "t-test", "t-test_overestim_var", "logreg"]), ("--de-n-genes", "de_n_genes", int),
    ("--de-pval-threshold", "de_alpha", float), ("--de-logfc-threshold", "de_lfc", float), ("--annotation-threshold", "annotation_threshold", float),
    ("--batch-key", "batch.key", str), ("--batch-method", "batch.method", ["harmony", "bbknn", "combat", "mutual"]), ("--root-cluster", "root_cluster", str),
    ("--neighbors", "clustering.neighbors", ["exact", "cells"]), ("--layout", "clustering.layout", ["components", "graph"]), ("--pseudobulk-backend", "pseudobulk_backend", ["rank", "negative_binomial"]), ("--fate-backend", "fate_backend", ["graph", "absorbing"]),
    ("--cnv-reference-group", "cnv.reference_group", str), ("--cnv-window-size", "cnv.window_size", int), ("--velocity-reads", "velocity.reads", str), ("--velocity-layers", "velocity.layers", str),
    ("--velocity-gtf", "velocity.gtf", str), ("--velocity-reference-dir", "velocity.reference_dir", str), ("--velocity-min-shared-counts", "velocity.min_shared_counts", int),
    ("--mutations-table", "mutations.table", str), ("--mutations-study", "mutations.study", str), ("--mutations-top-n", "mutations.top_n", int),
    ("--resume-from", "resume_from", str), ("--parallel-workers", "workers", int), ("--run-id", "run_id", str),
]


def parse(argv: list[str]) -> C.Run:
    p = argparse.ArgumentParser(description="Single-cell analytics on Spark")
    p.add_argument("--project", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--modules", default=",".join(C.Run("", "").modules), help=f"of: {', '.join(sorted(DEPENDS))}")
    p.add_argument("--markers-json")
    p.add_argument("--signature-json")
    p.add_argument("--mutation-genes", default="")
    for flag in ("--keep-doublets", "--scale-data", "--regress-cell-cycle", "--no-mutation-de-genes"):
        p.add_argument(flag, action="store_true")
    for flag, _, kind in FLAGS:
        p.add_argument(flag, **({"choices": kind} if isinstance(kind, list) else {"type": kind}))
    a = p.parse_args(argv)
    names = [m.strip() for m in a.modules.split(",") if m.strip()]
    if unknown := sorted(set(names) - set(DEPENDS)):
        raise SystemExit(f"unknown modules: {unknown}; known: {sorted(DEPENDS)}")
    cfg = C.Run(a.project, a.output_dir, modules=names, regress_cell_cycle=a.regress_cell_cycle)
    for flag, place, _ in FLAGS:
        value = getattr(a, flag[2:].replace("-", "_"))
        if value is not None:
            *path, last = place.split(".")
            setattr(getattr(cfg, path[0]) if path else cfg, last, value)
    cfg.doublet.remove = not a.keep_doublets
    cfg.clustering.scale = a.scale_data
    cfg.mutations.genes = [g.strip() for g in a.mutation_genes.split(",") if g.strip()]
    cfg.mutations.use_de_genes = not a.no_mutation_de_genes
    cfg.markers = read_dictionary(a.markers_json) if a.markers_json else {}
    cfg.signatures = read_dictionary(a.signature_json) if a.signature_json else {}
    if bad := cfg.problems():
        raise SystemExit("; ".join(bad))
    return cfg


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from cytolake.plans.runner import Engine

    cfg = parse(sys.argv[1:] if argv is None else argv)
    ctx = Engine(SparkSession.builder.appName(cfg.project).getOrCreate(), cfg).run()
    for s in ctx.status:
        print(f"{s['module']:26} {'ok' if s['ok'] else 'failed':7} {s['message']}")
    return int(not all(s["ok"] for s in ctx.status))


if __name__ == "__main__":
    sys.exit(main())
