"""Configuration tree of a run. The defaults are fixed values that results depend on."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field


@dataclass
class Ingest:
    source: str = ""  # a 10x folder, or a folder of cells, genes and expr tables
    sample: str = "sample"
    min_barcodes: int = 1


@dataclass
class QualityControl:
    preset: str = "modular"  # or "standard"
    min_genes: int = 200
    max_genes: int = 7000
    min_counts: int = 500
    max_counts: int = 50000
    max_mito_pct: float = 20.0
    max_ribo_pct: float = 50.0
    min_cells: int = 3


@dataclass
class Doublets:
    expected_rate: float = 0.06
    remove: bool = True


@dataclass
class Clustering:
    n_top_genes: int = 3000
    target_sum: float = 1e4
    n_pcs: int = 40
    n_neighbors: int = 15
    resolution: float = 0.8
    random_state: int = 0
    scale: bool = False
    neighbors: str = "exact"  # or "cells": an index, with recall below 1
    layout: str = "components"  # or "graph": descent on the neighbour graph, from the first two components


@dataclass
class Batches:
    key: str = "sample"
    method: str = "harmony"


@dataclass
class CopyNumber:
    reference_group: str | None = None
    window_size: int = 100
    percentile: float = 75.0


@dataclass
class Velocity:
    reads: str | None = None  # table of aligned reads, or a BAM file
    layers: str | None = None  # table of spliced and unspliced counts
    gtf: str | None = None
    reference_dir: str | None = None
    min_shared_counts: int = 20
    n_pcs: int = 30
    n_neighbors: int = 30


@dataclass
class Mutations:
    table: str | None = None
    genes: list[str] = field(default_factory=list)
    study: str = "lusc_tcga_pan_can_atlas_2018"
    use_de_genes: bool = True
    top_n: int = 20


@dataclass
class Run:
    project: str
    output_dir: str
    run_id: str = "run"
    modules: list[str] = field(default_factory=lambda: ["clustering", "differential_expression", "annotation", "trajectory", "pseudo_velocity"])
    ingest: Ingest = field(default_factory=Ingest)
    qc: QualityControl = field(default_factory=QualityControl)
    doublet: Doublets = field(default_factory=Doublets)
    clustering: Clustering = field(default_factory=Clustering)
    batch: Batches = field(default_factory=Batches)
    cnv: CopyNumber = field(default_factory=CopyNumber)
    velocity: Velocity = field(default_factory=Velocity)
    mutations: Mutations = field(default_factory=Mutations)
    markers: dict[str, list[str]] = field(default_factory=dict)
    signatures: dict[str, list[str]] = field(default_factory=dict)
    builtin_signatures: bool = True
    regress_cell_cycle: bool = False
    root_cluster: str | None = None
    resume_from: str | None = None
    workers: int = 1
    de_method: str = "wilcoxon"
    de_n_genes: int = 300
    de_alpha: float = 0.05
    de_lfc: float = 0.25
    annotation_threshold: float = 0.1
    pseudobulk_backend: str = "rank"  # or "negative_binomial"
    fate_backend: str = "graph"  # or "absorbing"

    def problems(self) -> list[str]:
        """What is wrong with the values; empty if nothing is."""
        q, c = self.qc, self.clustering
        rules = [
            (q.min_genes < q.max_genes, f"min_genes ({q.min_genes}) must be below max_genes ({q.max_genes})"),
            (q.min_counts < q.max_counts, f"min_counts ({q.min_counts}) must be below max_counts ({q.max_counts})"),
            (0 <= q.max_mito_pct <= 100, f"max_mito_pct must be within 0 and 100, not {q.max_mito_pct}"),
            (0 <= q.max_ribo_pct <= 100, f"max_ribo_pct must be within 0 and 100, not {q.max_ribo_pct}"),
            (self.workers >= 1, f"workers must be 1 or more, not {self.workers}"),
            (c.n_pcs >= 1, f"n_pcs must be 1 or more, not {c.n_pcs}"),
            (c.n_neighbors >= 1, f"n_neighbors must be 1 or more, not {c.n_neighbors}"),
            (c.resolution > 0, f"resolution must be above 0, not {c.resolution}"),
            (self.de_n_genes >= 1, f"de_n_genes must be 1 or more, not {self.de_n_genes}"),
        ]
        return [text for ok, text in rules if not ok]

    def as_dict(self) -> dict:
        return asdict(self)
