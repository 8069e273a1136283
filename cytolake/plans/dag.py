"""Which modules a run needs, in which order, and which can run side by side."""

from __future__ import annotations

import graphlib
from collections.abc import Iterable, Mapping

# The modules and what each needs.
DEPENDS: dict[str, tuple[str, ...]] = {
    "cellranger": (), "qc": ("cellranger",), "doublet_detection": ("qc",), "clustering": ("doublet_detection",), "cell_cycle": ("clustering",), "batch_correction": ("clustering",),
    "differential_expression": ("clustering",), "annotation": ("clustering",), "trajectory": ("clustering",), "pseudo_velocity": ("trajectory",), "rna_velocity": ("clustering",), "cnv_inference": ("clustering",),
    "pathway_analysis": ("differential_expression",), "cell_communication": ("annotation",), "gene_regulatory_network": ("clustering",), "validate_cbioportal": ("differential_expression",),
    "immune_phenotyping": ("annotation",), "tumor_microenvironment": ("annotation",), "gene_signature_scoring": ("clustering",), "evolution": ("cnv_inference", "trajectory"),
    "pseudobulk_de": ("differential_expression",), "cell_fate": ("trajectory",), "composition": ("annotation",), "metacell": ("clustering",),
}
MANDATORY = ("cellranger", "qc", "doublet_detection")
# Relative costs, dearest first within a tier; 1 where none is given.
COST = {"rna_velocity": 10, "cnv_inference": 5, "evolution": 5, "trajectory": 4, "differential_expression": 3, "clustering": 3, "immune_phenotyping": 2, "tumor_microenvironment": 2, "pathway_analysis": 2, "cell_communication": 2, "pseudobulk_de": 2, "metacell": 2, "cell_fate": 2}


def closure(names: Iterable[str], depends: Mapping[str, Iterable[str]] = DEPENDS) -> set[str]:
    """The names and all they need."""
    found: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in found:
            if name not in depends:
                raise KeyError(f"unknown module {name!r}; known: {', '.join(sorted(depends))}")
            found.add(name)
            todo.extend(depends[name])
    return found


def tiers(names: Iterable[str], depends: Mapping[str, Iterable[str]] = DEPENDS, done: Iterable[str] = (), cost: Mapping[str, int] = COST) -> list[list[str]]:
    """Groups of modules whose needs earlier groups fulfil; in each, the dearest first, then by name."""
    done = set(done)
    want = closure(names, depends) - done
    sorter = graphlib.TopologicalSorter({n: set(depends[n]) & want for n in want})
    try:
        sorter.prepare()
    except graphlib.CycleError as e:
        raise ValueError(f"cyclic dependency: {sorted(set(e.args[1]))}") from e
    out = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready(), key=lambda n: (-cost.get(n, 1), n))
        out.append(ready)
        sorter.done(*ready)
    return out


def order(names: Iterable[str], depends: Mapping[str, Iterable[str]] = DEPENDS) -> list[str]:
    """One sequence that keeps to the dependencies: of the modules that are ready, those that became ready first, by name among equals."""
    return [n for tier in tiers(names, depends, cost={}) for n in tier]
