"""Gene annotation scans."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytolake.functions.numeric import gtf_attribute


def exons_of_lines(lines: DataFrame) -> DataFrame:
    """chrom, gene, start (0-based), end of the exon lines that name a gene; lines: value."""
    f = F.split("value", "\t")
    rows = lines.where(~F.startswith("value", F.lit("#"))).select(f.alias("f")).where((F.size("f") >= 9) & (F.col("f")[2] == "exon"))
    gene = gtf_attribute(F.col("f")[8], "gene_name")
    return rows.select(F.col("f")[0].alias("chrom"), gene.alias("gene"), (F.col("f")[3].cast("long") - 1).alias("start"), F.col("f")[4].cast("long").alias("end")).where(F.col("gene").isNotNull())


def read_exons(spark: SparkSession, path: str) -> DataFrame:
    """Plain or gzip GTF."""
    return exons_of_lines(spark.read.text(path))


def resolve_path(explicit: str | None, reference_dir: str | None) -> Path | None:
    """The explicit file (none if it is missing), else the first that exists below the reference folder."""
    if explicit:
        p = Path(explicit)
        return p if p.exists() else None
    if not reference_dir:
        return None
    root = Path(reference_dir)
    for name in ("genes/genes.gtf", "genes/genes.gtf.gz", "genes.gtf", "genes.gtf.gz"):
        if (root / name).exists():
            return root / name
    return None
