"""Quality control, filters, normalisation and gene selection over expr(cell_id, gene_id, value)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytolake.operators.ordering import placed
from cytolake.sources.shared import partitions, written


@dataclass(frozen=True)
class QCLimits:
    """Inclusive limits on a cell."""

    min_genes: float = 200
    max_genes: float = 7000
    min_counts: float = 500
    max_counts: float = 50000
    max_mito: float = 20
    max_ribo: float = 50


def gene_flags(genes: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Mitochondrial, ribosomal and haemoglobin genes by the prefixes of their symbols."""
    s = F.upper(symbol)
    return genes.withColumns({"mt": s.startswith("MT-"), "ribo": s.rlike("^RP[SL]"), "hb": s.rlike("^HB[AB]")})


def qc_metrics(expr: DataFrame, flags: DataFrame, names: list[str]) -> DataFrame:
    """n_genes_by_counts, total_counts and pct_counts_<flag> of each cell; a percentage of nothing is null."""
    marked = expr.join(flags.select("gene_id", *names), "gene_id", "left")
    share = lambda c: (100 * F.try_divide(F.sum(F.when(F.col(c), F.col("value")).otherwise(0.0)), F.sum("value"))).alias(f"pct_counts_{c}")
    return marked.groupBy("cell_id").agg(F.count_if(F.col("value") > 0).alias("n_genes_by_counts"), F.sum("value").alias("total_counts"), *map(share, names))


def qc_pass(limits: QCLimits, mito: str, ribo: str | None = None) -> Column:
    n, c = F.col("n_genes_by_counts"), F.col("total_counts")
    ok = (n >= limits.min_genes) & (n <= limits.max_genes) & (c >= limits.min_counts) & (c <= limits.max_counts) & (F.coalesce(F.col(mito), F.lit(0.0)) <= limits.max_mito)
    return ok if ribo is None else ok & (F.coalesce(F.col(ribo), F.lit(0.0)) <= limits.max_ribo)


def standard_pass(mito: str, min_genes: float = 200, max_mito: float = 5) -> Column:
    """The strict preset."""
    return (F.col("n_genes_by_counts") > min_genes) & (F.col(mito) < max_mito)


def filter_genes(expr: DataFrame, min_cells: int) -> DataFrame:
    """Genes stored above 0 in at least min_cells cells."""
    return expr.groupBy("gene_id").agg(F.count_if(F.col("value") > 0).alias("n_cells")).where(F.col("n_cells") >= min_cells)


def normalize(expr: DataFrame, target: float = 1e4) -> DataFrame:
    """Values scaled to target a cell, then log1p; zeros stay implicit."""
    total = F.sum("value").over(W.partitionBy("cell_id"))
    return expr.select("cell_id", "gene_id", F.log1p(F.col("value") * target / total).alias("value"))


def gene_moments(expr: DataFrame, n_cells) -> DataFrame:
    """Mean and variance (ddof 1) of each gene over all cells, implicit zeros included. n_cells: a number, or a one-row frame with n."""
    sums = expr.groupBy("gene_id").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"), F.count("*").alias("nnz"))
    if isinstance(n_cells, DataFrame):
        sums = sums.join(F.broadcast(n_cells.select(F.col("n").cast("double"))))  # one row
    else:
        sums = sums.withColumn("n", F.lit(float(n_cells)))
    mean = F.col("s") / F.col("n")
    return sums.select("gene_id", "n", "nnz", mean.alias("mean"), F.greatest(F.lit(0.0), (F.col("ss") - F.col("n") * mean * mean) / (F.col("n") - 1)).alias("var"))


def count_cells(cells: DataFrame) -> DataFrame:
    return cells.agg(F.count("*").cast("double").alias("n"))


def scale(expr: DataFrame, moments: DataFrame, max_value: float = 10) -> DataFrame:
    """Values over the gene's standard deviation (1 if it is 0), clipped; not centred, so zeros stay implicit."""
    sd = F.when(F.col("var") > 0, F.sqrt("var")).otherwise(1.0)
    return expr.join(moments.select("gene_id", "var"), "gene_id").select("cell_id", "gene_id", F.least(F.lit(float(max_value)), F.col("value") / sd).alias("value"))


def highly_variable(lognorm: DataFrame, n_cells, n_top: int, bins: int = 20) -> DataFrame:
    """gene_id, mean, dispersion and z of the n_top genes by normalised dispersion."""
    m = gene_moments(lognorm.withColumn("value", F.expm1("value")), n_cells)
    disp = F.log(F.nullif(F.try_divide(F.col("var"), F.col("mean")), F.lit(0.0)))
    g = m.select("gene_id", F.log1p("mean").alias("mean"), disp.alias("dispersion"))
    span = g.agg(F.min("mean").alias("lo"), F.max("mean").alias("hi"))
    g = g.join(F.broadcast(span)).withColumn("bin", F.least(F.lit(bins - 1), F.floor((F.col("mean") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)).cast("int"))
    w = W.partitionBy("bin")
    z = F.when(F.count("dispersion").over(w) == 1, F.lit(1.0)).otherwise(F.try_divide(F.col("dispersion") - F.avg("dispersion").over(w), F.stddev_samp("dispersion").over(w)))
    return g.withColumn("z", z).where("dispersion is not null and z is not null").orderBy(F.desc(F.round("z", 9)), "gene_id").limit(n_top).select("gene_id", "mean", "dispersion", "bin", "z")


def unique_symbols(genes: DataFrame) -> DataFrame:
    """Repeated symbols get -1, -2, ... after the first, by gene_id."""
    rn = F.row_number().over(W.partitionBy("symbol").orderBy("gene_id"))
    return genes.withColumn("symbol", F.when(rn == 1, F.col("symbol")).otherwise(F.concat("symbol", F.lit("-"), (rn - 1).cast("string"))))


def _fits(x: DataFrame, c: DataFrame) -> DataFrame:
    """Of each gene the mean mv, the coefficients k1, k2 of the centred covariates, and their means ma, mb. c: cell_id, a, b; x: its rows with gene_id and value."""
    m = c.agg(F.count("*").alias("n"), F.avg("a").alias("ma"), F.avg("b").alias("mb"), F.covar_pop("a", "a").alias("aa"), F.covar_pop("b", "b").alias("bb"), F.covar_pop("a", "b").alias("ab"))
    g = x.groupBy("gene_id").agg(F.sum("value").alias("sv"), F.sum(F.col("value") * F.col("a")).alias("sa"), F.sum(F.col("value") * F.col("b")).alias("sb"))
    g = g.join(F.broadcast(m))
    mv = F.col("sv") / F.col("n")
    va, vb = F.col("sa") / F.col("n") - mv * F.col("ma"), F.col("sb") / F.col("n") - mv * F.col("mb")
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    k1, k2 = F.coalesce(F.try_divide(va * F.col("bb") - vb * F.col("ab"), det), F.lit(0.0)), F.coalesce(F.try_divide(vb * F.col("aa") - va * F.col("ab"), det), F.lit(0.0))
    return g.select("gene_id", mv.alias("mv"), k1.alias("k1"), k2.alias("k2"), "ma", "mb")


def regress_out(values: DataFrame, covariates: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Residual of each gene on a constant and two covariates, for all cells (the result is dense). One pass of sums a gene, a closed 3x3 solution, and one join of the cells with each gene's coefficients."""
    c = covariates.select("cell_id", F.col(names[0]).alias("a"), F.col(names[1]).alias("b"))
    g = _fits(values.join(c, "cell_id"), c)
    stored = values.groupBy("cell_id").agg(F.map_from_entries(F.collect_list(F.struct("gene_id", "value"))).alias("v"))
    dense = c.join(stored, "cell_id", "left").join(F.broadcast(g.agg(F.collect_list(F.struct("gene_id", "mv", "k1", "k2", "ma", "mb")).alias("gs"))))  # as many entries as genes
    x = dense.select("cell_id", "a", "b", "v", F.explode("gs").alias("g"))
    fit = F.col("g.mv") + F.col("g.k1") * (F.col("a") - F.col("g.ma")) + F.col("g.k2") * (F.col("b") - F.col("g.mb"))
    return x.select("cell_id", F.col("g.gene_id").alias("gene_id"), (F.coalesce(F.try_element_at("v", F.col("g.gene_id")), F.lit(0.0)) - fit).alias("value"))


def _residual_sums(block: int, genes: int = 16, width: int = 4096):
    """Over rows by tile: its places (kind 0), then each gene's coefficients (pos -1) and stored values (pos of their cell's place). Forms the residuals of
    all places, those where nothing is stored too, for some genes and places at once (half a MB, to stay in a core's cache). Cells at one place that store
    nothing have one residual, which counts as often as they are; a stored value has its own. Memory is a batch, a gene's rows and the places."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        design, made = np.zeros((-(-block // width), 3, width)), np.empty((genes, width))  # 1, a, b of each place times the root of its cells; 0 where there is none
        place = np.zeros((block, 4))  # 1, a, b, cells
        tile, used, carry = None, 0, None

        def out(rows: pa.RecordBatch) -> pa.RecordBatch:
            pos, value = rows["pos"].to_numpy(), rows["p"].to_numpy(zero_copy_only=False)
            first, own = np.flatnonzero(pos < 0), np.cumsum(pos < 0) - 1
            fit = np.column_stack([rows[k].to_numpy(zero_copy_only=False)[first] for k in "pqr"])
            chunks = -(-used // width)
            own, at, value = own[pos >= 0], pos[pos >= 0], value[pos >= 0]
            fitted = (fit[own] * place[at, :3]).sum(axis=1)
            ss = np.bincount(own, (value - fitted) ** 2, len(first)).astype(float)  # of no values it gives integers
            order = np.lexsort((at, own, at // width, own // genes))
            own, at, fitted = own[order], at[order], fitted[order]
            new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1])]) if len(at) else np.zeros(0, int)
            stored = np.diff(np.r_[new, len(at)])
            own, at, fitted = own[new], at[new], fitted[new]
            rest = np.sqrt(np.maximum(0, place[at, 3] - stored)) * fitted  # what is left where some or all cells of a place store the gene
            ends = np.searchsorted(own // genes * chunks + at // width, np.arange(-(-len(first) // genes) * chunks + 1))
            at = own % genes * width + at % width
            for i in range(0, len(first), genes):
                k = fit[i : i + genes]
                r = made[: len(k)]
                flat = r.reshape(-1)
                for j in range(chunks):
                    np.matmul(k, design[j], out=r)  # residuals but for their sign, where the value is 0
                    lo, hi = ends[i // genes * chunks + j : i // genes * chunks + j + 2]
                    flat[at[lo:hi]] = rest[lo:hi]
                    ss[i : i + genes] += np.vecdot(r, r)
            unknown = rows["p"].is_null().to_numpy(zero_copy_only=False)[first]
            return pa.RecordBatch.from_arrays([rows["gene_id"].take(pa.array(first)), pa.array(ss, mask=unknown)], ["gene_id", "ss"])

        for batch in batches:
            keys = np.column_stack([batch[k].to_numpy() for k in ("block", "part", "kind")])
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else []
            for lo, hi in zip(starts, [*starts[1:], len(keys)]):
                rows, key = batch.slice(lo, hi - lo), tuple(keys[lo])
                if key[:2] != tile:
                    if carry is not None:
                        yield out(carry)
                    tile, used, carry = key[:2], 0, None
                    design[:] = 0
                if key[2] == 0:
                    pos = rows["pos"].to_numpy()
                    place[pos] = np.column_stack([np.ones(len(pos)), *(rows[k].to_numpy() for k in "pqr")])
                    design[pos // width, :, pos % width] = place[pos, :3] * np.sqrt(place[pos, 3:])
                    used = max(used, int(pos.max()) + 1)
                    continue
                rows = rows if carry is None else pa.concat_batches([carry, rows])
                last = int(np.flatnonzero(rows["pos"].to_numpy() < 0)[-1])  # this gene's rows may go on
                if last:
                    yield out(rows.slice(0, last))
                carry = rows.slice(last)
        if carry is not None:
            yield out(carry)

    return sums


def residual_squares(values: DataFrame, covariates: DataFrame, names: tuple[str, str], block: int = 1 << 16) -> DataFrame:
    """gene_id, residual_ss: each gene's sum of the squares of what regress_out gives, over all cells. Every residual is formed, in tiles of block places
    (pairs of covariates) and some block genes, and squared there; so they are never rows of a table. The work is that of all places times all genes.
    A cell has one value of a gene at most."""
    spark = values.sparkSession
    c = covariates.select("cell_id", F.col(names[0]).cast("double").alias("a"), F.col(names[1]).cast("double").alias("b"))
    places = written(placed(c.dropna(subset=["a", "b"]).groupBy("a", "b").agg(F.count("*").cast("double").alias("cells")), ["a", "b"]), "places")
    c = c.join(places.drop("cells"), ["a", "b"], "left")
    x = written(values.join(c, "cell_id").select("gene_id", F.col("value").cast("double").alias("value"), "a", "b", "place"), "values")
    g = written(_fits(x, c), "fits")
    n, genes = places.count(), g.count()
    blocks = -(-n // block)
    parts = max(-(-genes // block), min(-(-partitions(spark) // max(1, blocks)), -(-n * genes // (1 << 28))))  # a task for each partition, but not for less than some 0.3 s
    part = F.pmod(F.hash("gene_id"), F.lit(max(1, parts))).alias("part")
    at = [F.floor(F.col("place") / block).cast("int").alias("block"), (F.col("place") % block).cast("int").alias("pos")]
    double = lambda n: F.lit(None).cast("double").alias(n)
    order = ["block", "part", "kind", "gene_id", "pos", "p", "q", "r"]
    no_gene = F.lit(None).cast(x.schema["gene_id"].dataType).alias("gene_id")
    m = F.broadcast(c.agg(F.avg("a").alias("ma"), F.avg("b").alias("mb")))  # one row
    each = lambda n, name: F.broadcast(spark.range(n).select(F.col("id").cast("int").alias(name)))
    own = places.join(m).select(*at, (F.col("a") - F.col("ma")).alias("p"), (F.col("b") - F.col("mb")).alias("q"), F.col("cells").alias("r"))
    own = own.join(each(parts, "part")).select("*", F.lit(0).alias("kind"), no_gene)
    fits = g.join(each(blocks, "block")).select("block", part, F.lit(1).alias("kind"), "gene_id", F.lit(-1).alias("pos"), F.col("mv").alias("p"), F.col("k1").alias("q"), F.col("k2").alias("r"))
    stored = x.where("place is not null and value is not null").select(*at, part, F.lit(1).alias("kind"), "gene_id", F.col("value").alias("p"), double("q"), double("r"))
    rows = own.select(order).union(fits.select(order)).union(stored.select(order))
    dealt = rows.repartition(partitions(spark), "block", "part").sortWithinPartitions("block", "part", "kind", "gene_id", "pos")
    kind = f"gene_id {x.schema['gene_id'].dataType.simpleString()}, ss double"
    return dealt.mapInArrow(_residual_sums(block), kind).groupBy("gene_id").agg(F.sum("ss").alias("residual_ss"))
