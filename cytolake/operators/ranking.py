"""Rank and mean tests with implicit zeros, multiple-testing adjustment, enrichment, and agreement of labelings."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytolake.functions.numeric import chi2_p, exact_mann_whitney, log2_ratio, student_p, two_sided


def bh_adjust(df: DataFrame, p: str, key: list[str], by: list[str] | None = None, out: str = "padj") -> DataFrame:
    """Benjamini-Hochberg within each family of tests (by); key breaks ties. Without by, one result-sized family."""
    w = W.partitionBy(*(by or [F.lit(0)]))
    order = [F.col(p).asc(), *key]
    n, rank = F.count(p).over(w), F.row_number().over(w.orderBy(*order))
    df = df.withColumns({"bh_raw": F.col(p) * n / rank, "bh_rank": rank})
    low = F.min("bh_raw").over(w.orderBy(F.desc("bh_rank")).rowsBetween(W.unboundedPreceding, W.currentRow))
    return df.withColumn(out, F.least(F.lit(1.0), low)).drop("bh_raw", "bh_rank")


def average_rank(value: Column, by: list) -> Column:
    """Average rank of ties, ascending."""
    return F.rank().over(W.partitionBy(*by).orderBy(value)) + (F.count("*").over(W.partitionBy(*by, value)) - 1) / 2


def label_sizes(labels: DataFrame, label: str) -> DataFrame:
    return labels.groupBy(label).agg(F.count("*").cast("double").alias("nk")).withColumn("N", F.sum("nk").over(W.partitionBy(F.lit(0))))  # one row a label


def wilcoxon(expr: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """One-vs-rest rank-sum test of each gene in each label: gene_id, label, score (z), pval, lfc, pct, pct_rest. Values
    are log-normalised and not negative: a gene's zeros are one block of ties below its stored values. One pass ranks
    the stored values of a gene, as a sorted stream that may spill; a gene has one value a cell at most, hence no more of the
    table than one over the mean number of genes of a cell. Pairs of gene and label without stored values come from the genes times the labels."""
    x = expr.where("value > 0").join(labels.select("cell_id", label), "cell_id")
    tie = F.count("*").over(W.partitionBy("gene_id", "value")).cast("double")
    x = x.withColumns({"r": average_rank(F.col("value"), ["gene_id"]), "tie": tie * tie - 1})  # sums to t^3 - t
    each = x.groupBy("gene_id", label).agg(F.sum("r").alias("r"), F.count("*").alias("nnz"), F.sum(F.expm1("value")).alias("s"))
    gene = x.groupBy("gene_id").agg(F.count("*").alias("all_nnz"), F.sum("tie").alias("ties"), F.sum(F.expm1("value")).alias("all_s"))
    sizes = label_sizes(labels, label)
    both = gene.join(F.broadcast(sizes)).join(each, ["gene_id", label], "left").na.fill(0, ["r", "nnz", "s"])  # labels are few: a row each
    zeros = F.col("N") - F.col("all_nnz")
    n, nk = F.col("N"), F.col("nk")
    rank_sum = F.col("r") + F.col("nnz") * zeros + (nk - F.col("nnz")) * (zeros + 1) / 2
    correct = 1 - (F.col("ties") + zeros * zeros * zeros - zeros) / (n * n * n - n)
    z = F.coalesce(F.try_divide(rank_sum - nk * (n + 1) / 2, F.sqrt(correct * nk * (n - nk) * (n + 1) / 12)), F.lit(0.0))
    rest = n - nk
    lfc = F.log2((F.col("s") / nk + 1e-9) / ((F.col("all_s") - F.col("s")) / rest + 1e-9))
    got = both.select("gene_id", label, z.alias("score"), lfc.alias("lfc"), (F.col("nnz") / nk).alias("pct"), ((F.col("all_nnz") - F.col("nnz")) / rest).alias("pct_rest"))
    return got.withColumn("pval", two_sided(F.col("score")))


def ttest(expr: DataFrame, labels: DataFrame, label: str, overestimate: bool = False) -> DataFrame:
    """Welch statistic and degrees of freedom of each gene, label against rest, implicit zeros included."""
    x = expr.join(labels.select("cell_id", label), "cell_id")
    v = F.col("value")
    each = x.groupBy("gene_id", label).agg(F.sum(v).alias("s"), F.sum(v * v).alias("ss"))
    gene = x.groupBy("gene_id").agg(F.sum(v).alias("as"), F.sum(v * v).alias("ass"))
    b = gene.join(F.broadcast(label_sizes(labels, label))).join(each, ["gene_id", label], "left").na.fill(0.0, ["s", "ss"])
    n1, n2 = F.col("nk"), F.col("N") - F.col("nk")
    m1, m2 = F.col("s") / n1, (F.col("as") - F.col("s")) / n2
    v1 = F.greatest(F.lit(0.0), (F.col("ss") - n1 * m1 * m1) / (n1 - 1))
    v2 = F.greatest(F.lit(0.0), (F.col("ass") - F.col("ss") - n2 * m2 * m2) / (n2 - 1))
    n2 = n1 if overestimate else n2
    a, c = v1 / n1, v2 / n2
    t = F.coalesce(F.try_divide(m1 - m2, F.sqrt(a + c)), F.lit(0.0))
    df = F.try_divide((a + c) * (a + c), a * a / (n1 - 1) + c * c / (n2 - 1))
    return b.select("gene_id", label, t.alias("score"), df.alias("df"))


def ttest_p(tests: DataFrame) -> DataFrame:
    return tests.withColumn("pval", F.coalesce(student_p("score", "df"), F.lit(1.0)))


def rank_genes(tests: DataFrame, label: str, n_genes: int = 300) -> DataFrame:
    """Adjusts over all genes of a label, then keeps its n_genes best scores."""
    got = bh_adjust(tests, "pval", ["gene_id"], [label])
    return got.withColumn("rank", F.row_number().over(W.partitionBy(label).orderBy(F.desc(F.round("score", 9)), "gene_id"))).where(F.col("rank") <= n_genes)


def significant(ranked: DataFrame, alpha: float = 0.05, lfc: float = 0.25) -> DataFrame:
    return ranked.where((F.col("padj") < alpha) & (F.abs("lfc") > lfc))


def pseudobulk_contrasts(bulk: DataFrame, genes: DataFrame, sample: str, group: str, min_samples: int = 2) -> DataFrame:
    """Mann-Whitney of each gene, the samples of a group against those of the other groups, with log2 ratio of means; p
    from the normal tail with continuity and ties. bulk comes from pseudobulk(); absent sums count as 0, so a gene's
    zeros are one block of ties, as in wilcoxon()."""
    units = bulk.select(sample, group).distinct()
    size = units.groupBy(group).agg(F.count("*").cast("double").alias("nk")).withColumn("N", F.sum("nk").over(W.partitionBy(F.lit(0)))).where((F.col("nk") >= min_samples) & (F.col("N") - F.col("nk") >= min_samples))
    x = bulk.where("value > 0")
    tie = F.count("*").over(W.partitionBy("gene_id", "value")).cast("double")
    x = x.withColumns({"r": average_rank(F.col("value"), ["gene_id"]), "tie": tie * tie - 1})
    each = x.groupBy("gene_id", group).agg(F.sum("r").alias("r"), F.count("*").alias("nnz"), F.sum("value").alias("s"))
    gene = x.groupBy("gene_id").agg(F.count("*").alias("all_nnz"), F.sum("tie").alias("ties"), F.sum("value").alias("all_s"))
    b = gene.join(genes.select("gene_id"), "gene_id", "left_semi").join(F.broadcast(size)).join(each, ["gene_id", group], "left").na.fill(0, ["r", "nnz", "s"])
    n, nk, zeros = F.col("N"), F.col("nk"), F.col("N") - F.col("all_nnz")
    u = F.col("r") + F.col("nnz") * zeros + (nk - F.col("nnz")) * (zeros + 1) / 2 - nk * (nk + 1) / 2
    correct = 1 - (F.col("ties") + zeros * zeros * zeros - zeros) / (n * n * n - n)
    z = F.coalesce(F.try_divide(F.greatest(F.abs(u - nk * (n - nk) / 2) - 0.5, F.lit(0.0)), F.sqrt(correct * nk * (n - nk) * (n + 1) / 12)), F.lit(0.0))
    got = b.select("gene_id", group, log2_ratio(F.col("s") / nk, (F.col("all_s") - F.col("s")) / (n - nk)).alias("log2fc"), u.alias("u"), z.alias("z"))
    return bh_adjust(got.withColumn("pval", two_sided(F.col("z"))), "pval", ["gene_id"], [group])


def size_factors(bulk: DataFrame, sample: str) -> DataFrame:
    """sample, factor: the median over genes counted in every sample of a sample's count over the gene's geometric mean; 1 without such genes."""
    n = bulk.agg(F.countDistinct(sample)).first()[0]
    x = bulk.where("value > 0")
    mean = x.groupBy("gene_id").agg(F.avg(F.log("value")).alias("m"), F.count("*").alias("k")).where(F.col("k") == n)
    got = x.join(mean, "gene_id").groupBy(sample).agg(F.exp(F.percentile(F.log("value") - F.col("m"), 0.5)).alias("factor"))
    return bulk.select(sample).distinct().join(got, sample, "left").select(sample, F.coalesce("factor", F.lit(1.0)).alias("factor"))


def _negative_binomial(table: pd.DataFrame, sample: str):
    """Of one gene: a log-linear fit of counts on an intercept and the group, offset by the log size factors, by reweighted
    least squares; the dispersion is that of the groups' normalised variances over their means, pooled."""
    names, factor, x = table[sample].to_numpy(), table["factor"].to_numpy(float), table["first"].to_numpy(float)
    place = {v: i for i, v in enumerate(names)}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = np.zeros(len(names))
        y[[place[v] for v in pdf[sample]]] = pdf["value"].to_numpy(float)
        norm = y / factor
        over, free = 0.0, 0
        for g in (0, 1):
            v = norm[x == g]
            if len(v) > 1 and v.mean() > 0:
                over += (len(v) - 1) * (v.var(ddof=1) - v.mean() * np.mean(1 / factor[x == g])) / v.mean() ** 2
                free += len(v) - 1
        alpha = max(over / free, 1e-8) if free else 1e-8
        design = np.stack([np.ones(len(x)), x], axis=1)
        beta = np.array([np.log(max(norm.mean(), 1e-8)), 0.0])
        hess = np.eye(2)
        for _ in range(100):
            mu = np.maximum(factor * np.exp(np.clip(design @ beta, -30, 30)), 1e-10)
            w = mu / (1 + alpha * mu)
            hess = design.T @ (w[:, None] * design) + 1e-6 * np.eye(2)
            step = np.linalg.solve(hess, design.T @ ((y - mu) / (1 + alpha * mu)) - 1e-6 * beta)
            beta = beta + np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        se = float(np.sqrt(np.linalg.inv(hess)[1, 1]))
        z = float(beta[1] / se) if se > 0 else 0.0
        return pd.DataFrame([(int(pdf["gene_id"].iloc[0]), float(norm.mean()), float(beta[1] / np.log(2)), se / math.log(2), float(alpha), z, math.erfc(abs(z) / math.sqrt(2)))], columns=["gene_id", "base_mean", "log2fc", "lfc_se", "dispersion", "z", "pval"])

    return run


def negative_binomial(bulk: DataFrame, sample: str, condition: str, first: str) -> DataFrame:
    """gene_id, base_mean, log2fc, lfc_se, dispersion, z, pval, padj: the Wald test of condition = first against the other samples,
    of counts (gene_id, sample, condition, value; absent ones 0) under a negative binomial model. One task a gene, as wide as the samples."""
    samples = bulk.select(sample, (F.col(condition) == first).cast("double").alias("first")).distinct()
    table = samples.join(size_factors(bulk, sample), sample).orderBy(sample).toPandas()  # a row a sample
    kind = "gene_id long, base_mean double, log2fc double, lfc_se double, dispersion double, z double, pval double"
    got = bulk.select("gene_id", sample, F.col("value").cast("double").alias("value")).groupBy("gene_id").applyInPandas(_negative_binomial(table, sample), kind)
    return bh_adjust(got, "pval", ["gene_id"])


def mann_whitney(df: DataFrame, by: list[str], group: str, value: str, first: str) -> DataFrame:
    """Two-sided test of each family (by): group = first against the others. Exact for up to 8 untied values a side, else normal with continuity and ties."""
    x = df.select(*by, (F.col(group) == first).alias("a"), F.col(value).alias("v")).where(F.col("v").isNotNull())
    tie = F.count("*").over(W.partitionBy(*by, "v")).cast("double")
    x = x.withColumns({"r": average_rank(F.col("v"), by), "tie": tie * tie - 1})
    s = x.groupBy(*by).agg(F.sum(F.when(F.col("a"), F.col("r")).otherwise(0.0)).alias("r"), F.count_if("a").cast("double").alias("n1"), F.count("*").cast("double").alias("n"), F.sum("tie").alias("ties")).where("n1 > 0 and n > n1")
    n1, n, n2 = F.col("n1"), F.col("n"), F.col("n") - F.col("n1")
    s = s.withColumn("u", F.col("r") - n1 * (n1 + 1) / 2)
    z = F.try_divide(F.greatest(F.abs(F.col("u") - n1 * n2 / 2) - 0.5, F.lit(0.0)), F.sqrt((1 - F.col("ties") / (n * n * n - n)) * n1 * n2 * (n + 1) / 12))
    tables = F.create_map(*[y for i in range(1, 9) for j in range(1, 9) for y in (F.lit(f"{i},{j}"), F.array(*map(F.lit, exact_mann_whitney(i, j))))])
    exact = F.try_element_at(tables, F.concat(n1.cast("int"), F.lit(","), n2.cast("int")))
    p = F.when((F.col("ties") == 0) & (n1 <= 8) & (n2 <= 8), F.try_element_at(exact, F.col("u").cast("int") + 1)).otherwise(F.coalesce(two_sided(z), F.lit(1.0)))
    return s.select(*by, "u", p.alias("pval"))


def kruskal(df: DataFrame, by: list[str], group: str, value: str) -> DataFrame:
    """H with ties and its chi-square tail for each family."""
    x = df.select(*by, F.col(group).alias("g"), F.col(value).alias("v")).where(F.col("v").isNotNull())
    tie = F.count("*").over(W.partitionBy(*by, "v")).cast("double")
    x = x.withColumns({"r": average_rank(F.col("v"), by), "tie": tie * tie - 1})
    g = x.groupBy(*by, "g").agg(F.sum("r").alias("r"), F.count("*").cast("double").alias("k"), F.sum("tie").alias("t"))
    s = g.groupBy(*by).agg(F.sum(F.col("r") * F.col("r") / F.col("k")).alias("q"), F.sum("k").alias("n"), F.sum("t").alias("ties"), (F.count("*") - 1).cast("double").alias("df"))
    n = F.col("n")
    h = F.try_divide(12 * F.col("q") / (n * (n + 1)) - 3 * (n + 1), 1 - F.col("ties") / (n * n * n - n))
    return s.select(*by, h.alias("h"), "df").withColumn("pval", F.when(F.col("df") > 0, chi2_p("h", "df")))


def permutation_z(counts: DataFrame, label: str) -> DataFrame:
    """One group's z by label of its proportion against random halves, in closed form: a half's count is hypergeometric."""
    w = W.partitionBy(F.lit(0))
    total = F.sum("n").over(w).cast("double")
    half = F.floor(total / 2)
    sd = F.sqrt(F.col("n") / total * (1 - F.col("n") / total) * (total - half) / (half * (total - 1)))
    return counts.select(label, (F.col("n") / total).alias("proportion"), F.lit(0.0).alias("z_score"), sd.alias("null_sd"))


def composition_tests(proportions: DataFrame, sample: str, condition: str, label: str, value: str = "proportion") -> DataFrame:
    """Tests each label's proportions over samples between conditions: Mann-Whitney for two, Kruskal-Wallis for more; adjusted over labels."""
    kinds = [r[0] for r in proportions.select(condition).distinct().limit(3).orderBy(condition).collect()]
    stats = proportions.groupBy(label).agg(F.bround(F.avg(value), 4).alias("proportion_mean"), F.bround(F.stddev_samp(value), 4).alias("proportion_std"))
    tests = mann_whitney(proportions, [label], condition, value, kinds[0]) if len(kinds) == 2 else kruskal(proportions, [label], condition, value)
    got = bh_adjust(stats.join(tests.select(label, "pval"), label), "pval", [label])
    return got.withColumn("significant", F.coalesce(F.col("padj") <= 0.05, F.lit(False)))


def enrichment(selected: DataFrame, sets: DataFrame, background: DataFrame, by: str) -> DataFrame:
    """Hypergeometric over-representation of gene sets among the selected genes of each label: overlap, gene_set_size,
    pval, genes (sorted, comma-joined), padj over all tests with overlap. selected: by, gene; sets: set_name, gene;
    background: gene."""
    sets = sets.join(background, "gene", "left_semi").distinct()
    selected = selected.select(by, "gene").distinct().join(background, "gene", "left_semi")
    m = background.agg(F.countDistinct("gene").alias("known"))
    sizes = sets.groupBy("set_name").agg(F.count("*").alias("n"))
    picks = selected.groupBy(by).agg(F.count("*").alias("picked"))
    hits = selected.join(sets, "gene").groupBy(by, "set_name").agg(F.count("*").alias("k"), F.array_join(F.array_sort(F.collect_set("gene")), ",").alias("genes"))
    t = hits.join(sizes, "set_name").join(picks, by).join(F.broadcast(m))
    logf = lambda x: _log_factorial(x.cast("double"))
    choose = lambda a, b: logf(a) - logf(b) - logf(a - b)
    top = F.least("n", "picked")
    # terms follow from the first by exact ratios, so only it needs log-factorials
    first = F.exp(choose(F.col("n"), F.col("k")) + choose(F.col("known") - F.col("n"), F.col("picked") - F.col("k")) - choose(F.col("known"), F.col("picked")))
    n, big_n, m_ = F.col("n"), F.col("picked"), F.col("known")
    fold = F.aggregate(
        F.sequence(F.col("k"), top),
        F.struct(first.alias("term"), F.lit(0.0).alias("total")),
        lambda a, i: F.struct((a["term"] * ((n - i) * (big_n - i)).cast("double") / ((i + 1) * (m_ - n - big_n + i + 1)).cast("double")).alias("term"), (a["total"] + a["term"]).alias("total")),
        lambda a: F.least(F.lit(1.0), a["total"]),
    )
    t = t.select(by, F.col("set_name").alias("term"), F.col("k").alias("overlap"), F.col("n").alias("gene_set_size"), fold.alias("pval"), "genes")
    return bh_adjust(t, "pval", [by, "term"])


#: Lanczos coefficients for g = 7 (public numerical-methods formula).
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def _log_factorial(x: Column) -> Column:
    """ln x! for x >= 0."""
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (x + i)
    t = x + 7.5
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * F.log(t) - t + F.log(series)


def _pairs2(n: Column) -> Column:
    return n.cast("double") * (n - 1) / 2


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Sums over pairs: nij, ai, bj and n(n-1)/2 of the contingency table, one row."""
    n = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n"))
    each = n.agg(F.sum(_pairs2(F.col("n"))).alias("sij"), F.sum("n").alias("total"))
    left = n.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(_pairs2(F.col("n"))).alias("si"))
    right = n.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(_pairs2(F.col("n"))).alias("sj"))
    return each.join(left).join(right).withColumn("sn", _pairs2(F.col("total")))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row; null without common cells; 1 where both labelings are trivial."""
    s, i, j, n = (F.col(c) for c in ("sij", "si", "sj", "sn"))
    expect = i * j / n
    ari = F.when(F.col("total").isNull(), None).when(n == 0, 1.0).otherwise(F.coalesce(F.try_divide(s - expect, (i + j) / 2 - expect), F.lit(1.0)))
    return contingency(df, a, b).select(ari.alias("ari"))


def pairwise_f1(df: DataFrame, a: str, b: str) -> DataFrame:
    """Precision, recall and F1 over pairs of cells; b is the prediction; 1 for fewer than three cells."""
    few = F.coalesce(F.col("total"), F.lit(0)) < 3
    p, r = F.try_divide("sij", "sj"), F.try_divide("sij", "si")
    z = lambda x: F.when(few, 1.0).otherwise(F.coalesce(x, F.lit(0.0)))
    return contingency(df, a, b).select(z(p).alias("precision"), z(r).alias("recall"), z(F.try_divide(2 * p * r, p + r)).alias("f1"))


def marker_f1(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean over the labels of a (label, gene) of the best F1 of its genes against any label of b."""
    na, nb = a.groupBy("label").agg(F.count("*").alias("na")), b.groupBy("label").agg(F.count("*").alias("nb")).withColumnRenamed("label", "other")
    hit = a.join(b.withColumnRenamed("label", "other"), "gene").groupBy("label", "other").agg(F.count("*").alias("k"))
    best = hit.join(na, "label").join(nb, "other").groupBy("label").agg(F.max(2.0 * F.col("k") / (F.col("na") + F.col("nb"))).alias("f1"))
    return na.join(best, "label", "left").agg(F.avg(F.coalesce("f1", F.lit(0.0))).alias("marker_f1"))


def pearson_with_cells(expr: DataFrame, cells: DataFrame, t: str) -> DataFrame:
    """Correlation of each gene with a finite cell value, over all such cells, zeros included; 0 without variance."""
    c = cells.where(F.col(t).isNotNull()).select("cell_id", F.col(t).alias("t"))
    total = c.agg(F.count("*").cast("double").alias("n"), F.sum("t").alias("st"), F.sum(F.col("t") * F.col("t")).alias("stt"))
    g = expr.join(c, "cell_id").groupBy("gene_id").agg(F.sum("value").alias("sv"), F.sum(F.col("value") * F.col("value")).alias("svv"), F.sum(F.col("value") * F.col("t")).alias("svt"))
    g = g.join(F.broadcast(total))
    n = F.col("n")
    vv, tt = n * F.col("svv") - F.col("sv") * F.col("sv"), n * F.col("stt") - F.col("st") * F.col("st")
    r = F.coalesce(F.try_divide(n * F.col("svt") - F.col("sv") * F.col("st"), F.sqrt(F.greatest(vv, F.lit(0.0))) * F.sqrt(tt)), F.lit(0.0))
    return g.select("gene_id", r.alias("corr"), (vv / (n * n)).alias("variance"))


def correlation_matrix(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Long Pearson matrix, one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = wide.agg(*[F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    items = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("corr")) for k, (a, b) in enumerate(pairs)])
    return row.select(F.inline(items))
