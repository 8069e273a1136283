"""Tables behind figures, comparison tables and perturbations."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytolake.functions.numeric import neg_log10, stars, student_two_sided
from cytolake.operators import ranking
from cytolake.operators.ordering import placed

#: DOIs as they stand in prose.
DOI = r"10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+"


def qc_stages(before: DataFrame, after: DataFrame) -> DataFrame:
    """QC metrics of both stages, with a stage column."""
    return before.withColumn("stage", F.lit("before")).unionByName(after.withColumn("stage", F.lit("after")))


def scatter(layout: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """id, x, y, value for a coloured embedding."""
    return layout.select("id", "x", "y").join(values.select("id", F.col(column).alias("value")), "id", "left")


def volcano(tests: DataFrame, alpha: float = 0.05, lfc: float = 0.25) -> DataFrame:
    """Adds neg_log10_padj and flag (up, down, ns)."""
    hit = (F.col("padj") < alpha) & (F.abs("lfc") > lfc)
    return tests.withColumns({"neg_log10_padj": neg_log10(F.col("padj")), "flag": F.when(hit & (F.col("lfc") > 0), "up").when(hit, "down").otherwise("ns")})


def heatmap(long: DataFrame, row: str, column: str, value: str, columns: list) -> DataFrame:
    return long.groupBy(row).pivot(column, columns).agg(F.first(value))


def dot_plot(profile: DataFrame, top: DataFrame, label: str) -> DataFrame:
    """Mean and percentage of the top genes of any label in every label."""
    return profile.join(top.select("gene_id").distinct(), "gene_id", "left_semi").select(label, "gene_id", "mean", "pct")


def boundaries(genes: DataFrame) -> DataFrame:
    """Place of the first gene of each chromosome in (chromosome, start, gene_id) order, after the first."""
    one = W.partitionBy(F.lit(0)).orderBy("chromosome", "start", "gene_id")  # as many rows as genes
    x = genes.select("gene_id", "chromosome", (F.row_number().over(one) - 1).cast("long").alias("place"), F.lag("chromosome").over(one).alias("was"))
    return x.where("was is not null and was <> chromosome").select("chromosome", "place")


def every_kth(df: DataFrame, key: str, target: int = 500) -> DataFrame:
    """Every floor(n / target)-th row by key; all rows of small tables. Keys are distinct."""
    step = max(1, df.count() // target)
    return placed(df, [key], "sr").where(F.col("sr") % step == 0).drop("sr")


def gene_trends(expr: DataFrame, cells: DataFrame, genes: DataFrame, size: int = 50, chunk: int = 4096) -> DataFrame:
    """gene_id, pt, cell_id, smoothed: each gene's values along pseudotime, zeros included; window min(size, n // 5 or 1), mirrored
    ends. Cells get their places once; a gene's row is cut into chunks, which take along the rows that their windows reach."""
    n = cells.count()
    window = max(1, min(size, n // 5 or 1))
    before, after = window // 2, window - window // 2 - 1
    listed = genes.agg(F.collect_list("gene_id").alias("gs"))  # a few dozen genes
    grid = placed(cells.select("cell_id", "pt"), ["pt", "cell_id"]).join(F.broadcast(listed)).select("cell_id", "pt", "place", F.explode("gs").alias("gene_id"))
    x = grid.join(expr.select("cell_id", "gene_id", "value"), ["cell_id", "gene_id"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    place = F.col("place")
    x = x.withColumn("p", F.explode(F.filter(F.array(place, -1 - place, 2 * n - 1 - place), lambda p: (p >= -before) & (p < n + after))))
    first, last = F.floor(F.greatest(F.col("p") - after, F.lit(0)) / chunk), F.floor(F.least(F.col("p") + before, F.lit(n - 1)) / chunk)
    x = x.withColumn("chunk", F.explode(F.sequence(first, last)))
    mean = F.avg("value").over(W.partitionBy("gene_id", "chunk").orderBy("p").rowsBetween(-before, after))
    return x.withColumn("smoothed", mean).where((F.col("p") == place) & (F.floor(place / chunk) == F.col("chunk"))).select("gene_id", "pt", "cell_id", "smoothed")


def density(values: DataFrame, by: str, value: str, points: int = 200) -> DataFrame:
    """by, x, density: Gaussian kernel density of each group (bandwidth by Scott's rule) on a grid over the whole range."""
    span = values.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    g = values.groupBy(by).agg(F.count(value).alias("n"), F.stddev_samp(value).alias("sd")).where("n > 1 and sd > 0")
    x = values.where(F.col(value).isNotNull()).join(g, by).join(F.broadcast(span))
    x = x.select(by, F.col(value).alias("v"), (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h"), "n", F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("lo") + i * (F.col("hi") - F.col("lo")) / (points - 1))).alias("x"))
    z = (F.col("x") - F.col("v")) / F.col("h")
    return x.groupBy(by, "x").agg((F.sum(F.exp(-0.5 * z * z) / F.col("h")) / F.first("n") / math.sqrt(2 * math.pi)).alias("density"))


def absolute_ranking(long: DataFrame, term: str, value: str, k: int = 15) -> DataFrame:
    """The k terms of largest absolute mean."""
    return long.groupBy(term).agg(F.abs(F.avg(value)).alias("strength")).orderBy(F.desc(F.round("strength", 9)), term).limit(k)


def comparison(df: DataFrame, group: str, value: str) -> DataFrame:
    """metric rows: Kruskal-Wallis over all groups, and the group of least mean against each other one, with q values and stars."""
    x = df.select(F.lit("all").alias("family"), F.col(group).alias("g"), F.col(value).alias("v"))
    ref = x.groupBy("g").agg(F.avg("v").alias("m")).agg(F.min_by("g", F.struct(F.round("m", 9), "g")).alias("ref"))
    top = ranking.kruskal(x, ["family"], "g", "v").select(F.lit("kruskal").alias("comparison"), F.lit(None).cast("string").alias("cluster"), F.col("pval").alias("p_value"), F.col("pval").alias("q_value"))
    name = ref.first().ref
    rest = x.where(F.col("g") != name).select("g").distinct()
    pair = x.join(rest.withColumnRenamed("g", "other"), (F.col("g") == F.col("other")) | (F.col("g") == F.lit(name)))
    tests = ranking.bh_adjust(ranking.mann_whitney(pair, ["other"], "g", "v", name), "pval", ["other"])
    each = tests.select(F.lit(f"{name} vs other").alias("comparison"), F.col("other").cast("string").alias("cluster"), F.col("pval").alias("p_value"), F.col("padj").alias("q_value"))
    return top.unionByName(each).withColumn("star", stars(F.col("q_value")))


def project_layer(layer: DataFrame, genes: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Values of a layer keyed by symbol, on the full gene index; unmatched symbols drop out, missing ones are 0 and not stored."""
    return layer.join(genes.select("gene_id", symbol), symbol).select("cell_id", "gene_id", "value")


def dropout(expr: DataFrame, share: float = 0.9, salt: int = 0) -> DataFrame:
    """Keeps 1 - share of the stored values, by a hash of cell and gene; the same ones on every run."""
    return expr.where(F.pmod(F.xxhash64("cell_id", "gene_id", F.lit(salt)), F.lit(10_000)) >= int(share * 10_000))


def subsample(cells: DataFrame, n: int, salt: str = "") -> DataFrame:
    """n cells by md5 of the key."""
    return cells.orderBy(F.md5(F.concat(F.col("cell_id").cast("string"), F.lit(salt))), "cell_id").limit(n)


def without_nan(expr: DataFrame) -> DataFrame:
    """NaN as 0, which is not stored."""
    return expr.withColumn("value", F.nanvl("value", F.lit(0.0))).where("value <> 0")


def dois(df: DataFrame, text: str) -> DataFrame:
    """Adds dois, all DOIs of a text in order, without full stops at their ends."""
    return df.withColumn("dois", F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({DOI})"), 1), lambda d: F.regexp_replace(d, r"[.,;)]+$", "")))


def confidence95(values: list[float]) -> tuple[float, float, float]:
    """Mean and 95 % Student interval of repeated measurements."""
    x = np.asarray(values, float)
    if len(x) < 2:
        return float(x.mean()), float("nan"), float("nan")
    lo, hi = 0.0, 1e3
    for _ in range(200):  # the two-sided 5 % point
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if student_two_sided(mid, len(x) - 1) > 0.05 else (lo, mid)
    half = hi * x.std(ddof=1) / math.sqrt(len(x))
    return float(x.mean()), float(x.mean() - half), float(x.mean() + half)


def one_sample_t(values: list[float], mean: float = 0.0) -> tuple[float, float]:
    x = np.asarray(values, float) - mean
    sd = x.std(ddof=1)
    t = x.mean() / (sd / math.sqrt(len(x))) if sd > 0 else math.copysign(float("inf"), x.mean()) if x.mean() else 0.0
    return float(t), (student_two_sided(t, len(x) - 1) if math.isfinite(t) else 0.0)


def signed_rank(a: list[float], b: list[float]) -> tuple[float, float]:
    """Wilcoxon's paired test; exact for up to 20 untied differences, else normal."""
    d = np.asarray(a, float) - np.asarray(b, float)
    d = d[d != 0]
    n = len(d)
    if not n:
        return 0.0, 1.0
    size = np.abs(d)
    order = np.argsort(size, kind="stable")
    rank = np.empty(n)
    rank[order] = np.arange(1, n + 1)
    for v in np.unique(size):
        rank[size == v] = rank[size == v].mean()
    w = min(rank[d > 0].sum(), rank[d < 0].sum())
    if n <= 20 and len(np.unique(size)) == n:
        ways = np.zeros(n * (n + 1) // 2 + 1)
        ways[0] = 1
        for i in range(1, n + 1):
            ways[i:] = ways[i:] + ways[:-i]
        return float(w), float(min(1.0, 2 * ways[: int(w) + 1].sum() / 2**n))
    _, t = np.unique(size, return_counts=True)
    sd = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - (t**3 - t).sum() / 48)
    z = (w - n * (n + 1) / 4) / sd
    return float(w), min(1.0, math.erfc(abs(z) / math.sqrt(2)))
