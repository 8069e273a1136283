"""Aggregations by group: statistics, composition, majority, pseudobulk, profiles, histograms, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """count, mean, median, std (ddof 1), min, max, sem; nulls and NaN do not count."""
    v = F.when(~F.isnan(value), F.col(value))
    return df.groupBy(by).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")).withColumn("sem", F.col("std") / F.sqrt(F.greatest(F.col("count"), F.lit(1))))


def means(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns])


def counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table."""
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def pivot_counts(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    return df.groupBy(a).pivot(b, values).count().na.fill(0)


def proportions(df: DataFrame, a: str, b: str) -> DataFrame:
    return counts(df, a, b).withColumn("proportion", F.col("n") / F.sum("n").over(W.partitionBy(a)))


def unpivot(wide: DataFrame, key: str, columns: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return wide.unpivot(key, columns, name, value)


def majority(df: DataFrame, by: str, label: str) -> DataFrame:
    """The most frequent label; of equally frequent ones the least. Counts first, so a large group needs no buffer."""
    n = df.where(F.col(label).isNotNull()).groupBy(by, label).agg(F.count("*").alias("n"))
    return n.groupBy(by).agg(F.min_by(F.col(label), F.struct(-F.col("n"), F.col(label))).alias("majority"))


def pseudobulk(expr: DataFrame, cells: DataFrame, sample: str, group: str, min_cells: int = 3) -> DataFrame:
    """Sum of each gene over the cells of each sample and group of at least min_cells cells; absent sums are 0 and not stored."""
    size = cells.groupBy(sample, group).agg(F.count("*").alias("n_cells")).where(F.col("n_cells") >= min_cells)
    return expr.join(cells.select("cell_id", sample, group), "cell_id").groupBy(sample, group, "gene_id").agg(F.sum("value").alias("value")).join(size, [sample, group])


def sums_by_label(expr: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Sum and number of stored positive values of each gene in each label."""
    return expr.join(labels.select("cell_id", label), "cell_id").groupBy(label, "gene_id").agg(F.sum("value").alias("total"), F.count_if(F.col("value") > 0).alias("expressed"))


def mean_by_label(expr: DataFrame, labels: DataFrame, label: str, min_cells: int = 5) -> DataFrame:
    """Mean over all cells of the label and percentage of expressing cells."""
    size = labels.groupBy(label).agg(F.count("*").alias("n_cells")).where(F.col("n_cells") >= min_cells)
    return sums_by_label(expr, labels, label).join(size, label).select(label, "gene_id", "n_cells", (F.col("total") / F.col("n_cells")).alias("mean"), (100.0 * F.col("expressed") / F.col("n_cells")).alias("pct"))


def metacells(expr: DataFrame, labels: DataFrame) -> DataFrame:
    """labels: cell_id, metacell, cell_type, cluster. Sums by metacell."""
    return expr.join(labels.select("cell_id", "metacell"), "cell_id").groupBy("metacell", "gene_id").agg(F.sum("value").alias("value"))


def metacell_summary(labels: DataFrame) -> DataFrame:
    size = labels.groupBy("metacell").agg(F.count("*").alias("n_cells"))
    kind = majority(labels, "metacell", "cell_type").withColumnRenamed("majority", "majority_cell_type")
    cluster = majority(labels, "metacell", "cluster").withColumnRenamed("majority", "majority_cluster")
    return size.join(kind, "metacell", "left").join(cluster, "metacell", "left")


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range; the last holds its right edge."""
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    x = df.select(value).where(F.col(value).isNotNull()).join(F.broadcast(span))
    k = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(F.col(value) - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0)) * bins)).cast("int")
    return x.groupBy(k.alias("bin")).agg(F.count("*").alias("n"))


def below_percentile(df: DataFrame, value: str, q: float) -> DataFrame:
    cut = df.agg(F.percentile(value, q).alias("cut"))
    return df.join(F.broadcast(cut)).where(F.col(value) < F.col("cut")).drop("cut")


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark limits groups before the shuffle."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def keep_first(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return top_k(df, by, order, 1).drop("rank")


def merge_lists(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Distinct keys of two ordered lists (key, ord), those of the first before those of the second."""
    both = first.select(key, F.lit(0).alias("part"), "ord").unionByName(second.select(key, F.lit(1).alias("part"), "ord"))
    return both.groupBy(key).agg(F.min(F.struct("part", "ord")).alias("at")).select(key, "at.part", "at.ord")


def mutation_summary(rows: DataFrame, gene: str, sample: str, kind: str, total: DataFrame) -> DataFrame:
    """Mutated samples, their rate in percent and the number of each type, most frequent first, as JSON."""
    kinds = rows.groupBy(gene, F.coalesce(kind, F.lit("Unknown")).alias("kind")).agg(F.count("*").alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "kind")))
    kinds = kinds.groupBy(gene).agg(order.alias("kinds"))
    text = F.concat(F.lit("{"), F.array_join(F.transform("kinds", lambda x: F.concat(F.lit('"'), x["kind"], F.lit('":'), (-x["k"]).cast("string"))), ","), F.lit("}"))
    some = F.array_join(F.transform(F.slice("kinds", 1, 3), lambda x: F.concat(x["kind"], F.lit("="), (-x["k"]).cast("string"))), ", ")
    n = rows.groupBy(gene).agg(F.countDistinct(sample).alias("mutated_samples")).join(F.broadcast(total))
    rate = F.coalesce(F.bround(F.try_divide(F.col("mutated_samples") * 100.0, F.col("total_samples")), 2), F.lit(0.0))
    return n.join(kinds, gene).select(gene, "total_samples", "mutated_samples", rate.alias("mutation_rate_pct"), text.alias("mutation_types"), some.alias("top_types"))


def first_column(df: DataFrame, candidates: list[str], several: bool = False) -> str | None:
    """The first of the candidates that is a column (and, if several, has more than one value)."""
    for c in candidates:
        if c in df.columns and (not several or df.select(c).distinct().limit(2).count() > 1):
            return c
    return None
