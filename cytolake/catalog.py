"""Registered queries of the single-cell engine over the relational test tables, and their DuckDB twins.

Every floating column is rounded to six digits on both sides and every computed column has one name on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytolake import binding as B
from cytolake.functions import numeric as N
from cytolake.operators import cnv, embedding, groups, matrix, neighbors, ranking, reads, scoring, views
from cytolake.sources import gtf
from cytolake.sources.shared import written

FLAGSHIP = "pseudo_velocity_per_cluster"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: bool = True):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (f"WITH {B.SQL.strip()},\n{sql.strip()[5:]}" if sql.strip().startswith("WITH ") else f"WITH {B.SQL.strip()}\n{sql.strip()}") if views else sql.strip()
        return f

    return add


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# -- quality control and normalisation


def _metrics(s, d):
    flags = B.genes(s, d).select("gene_id", F.col("chromosome").startswith("Brand#1").alias("mt"))
    return matrix.qc_metrics(B.expr(s, d), flags, ["mt"])


METRICS_SQL = """metrics AS (SELECT cell_id, count(*) FILTER (value > 0) AS n_genes_by_counts, sum(value) AS total_counts,
  100 * sum(CASE WHEN chromosome LIKE 'Brand#1%' THEN value ELSE 0 END) / sum(value) AS pct_counts_mt FROM expr LEFT JOIN genes USING (gene_id) GROUP BY 1)"""


@query(f"WITH {METRICS_SQL} SELECT cell_id, n_genes_by_counts, total_counts, round(pct_counts_mt, 6) AS pct_counts_mt FROM metrics")
def qc_cell_metrics(s, d):
    return r6(_metrics(s, d), "pct_counts_mt")


@query(f"""WITH {METRICS_SQL} SELECT cell_id, n_genes_by_counts, total_counts, round(pct_counts_mt, 6) AS pct_counts_mt FROM metrics
WHERE n_genes_by_counts BETWEEN 20 AND 60 AND total_counts BETWEEN 500 AND 2000 AND pct_counts_mt <= 50""")
def qc_filter_cells(s, d):
    return r6(_metrics(s, d).where(matrix.qc_pass(matrix.QCLimits(20, 60, 500, 2000, 50), "pct_counts_mt")), "pct_counts_mt")


@query(f"WITH {METRICS_SQL} SELECT cell_id FROM metrics WHERE n_genes_by_counts > 35 AND pct_counts_mt < 45")
def qc_standard_preset(s, d):
    return _metrics(s, d).where(matrix.standard_pass("pct_counts_mt", 35, 45)).select("cell_id")


@query("SELECT gene_id, count(*) AS n_cells FROM expr WHERE value > 0 GROUP BY 1 HAVING count(*) >= 28")
def filter_genes_min_cells(s, d):
    return matrix.filter_genes(B.expr(s, d), 28)


@query("SELECT cell_id, gene_id, round(value, 6) AS value FROM norm")
def normalize_log1p(s, d):
    return r6(matrix.normalize(B.expr(s, d)), "value")


MOMENTS_SQL = """moments AS (SELECT gene_id, n, sum(value) / n AS mean, greatest(0, (sum(value * value) - n * (sum(value) / n) * (sum(value) / n)) / (n - 1)) AS var FROM {src}, ncells GROUP BY gene_id, n)"""


@query(f"""WITH {MOMENTS_SQL.format(src='norm')}
SELECT cell_id, gene_id, round(least(10, value / CASE WHEN var > 0 THEN sqrt(var) ELSE 1 END), 6) AS value FROM norm JOIN moments USING (gene_id)""")
def scale_clip(s, d):
    x = matrix.normalize(B.expr(s, d))
    return r6(matrix.scale(x, matrix.gene_moments(x, matrix.count_cells(B.cells(s, d)))), "value")


@query(f"""WITH counts AS (SELECT cell_id, gene_id, exp(value) - 1 AS value FROM norm), {MOMENTS_SQL.format(src='counts')},
g AS (SELECT gene_id, ln(1 + mean) AS mean, ln(nullif(var / nullif(mean, 0), 0)) AS dispersion FROM moments),
b AS (SELECT *, least(19, floor((mean - (SELECT min(mean) FROM g)) / ((SELECT max(mean) FROM g) - (SELECT min(mean) FROM g)) * 20))::INT AS bin FROM g),
z AS (SELECT *, CASE WHEN count(dispersion) OVER w = 1 THEN 1.0 ELSE (dispersion - avg(dispersion) OVER w) / nullif(stddev_samp(dispersion) OVER w, 0) END AS z FROM b WINDOW w AS (PARTITION BY bin))
SELECT gene_id, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, bin, round(z, 6) AS z FROM z WHERE dispersion IS NOT NULL AND z IS NOT NULL ORDER BY round(z, 9) DESC, gene_id LIMIT 200""")
def hvg_dispersion_topn(s, d):
    return r6(matrix.highly_variable(matrix.normalize(B.expr(s, d)), matrix.count_cells(B.cells(s, d)), 200), "mean", "dispersion", "z")


@query("""WITH x AS (SELECT gene_id, set_name AS symbol FROM genes), n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY gene_id) AS rn FROM x)
SELECT gene_id, CASE WHEN rn = 1 THEN symbol ELSE symbol || '-' || (rn - 1) END AS symbol FROM n""")
def unique_symbols(s, d):
    return matrix.unique_symbols(B.genes(s, d).select("gene_id", F.col("set_name").alias("symbol")))


# -- groups


@query("SELECT cluster, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(pt), 6) AS pt FROM layout GROUP BY 1")
def cluster_mean_scores(s, d):
    return r6(groups.means(B.layout(s, d), "cluster", ["x", "y", "pt"]), "x", "y", "pt")


@query("""SELECT cluster, count(pt) AS count, round(avg(pt), 6) AS mean, round(quantile_cont(pt, 0.5), 6) AS median, round(stddev_samp(pt), 6) AS std,
round(min(pt), 6) AS min, round(max(pt), 6) AS max, round(stddev_samp(pt) / sqrt(greatest(count(pt), 1)), 6) AS sem FROM layout GROUP BY 1""")
def cluster_stats(s, d):
    return r6(groups.stats(B.layout(s, d), "cluster", "pt"), "mean", "median", "std", "min", "max", "sem")


@query("SELECT sample, cell_type, count(*) AS n FROM cells GROUP BY 1, 2")
def composition_counts(s, d):
    return groups.counts(B.cells(s, d), "sample", "cell_type")


@query("SELECT sample, cell_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY sample), 6) AS proportion FROM cells GROUP BY 1, 2")
def composition_proportions(s, d):
    return r6(groups.proportions(B.cells(s, d), "sample", "cell_type"), "proportion")


KINDS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"""SELECT a.sample, k AS cell_type, count(c.cell_id) AS n FROM (SELECT DISTINCT sample FROM cells) a CROSS JOIN (SELECT unnest({KINDS!r}) AS k)
LEFT JOIN cells c ON c.sample = a.sample AND c.cell_type = k GROUP BY 1, 2""")
def composition_unpivot(s, d):
    return groups.unpivot(groups.pivot_counts(B.cells(s, d), "sample", "cell_type", KINDS), "sample", KINDS, "cell_type", "n")


@query("""WITH n AS (SELECT sample, cell_type, count(*) AS n FROM cells GROUP BY 1, 2)
SELECT sample, cell_type AS majority FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n DESC, cell_type) AS rn FROM n) WHERE rn = 1""")
def majority_label(s, d):
    return groups.majority(B.cells(s, d), "sample", "cell_type")


SIZE_SQL = "size AS (SELECT sample, cell_type, count(*) AS n_cells FROM cells GROUP BY 1, 2 HAVING count(*) >= 3)"


@query(f"WITH {SIZE_SQL} SELECT sample, cell_type, gene_id, sum(value) AS value, n_cells FROM expr JOIN cells USING (cell_id) JOIN size USING (sample, cell_type) GROUP BY ALL")
def pseudobulk_counts(s, d):
    return groups.pseudobulk(B.expr(s, d), B.cells(s, d), "sample", "cell_type")


def _z_sql(z):
    return N.two_sided_sql(z)


RANK_SQL = """{name}_r AS (SELECT *, rank() OVER (PARTITION BY gene_id ORDER BY value) + (count(*) OVER (PARTITION BY gene_id, value) - 1) / 2.0 AS r,
  count(*) OVER (PARTITION BY gene_id, value)::DOUBLE AS t FROM {src} WHERE value > 0)"""
BULK_SQL = f"""{SIZE_SQL}, bulk AS (SELECT sample, cell_type, gene_id, sum(value) AS value FROM expr JOIN cells USING (cell_id) JOIN size USING (sample, cell_type) GROUP BY ALL),
units AS (SELECT cell_type, count(DISTINCT sample)::DOUBLE AS nk FROM bulk GROUP BY 1), sz AS (SELECT * FROM (SELECT *, (SELECT sum(nk) FROM units) AS n FROM units) WHERE nk >= 2 AND n - nk >= 2),
{RANK_SQL.format(name='bulk', src='bulk')},
each AS (SELECT gene_id, cell_type, sum(r) AS r, count(*) AS nnz, sum(value) AS s FROM bulk_r GROUP BY 1, 2),
gene AS (SELECT gene_id, count(*) AS all_nnz, sum(t * t - 1) AS ties, sum(value) AS all_s FROM bulk_r GROUP BY 1),
b AS (SELECT gene.*, sz.*, n - all_nnz AS z0, coalesce(r, 0) AS rr, coalesce(nnz, 0) AS k, coalesce(s, 0) AS ss FROM gene CROSS JOIN sz LEFT JOIN each USING (gene_id, cell_type)),
u AS (SELECT *, rr + k * z0 + (nk - k) * (z0 + 1) / 2 - nk * (nk + 1) / 2 AS u, 1 - (ties + z0 * z0 * z0 - z0) / (n * n * n - n) AS c FROM b),
z AS (SELECT *, coalesce(greatest(abs(u - nk * (n - nk) / 2) - 0.5, 0) / nullif(sqrt(c * nk * (n - nk) * (n + 1) / 12), 0), 0) AS z FROM u),
p AS (SELECT *, {_z_sql('z')} AS pval FROM z), k AS (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY pval, gene_id) AS rk, count(*) OVER (PARTITION BY cell_type) AS m FROM p)"""


@query(f"""WITH {BULK_SQL}
SELECT gene_id, cell_type, round(log2((ss / nk + 1) / ((all_s - ss) / (n - nk) + 1)), 6) AS log2fc, u, round(z, 6) AS z, round(pval, 6) AS pval,
round(least(1, min(pval * m / rk) OVER (PARTITION BY cell_type ORDER BY rk DESC)), 6) AS padj FROM k""")
def pseudobulk_ranktest(s, d):
    bulk = written(groups.pseudobulk(B.expr(s, d), B.cells(s, d), "sample", "cell_type"), "bulk")
    return r6(ranking.pseudobulk_contrasts(bulk, B.genes(s, d), "sample", "cell_type"), "log2fc", "z", "pval", "padj")


@query("""WITH n AS (SELECT cell_type, count(*) AS n_cells FROM cells GROUP BY 1 HAVING count(*) >= 5)
SELECT cell_type, gene_id, n_cells, round(sum(value) / n_cells, 6) AS mean, round(100.0 * count(*) FILTER (value > 0) / n_cells, 6) AS pct FROM norm JOIN cells USING (cell_id) JOIN n USING (cell_type) GROUP BY cell_type, gene_id, n_cells""")
def mean_expr_by_type(s, d):
    return r6(groups.mean_by_label(matrix.normalize(B.expr(s, d)), B.cells(s, d), "cell_type"), "mean", "pct")


@query("""WITH n AS (SELECT cell_type, count(*) AS n_cells FROM cells GROUP BY 1)
SELECT cell_type, gene_id, round_even(sum(value) / n_cells, 4) AS mean, round_even(100.0 * count(*) FILTER (value > 0) / n_cells, 2) AS pct
FROM norm JOIN cells USING (cell_id) JOIN n USING (cell_type) GROUP BY cell_type, gene_id, n_cells""")
def checkpoint_profile(s, d):
    got = groups.mean_by_label(matrix.normalize(B.expr(s, d)), B.cells(s, d), "cell_type", 0)
    return got.select("cell_type", "gene_id", F.bround("mean", 4).alias("mean"), F.bround("pct", 2).alias("pct"))


@query("""WITH n AS (SELECT cell_type, count(*) AS n_cells FROM cells GROUP BY 1),
m AS (SELECT cell_type, gene_id, sum(value) / n_cells AS mean FROM norm JOIN cells USING (cell_id) JOIN n USING (cell_type) GROUP BY cell_type, gene_id, n_cells),
pairs AS (SELECT gene_id AS ligand, gene_id + 100 AS receptor FROM genes)
SELECT ligand, receptor, l.cell_type AS source, r.cell_type AS target, round(l.mean, 6) AS ligand_expr, round(r.mean, 6) AS receptor_expr, round(l.mean * r.mean, 6) AS lr_score
FROM pairs JOIN m l ON l.gene_id = ligand JOIN m r ON r.gene_id = receptor WHERE l.mean * r.mean > 0""")
def lr_interactions(s, d):
    pairs = B.genes(s, d).select(F.col("gene_id").alias("ligand"), (F.col("gene_id") + 100).alias("receptor"))
    means = written(groups.mean_by_label(matrix.normalize(B.expr(s, d)), B.cells(s, d), "cell_type", 0).withColumnRenamed("gene_id", "gene"), "means")
    return r6(scoring.ligand_receptor(means, pairs, "cell_type"), "ligand_expr", "receptor_expr", "lr_score")


@query("SELECT least(49, floor((l_extendedprice - lo) / (hi - lo) * 50))::INT AS bin, count(*) AS n FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) GROUP BY 1", views=False)
def histogram_50(s, d):
    return groups.histogram(B.read(s, d, "lineitem"), "l_extendedprice", 50)


@query("SELECT cell_id, round(pt, 6) AS pt FROM ptime WHERE pt < (SELECT quantile_cont(pt, 0.99) FROM ptime)")
def percentile_mask(s, d):
    return r6(groups.below_percentile(B.pseudotime(s, d), "pt", 0.99), "pt")


@query("SELECT c_custkey FROM customer ANTI JOIN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000) o ON c_custkey = o_custkey", views=False)
def group_key_antijoin(s, d):
    big = B.read(s, d, "orders").where("o_totalprice > 300000")
    return B.read(s, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""WITH a AS (SELECT p_name AS gene, 0 AS part, p_partkey AS ord FROM part WHERE p_size <= 10), b AS (SELECT p_name AS gene, 1 AS part, p_partkey AS ord FROM part WHERE p_size BETWEEN 5 AND 20)
SELECT gene, (min((part, ord))).part AS part, (min((part, ord))).ord AS ord FROM (SELECT gene, part, ord, {'part': part, 'ord': ord} AS x FROM a UNION ALL SELECT gene, part, ord, {'part': part, 'ord': ord} FROM b) GROUP BY 1""".replace("(min((part, ord)))", "(min(x))"), views=False)
def gene_list_merge(s, d):
    part = B.read(s, d, "part").select(F.col("p_name").alias("gene"), "p_size", F.col("p_partkey").alias("ord"))
    return groups.merge_lists(part.where("p_size <= 10"), part.where("p_size between 5 and 20"), "gene")


@query("SELECT p_brand, p_type, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = 1", views=False)
def dedupe_keep_first(s, d):
    return groups.keep_first(B.read(s, d, "part"), ["p_brand", "p_type"], [F.desc("p_retailprice"), F.asc("p_partkey")]).select("p_brand", "p_type", "p_partkey", "p_name")


MUT_SQL = """n AS (SELECT user_id % 7 AS gene, coalesce(event_type, 'Unknown') AS kind, count(*) AS n FROM events GROUP BY 1, 2),
t AS (SELECT gene, string_agg('"' || kind || '":' || n, ',' ORDER BY n DESC, kind) AS types FROM n GROUP BY 1),
t3 AS (SELECT gene, string_agg(kind || '=' || n, ', ' ORDER BY n DESC, kind) AS top FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY n DESC, kind) AS rn FROM n) WHERE rn <= 3 GROUP BY 1),
m AS (SELECT user_id % 7 AS gene, count(DISTINCT user_id) AS mutated_samples FROM events WHERE json_extract(props, '$.k')::INT < 30 GROUP BY 1)"""


@query(f"""WITH ev AS (SELECT * FROM events WHERE json_extract(props, '$.k')::INT < 30), {MUT_SQL.replace('FROM events WHERE', 'FROM ev WHERE').replace('FROM events GROUP', 'FROM ev GROUP')},
tot AS (SELECT count(DISTINCT user_id) AS total_samples FROM events)
SELECT gene, total_samples, mutated_samples, round_even(mutated_samples * 100.0 / total_samples, 2)::DOUBLE AS mutation_rate_pct, '{{' || types || '}}' AS mutation_types, top AS top_types FROM m JOIN t USING (gene) JOIN t3 USING (gene), tot""", views=False)
def mutation_summary(s, d):
    ev = B.read(s, d, "events")
    rows = ev.where(F.get_json_object("props", "$.k").cast("int") < 30).withColumn("gene", F.col("user_id") % 7)
    return groups.mutation_summary(rows, "gene", "user_id", "event_type", ev.agg(F.countDistinct("user_id").alias("total_samples")))


@query("""WITH n AS (SELECT user_id, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, string_agg(kind || '=' || n, ', ' ORDER BY n DESC, kind) AS top FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, kind) AS rn FROM n) WHERE rn <= 3 GROUP BY 1""", views=False)
def top_types_text(s, d):
    n = B.read(s, d, "events").groupBy("user_id", F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))
    top = groups.top_k(n, ["user_id"], [F.desc("n"), F.asc("kind")], 3)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.concat("kind", F.lit("="), F.col("n").cast("string")).alias("t")))), lambda x: x["t"]), ", ")
    return top.groupBy("user_id").agg(text.alias("top"))


# -- tests


WILCOXON_SQL = f"""lab AS (SELECT cell_id, cell_type AS grp FROM cells), sz0 AS (SELECT grp, count(*)::DOUBLE AS nk FROM lab GROUP BY 1), sz AS (SELECT *, (SELECT sum(nk) FROM sz0) AS n FROM sz0),
src AS (SELECT norm.*, grp FROM norm JOIN lab USING (cell_id)), {RANK_SQL.format(name='w', src='src')},
each AS (SELECT gene_id, grp, sum(r) AS r, count(*) AS nnz, sum(exp(value) - 1) AS s FROM w_r GROUP BY 1, 2),
gene AS (SELECT gene_id, count(*) AS all_nnz, sum(t * t - 1) AS ties, sum(exp(value) - 1) AS all_s FROM w_r GROUP BY 1),
b AS (SELECT gene.*, sz.*, n - all_nnz AS z0, coalesce(r, 0) AS rr, coalesce(nnz, 0) AS k, coalesce(s, 0) AS ss FROM gene CROSS JOIN sz LEFT JOIN each USING (gene_id, grp)),
z AS (SELECT *, coalesce((rr + k * z0 + (nk - k) * (z0 + 1) / 2 - nk * (n + 1) / 2) / nullif(sqrt((1 - (ties + z0 * z0 * z0 - z0) / (n * n * n - n)) * nk * (n - nk) * (n + 1) / 12), 0), 0) AS score FROM b),
p AS (SELECT gene_id, grp, score, log2((ss / nk + 1e-9) / ((all_s - ss) / (n - nk) + 1e-9)) AS lfc, k / nk AS pct, (all_nnz - k) / (n - nk) AS pct_rest, {_z_sql('score')} AS pval FROM z),
q AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pval, gene_id) AS rk, count(*) OVER (PARTITION BY grp) AS m FROM p),
a AS (SELECT *, least(1, min(pval * m / rk) OVER (PARTITION BY grp ORDER BY rk DESC)) AS padj FROM q),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY round(score, 9) DESC, gene_id) AS rank FROM a) WHERE rank <= 300)"""


def _ranked(s, d):
    labels = B.cells(s, d).select("cell_id", F.col("cell_type").alias("grp"))
    return ranking.rank_genes(ranking.wilcoxon(matrix.normalize(B.expr(s, d)), labels, "grp"), "grp")


DE = ("score", "lfc", "pct", "pct_rest", "pval", "padj")
DE_SQL = "gene_id, grp, rank, " + ", ".join(f"round({c}, 6) AS {c}" for c in DE)


@query(f"WITH {WILCOXON_SQL} SELECT {DE_SQL} FROM ranked")
def rank_genes_wilcoxon(s, d):
    return r6(_ranked(s, d).withColumn("rank", F.col("rank").cast("long")), *DE)


@query("""WITH lab AS (SELECT cell_id, cell_type AS grp FROM cells), sz0 AS (SELECT grp, count(*)::DOUBLE AS nk FROM lab GROUP BY 1), sz AS (SELECT *, (SELECT sum(nk) FROM sz0) AS n FROM sz0),
each AS (SELECT gene_id, grp, sum(value) AS s, sum(value * value) AS ss FROM norm JOIN lab USING (cell_id) GROUP BY 1, 2), gene AS (SELECT gene_id, sum(value) AS a, sum(value * value) AS aa FROM norm GROUP BY 1),
b AS (SELECT gene_id, grp, nk AS n1, n - nk AS n2, coalesce(s, 0) / nk AS m1, (a - coalesce(s, 0)) / (n - nk) AS m2, coalesce(ss, 0) AS s1, aa - coalesce(ss, 0) AS s2 FROM gene CROSS JOIN sz LEFT JOIN each USING (gene_id, grp)),
v AS (SELECT *, greatest(0, (s1 - n1 * m1 * m1) / (n1 - 1)) / n1 AS x, greatest(0, (s2 - n2 * m2 * m2) / (n2 - 1)) / n2 AS y FROM b)
SELECT gene_id, grp, round(coalesce((m1 - m2) / nullif(sqrt(x + y), 0), 0), 6) AS score, round((x + y) * (x + y) / nullif(x * x / (n1 - 1) + y * y / (n2 - 1), 0), 4) AS df FROM v""")
def rank_genes_ttest(s, d):
    labels = B.cells(s, d).select("cell_id", F.col("cell_type").alias("grp"))
    return ranking.ttest(matrix.normalize(B.expr(s, d)), labels, "grp").select("gene_id", "grp", F.round("score", 6).alias("score"), F.round("df", 4).alias("df"))


@query(f"WITH {WILCOXON_SQL} SELECT {DE_SQL} FROM ranked WHERE round(padj, 9) < 0.9 AND abs(lfc) > 0.25")
def de_significant(s, d):
    return r6(ranking.significant(_ranked(s, d).withColumns({"padj": F.round("padj", 9), "rank": F.col("rank").cast("long")}), 0.9), *DE)


@query(f"WITH {WILCOXON_SQL} SELECT gene_id, grp, place FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY round(padj, 9), round(score, 9) DESC, gene_id) AS place FROM ranked) WHERE place <= 5")
def de_top5(s, d):
    top = groups.top_k(_ranked(s, d).drop("rank"), ["grp"], [F.round("padj", 9), F.desc(F.round("score", 9)), F.asc("gene_id")], 5)
    return top.select("gene_id", "grp", F.col("rank").cast("long").alias("place"))


@query("""WITH p AS (SELECT o_orderkey, o_orderpriority, ((o_orderkey * 7919) % 100003 + 1) / 100004.0::DOUBLE AS p FROM orders),
k AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY p, o_orderkey) AS rk, count(*) OVER (PARTITION BY o_orderpriority) AS m FROM p)
SELECT o_orderkey, o_orderpriority, round(p, 6) AS p, round(least(1, min(p * m / rk) OVER (PARTITION BY o_orderpriority ORDER BY rk DESC)), 6) AS padj FROM k""", views=False)
def bh_adjust(s, d):
    p = B.read(s, d, "orders").select("o_orderkey", "o_orderpriority", (((F.col("o_orderkey") * 7919) % 100003 + 1) / F.lit(100004.0)).alias("p"))
    return r6(ranking.bh_adjust(p, "p", ["o_orderkey"], ["o_orderpriority"]), "p", "padj")


@query("""WITH bg AS (SELECT DISTINCT p_partkey::VARCHAR AS gene FROM part), sets AS (SELECT DISTINCT p_type AS term, p_partkey::VARCHAR AS gene FROM part), sel AS (SELECT DISTINCT p_brand AS grp, p_partkey::VARCHAR AS gene FROM part WHERE p_size > 35),
sz AS (SELECT term, count(*) AS n FROM sets GROUP BY 1), pk AS (SELECT grp, count(*) AS big FROM sel GROUP BY 1), m AS (SELECT count(*) AS m FROM bg),
h AS (SELECT grp, term, count(*) AS k, string_agg(gene, ',' ORDER BY gene) AS genes FROM sel JOIN sets USING (gene) GROUP BY 1, 2),
t AS (SELECT grp, term, k AS overlap, n AS gene_set_size, genes, least(1, list_sum(list_transform(range(k, least(n, big) + 1), lambda i: exp(
  lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + lgamma(m - n + 1) - lgamma(big - i + 1) - lgamma(m - n - big + i + 1) - lgamma(m + 1) + lgamma(big + 1) + lgamma(m - big + 1))))) AS pval FROM h JOIN sz USING (term) JOIN pk USING (grp), m),
q AS (SELECT *, row_number() OVER (ORDER BY pval, grp, term) AS rk, count(*) OVER () AS c FROM t)
SELECT grp, term, overlap, gene_set_size, round(pval, 6) AS pval, genes, round(least(1, min(pval * c / rk) OVER (ORDER BY rk DESC)), 6) AS padj FROM q""", views=False)
def enrichment_hypergeom(s, d):
    part = B.read(s, d, "part").select(F.col("p_partkey").cast("string").alias("gene"), F.col("p_type").alias("set_name"), F.col("p_brand").alias("grp"), "p_size")
    return r6(ranking.enrichment(part.where("p_size > 35"), part.select("set_name", "gene"), part.select("gene"), "grp"), "pval", "padj")


CORR_SQL = """c AS (SELECT count(*)::DOUBLE AS n, sum(pt) AS st, sum(pt * pt) AS stt FROM ptime),
g AS (SELECT gene_id, sum(value) AS sv, sum(value * value) AS svv, sum(value * pt) AS svt FROM norm JOIN ptime USING (cell_id) GROUP BY 1),
cor AS (SELECT gene_id, coalesce((n * svt - sv * st) / nullif(sqrt(greatest(n * svv - sv * sv, 0)) * sqrt(n * stt - st * st), 0), 0) AS corr FROM g, c)"""


@query(f"WITH {CORR_SQL} SELECT gene_id, round(corr, 6) AS corr FROM cor ORDER BY round(abs(corr), 9) DESC, gene_id LIMIT 30")
def gene_pseudotime_corr(s, d):
    got = ranking.pearson_with_cells(matrix.normalize(B.expr(s, d)), B.pseudotime(s, d), "pt")
    return got.orderBy(F.desc(F.round(F.abs("corr"), 9)), "gene_id").limit(30).select("gene_id", F.round("corr", 6).alias("corr"))


# -- scores


SCORE_SQL = """sets AS (SELECT DISTINCT set_name, gene_id FROM genes),
gm AS (SELECT g.gene_id, symbol, coalesce(sum(value), 0) AS s FROM genes g LEFT JOIN norm USING (gene_id) GROUP BY 1, 2),
gb AS (SELECT gene_id, symbol, floor((row_number() OVER (ORDER BY round(s, 6), gene_id) - 1) * 25 / count(*) OVER ())::INT AS bin FROM gm),
hit AS (SELECT DISTINCT set_name, bin FROM sets JOIN gb USING (gene_id)),
pool AS (SELECT h.set_name, h.bin, gb.gene_id, symbol FROM hit h JOIN gb USING (bin) ANTI JOIN sets ON sets.set_name = h.set_name AND sets.gene_id = gb.gene_id),
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY set_name, bin ORDER BY md5(symbol), gene_id) AS k FROM pool) WHERE k <= 50),
wt AS (SELECT set_name, gene_id, 1.0 / count(*) OVER (PARTITION BY set_name) AS w FROM sets UNION ALL SELECT set_name, gene_id, -1.0 / count(*) OVER (PARTITION BY set_name) FROM pick),
got AS (SELECT cell_id, set_name, sum(value * w::DOUBLE) AS score FROM norm JOIN wt USING (gene_id) GROUP BY 1, 2),
names AS (SELECT DISTINCT set_name FROM sets), scores AS (SELECT cell_id, n.set_name, coalesce(got.score, 0) AS score FROM (SELECT cell_id FROM cells) cells CROSS JOIN names n LEFT JOIN got USING (cell_id, set_name)),
pl AS (SELECT set_name, row_number() OVER (ORDER BY set_name) AS place FROM names),
top AS (SELECT cell_id, set_name, round(score, 9) AS score, row_number() OVER (PARTITION BY cell_id ORDER BY round(score, 9) DESC, place) AS rk FROM scores JOIN pl USING (set_name)),
ann AS (SELECT a.cell_id, CASE WHEN a.score < 0.1 THEN 'Unknown' ELSE a.set_name END AS cell_type, a.set_name AS best_set, a.score AS best, a.score - b.score AS confidence FROM top a JOIN top b ON a.cell_id = b.cell_id AND b.rk = 2 WHERE a.rk = 1)"""


def _scores(s, d):
    sets = B.gene_sets(s, d).distinct()
    names = scoring.set_names(sets)
    return scoring.score_sets(matrix.normalize(B.expr(s, d)), sets, B.genes(s, d), B.cells(s, d), names), names


@query(f"WITH {SCORE_SQL} SELECT cell_id, set_name, round(score, 6) AS score FROM scores")
def score_gene_sets(s, d):
    return r6(_scores(s, d)[0], "score")


@query(f"WITH {SCORE_SQL} SELECT cell_id, cell_type, round(best, 6) AS best, round(confidence, 6) AS confidence FROM ann")
def annotate_cells(s, d):
    return r6(scoring.annotate(*_scores(s, d)), "best", "confidence")


@query(f"WITH {SCORE_SQL}, x AS (SELECT a.set_name AS a, b.set_name AS b, corr(a.score, b.score) AS corr FROM scores a JOIN scores b ON a.cell_id = b.cell_id AND a.set_name <= b.set_name GROUP BY 1, 2) SELECT a, b, round(corr, 6) AS corr FROM x")
def signature_correlation(s, d):
    scores, names = _scores(s, d)
    return r6(ranking.correlation_matrix(scoring.wide_scores(scores, names), names), "corr")


@query(f"""WITH {SCORE_SQL}, n AS (SELECT set_name, place FROM pl WHERE place <= 2), w AS (SELECT cell_id, max(score) FILTER (place = 1) AS s_score, max(score) FILTER (place = 2) AS g2m_score FROM scores JOIN n USING (set_name) GROUP BY 1)
SELECT cell_id, round(s_score, 6) AS s_score, round(g2m_score, 6) AS g2m_score, CASE WHEN round(s_score, 9) < 0 AND round(g2m_score, 9) < 0 THEN 'G1' WHEN round(g2m_score, 9) > round(s_score, 9) THEN 'G2M' ELSE 'S' END AS phase FROM w""")
def cell_cycle_phase(s, d):
    scores, names = _scores(s, d)
    return r6(scoring.phase(scores, names[0], names[1]), "s_score", "g2m_score")


@query(f"""WITH {SCORE_SQL} SELECT a.cell_id, c.cell_type AS parent, CASE WHEN c.cell_type NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'Non-immune' WHEN best < 0.05 THEN 'Immune_unassigned' ELSE best_set END AS immune_subtype, round(best, 6) AS best FROM ann a JOIN cells c USING (cell_id)""")
def immune_subtype(s, d):
    ann = scoring.annotate(*_scores(s, d), threshold=float("-inf"))
    return r6(scoring.immune_subtypes(ann, B.cells(s, d), ["BUILDING", "MACHINERY", "HOUSEHOLD"]), "best")


@query("""WITH w AS (SELECT c.cell_id, coalesce(max(value) FILTER (gene_id = 5), 0) AS a, coalesce(max(value) FILTER (gene_id = 6), 0) AS b FROM cells c LEFT JOIN norm USING (cell_id) GROUP BY 1)
SELECT cell_id, round(sqrt(greatest(a, 0) * greatest(b, 0)), 6) AS cyt FROM w""")
def cyt_score(s, d):
    x = matrix.normalize(B.expr(s, d)).where("gene_id in (5, 6)").groupBy("cell_id").agg(F.max(F.when(F.col("gene_id") == 5, F.col("value"))).alias("a"), F.max(F.when(F.col("gene_id") == 6, F.col("value"))).alias("b"))
    return B.cells(s, d).join(x, "cell_id", "left").select("cell_id", F.round(N.cyt(F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))), 6).alias("cyt"))


@query("""WITH wt AS (SELECT set_name AS regulator, gene_id, 1.0 AS w FROM genes), n AS (SELECT count(*)::DOUBLE AS n FROM genes),
c AS (SELECT cell_id, sum(value) AS sx, sum(value * value) AS sxx FROM norm GROUP BY 1), r AS (SELECT regulator, sum(w)::DOUBLE AS sw, sum(w * w)::DOUBLE AS sww FROM wt GROUP BY 1),
xw AS (SELECT cell_id, regulator, sum(value * w::DOUBLE) AS sxw FROM norm JOIN wt USING (gene_id) GROUP BY 1, 2),
b AS (SELECT cell_id, regulator, n, (n * coalesce(sxw, 0) - sx * sw) / (sqrt(n * sxx - sx * sx) * sqrt(n * sww - sw * sw)) AS rho FROM c CROSS JOIN r LEFT JOIN xw USING (cell_id, regulator), n)
SELECT cell_id, regulator, round(coalesce(rho * sqrt((n - 2) / (1 - rho * rho)), 0), 6) AS activity FROM b""")
def tf_activity(s, d):
    w = B.gene_sets(s, d).select(F.col("set_name").alias("regulator"), "gene_id", F.lit(1.0).alias("weight"))
    return r6(scoring.univariate_activity(matrix.normalize(B.expr(s, d)), w, B.read(s, d, "part").count()), "activity")


# -- copy number and clones


CNV_SQL = """gi AS (SELECT g.gene_id, chromosome, row_number() OVER (PARTITION BY chromosome ORDER BY start, g.gene_id) AS pos, count(*) OVER (PARTITION BY chromosome) AS n FROM genes g SEMI JOIN expr USING (gene_id)),
gmean AS (SELECT gene_id, sum(value) / (SELECT n FROM ncells) AS m FROM norm GROUP BY 1),
grid AS (SELECT c.cell_id, gi.*, coalesce(v.value, 0) - m AS v FROM cells c CROSS JOIN gi JOIN gmean USING (gene_id) LEFT JOIN norm v ON v.cell_id = c.cell_id AND v.gene_id = gi.gene_id),
run AS (SELECT *, sum(v) OVER (PARTITION BY cell_id, chromosome ORDER BY pos) AS cs, first(v) OVER w AS v1, last(v) OVER w AS vn, least(20, n) AS s FROM grid WINDOW w AS (PARTITION BY cell_id, chromosome ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
lo AS (SELECT a.cell_id, a.gene_id, a.n, a.v, (coalesce(h.cs, 0) - coalesce(l.cs, 0) + greatest(0, a.s // 2 - (a.pos - 1)) * a.v1 + greatest(0, (a.s - a.s // 2 - 1) - (a.n - a.pos)) * a.vn) / a.s AS sm
  FROM run a LEFT JOIN run h ON h.cell_id = a.cell_id AND h.chromosome = a.chromosome AND h.pos = least(a.n, a.pos + a.s - a.s // 2 - 1) LEFT JOIN run l ON l.cell_id = a.cell_id AND l.chromosome = a.chromosome AND l.pos = a.pos - a.s // 2 - 1),
cnv AS (SELECT cell_id, var_pop(CASE WHEN n < 3 THEN v ELSE sm END) AS cnv_score FROM lo GROUP BY 1)"""


def _cnv(s, d):
    return written(cnv.window_cnv(written(matrix.normalize(B.expr(s, d)), "lognorm"), B.cells(s, d), B.genes(s, d), 20, with_profile=False), "cnv")


@query(f"WITH {CNV_SQL} SELECT cell_id, round(cnv_score, 6) AS cnv_score FROM cnv")
def cnv_window_score(s, d):
    return r6(_cnv(s, d), "cnv_score")


@query(f"WITH {CNV_SQL} SELECT cell_id, CASE WHEN round(cnv_score, 12) > round((SELECT quantile_cont(cnv_score, 0.75) FROM cnv), 12) THEN 'Malignant' ELSE 'Normal' END AS cnv_class FROM cnv")
def cnv_classify(s, d):
    return cnv.classify(_cnv(s, d)).select("cell_id", "cnv_class")


CLONE_SQL = f"""{CNV_SQL}, cut AS (SELECT quantile_cont(cnv_score, 0.33) AS t1, quantile_cont(cnv_score, 0.66) AS t2 FROM cnv),
clones AS (SELECT cell_id, cnv_score, 'Clone_' || (1 + (round(cnv_score, 12) >= round(t1, 12))::INT + (round(cnv_score, 12) >= round(t2, 12))::INT) AS clone FROM cnv, cut)"""


@query(f"WITH {CLONE_SQL} SELECT cell_id, clone FROM clones")
def clone_quantile_bins(s, d):
    return cnv.score_clones(_cnv(s, d)).select("cell_id", "clone")


@query(f"""WITH {CLONE_SQL}, x AS (SELECT clones.*, pt, cell_type FROM clones LEFT JOIN ptime USING (cell_id) JOIN cells USING (cell_id)), k AS (SELECT clone, cell_type, count(*) AS n FROM x GROUP BY 1, 2),
dom AS (SELECT clone, cell_type AS dominant_cell_type FROM (SELECT *, row_number() OVER (PARTITION BY clone ORDER BY n DESC, cell_type) AS rn FROM k) WHERE rn = 1)
SELECT clone, count(*) AS n_cells, round(count(*) / (SELECT count(*) FROM x), 6) AS fraction, round(avg(cnv_score), 6) AS mean_cnv_score, round(avg(pt), 6) AS mean_pseudotime, round(quantile_cont(pt, 0.5), 6) AS median_pseudotime, any_value(dominant_cell_type) AS dominant_cell_type FROM x JOIN dom USING (clone) GROUP BY clone""")
def clone_stats(s, d):
    c = cnv.score_clones(_cnv(s, d)).join(B.pseudotime(s, d), "cell_id", "left").join(B.cells(s, d).select("cell_id", "cell_type"), "cell_id")
    return r6(cnv.clone_stats(c), "fraction", "mean_cnv_score", "mean_pseudotime", "median_pseudotime")


@query("""WITH x AS (SELECT gene_id, chromosome, start::DOUBLE AS v, row_number() OVER (PARTITION BY chromosome ORDER BY start, gene_id) AS i, count(*) OVER (PARTITION BY chromosome) AS n FROM (SELECT gene_id, chromosome, (start * 37) % 101 AS start FROM genes)),
w AS (SELECT chromosome, gene_id, i, n, least(11, n) AS s, unnest(range(i - least(11, n) // 2, i + least(11, n) - least(11, n) // 2)) AS j FROM x),
m AS (SELECT *, CASE WHEN j < 1 THEN 1 - j WHEN j > n THEN 2 * n + 1 - j ELSE j END AS t FROM w)
SELECT m.chromosome, m.gene_id, round(avg(x.v), 6) AS smoothed FROM m JOIN x ON x.chromosome = m.chromosome AND x.i = m.t GROUP BY 1, 2""")
def sliding_mean_reflect(s, d):
    g = B.genes(s, d).select("gene_id", "chromosome", ((F.col("start") * 37) % 101).alias("start"))
    return r6(cnv.sliding_mean(g, ["chromosome"], ["start", "gene_id"], "start", 11, "reflect"), "smoothed").select("chromosome", "gene_id", "smoothed")


# -- neighbours


def _vectors(s, d):
    return B.read(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("string").alias("label"))


KNN_SQL = """vec AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label::VARCHAR AS label FROM embeddings),
knn AS (SELECT * FROM (SELECT a.id, b.id AS nbr, list_distance(a.v, b.v) AS dist, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank FROM vec a JOIN vec b ON a.id <> b.id) WHERE rank <= 14)"""
KNN2_SQL = """knn AS (SELECT * FROM (SELECT a.cell_id AS id, b.cell_id AS nbr, (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) AS d2,
  row_number() OVER (PARTITION BY a.cell_id ORDER BY (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y), b.cell_id) AS rank FROM layout a JOIN layout b ON a.cell_id <> b.cell_id) WHERE rank <= 14),
vel AS (SELECT k.id, avg((b.x - a.x) * (b.pt - a.pt)) AS vx, avg((b.y - a.y) * (b.pt - a.pt)) AS vy FROM knn k JOIN layout a ON a.cell_id = k.id JOIN layout b ON b.cell_id = k.nbr GROUP BY 1)"""


@query(f"WITH {KNN_SQL} SELECT id, nbr, rank, round(dist, 6) AS dist FROM knn")
def knn_graph(s, d):
    return r6(neighbors.knn_blocks(_vectors(s, d).select("id", "vec"), 14).withColumn("rank", F.col("rank").cast("long")), "dist")


@query("""WITH vec AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, (label % 3)::VARCHAR AS batch FROM embeddings)
SELECT id, nbr, batch, rank, round(dist, 6) AS dist FROM (SELECT a.id, b.id AS nbr, b.batch, list_distance(a.v, b.v) AS dist, row_number() OVER (PARTITION BY a.id, b.batch ORDER BY list_distance(a.v, b.v), b.id) AS rank FROM vec a JOIN vec b ON a.id <> b.id) WHERE rank <= 3""")
def bbknn_graph(s, d):
    v = _vectors(s, d).select("id", "vec", (F.col("label").cast("int") % 3).cast("string").alias("batch"))
    return r6(neighbors.knn_by_batch(v, "batch", 3).withColumn("rank", F.col("rank").cast("long")), "dist")


def _points(s, d):
    return B.layout(s, d).withColumnRenamed("cell_id", "id")


@query(f"WITH {KNN2_SQL} SELECT id, round(vx, 6) AS vx, round(vy, 6) AS vy, round(sqrt(vx * vx + vy * vy), 6) AS speed FROM vel")
def pseudo_velocity(s, d):
    return r6(neighbors.pseudo_velocity(_points(s, d)), "vx", "vy", "speed")


@query(f"""WITH {KNN2_SQL}, sp AS (SELECT cluster, sqrt(vx * vx + vy * vy) AS speed FROM vel JOIN layout ON cell_id = id)
SELECT cluster, count(*) AS count, round(avg(speed), 6) AS mean, round(quantile_cont(speed, 0.5), 6) AS median, round(stddev_samp(speed), 6) AS std FROM sp GROUP BY 1""")
def pseudo_velocity_per_cluster(s, d):
    p = _points(s, d)
    got = groups.stats(neighbors.pseudo_velocity(p).join(p.select("id", "cluster"), "id"), "cluster", "speed").select("cluster", "count", "mean", "median", "std")
    return r6(got, "mean", "median", "std")


@query(f"WITH {KNN2_SQL}, r AS (SELECT greatest(max(x) - min(x), max(y) - min(y)) AS r FROM layout), m AS (SELECT quantile_cont(sqrt(vx * vx + vy * vy), 0.5) AS m FROM vel) SELECT round(CASE WHEN m < 1e-10 THEN 1 ELSE m / (r * 0.05) END, 6) AS scale FROM r, m")
def arrow_scale(s, d):
    p = _points(s, d)
    return r6(neighbors.arrow_scale(p, neighbors.pseudo_velocity(p)), "scale")


@query(f"""WITH {KNN2_SQL}, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM layout),
grid AS (SELECT i AS id, x0 - (x1 - x0) * 0.05 + (i % 40) * ((x1 - x0 + 2 * ((x1 - x0) * 0.05)) / 39) AS gx, y0 - (y1 - y0) * 0.05 + (i // 40) * ((y1 - y0 + 2 * ((y1 - y0) * 0.05)) / 39) AS gy FROM range(1600) t(i), b),
near AS (SELECT * FROM (SELECT g.id, l.cell_id, greatest(sqrt((l.x - gx) * (l.x - gx) + (l.y - gy) * (l.y - gy)), 1e-6) AS dist, row_number() OVER (PARTITION BY g.id ORDER BY (l.x - gx) * (l.x - gx) + (l.y - gy) * (l.y - gy), l.cell_id) AS rank FROM grid g CROSS JOIN layout l) WHERE rank <= 10),
f AS (SELECT near.id, sum(vx / dist) / sum(1 / dist) AS vx, sum(vy / dist) / sum(1 / dist) AS vy, min(dist) AS nearest FROM near JOIN vel ON vel.id = near.cell_id GROUP BY 1)
SELECT id, CASE WHEN nearest <= cut THEN round(vx, 6) END AS vx, CASE WHEN nearest <= cut THEN round(vy, 6) END AS vy, round(nearest, 6) AS nearest FROM f, (SELECT quantile_cont(nearest, 0.8) AS cut FROM f)""")
def grid_interpolation(s, d):
    p = _points(s, d)
    return r6(neighbors.interpolate_grid(p, neighbors.pseudo_velocity(p)), "vx", "vy", "nearest")


def _edges(s, d, k=14):
    return neighbors.knn_blocks(_vectors(s, d).select("id", "vec"), k).select(F.col("id").alias("src"), F.col("nbr").alias("dst"), F.exp(-F.col("dist")).alias("weight"))


@query(f"""WITH {KNN_SQL}, e AS (SELECT a.label AS la, b.label AS lb FROM knn JOIN vec a ON a.id = knn.id JOIN vec b ON b.id = knn.nbr), o AS (SELECT la, count(*) AS e FROM e GROUP BY 1), n AS (SELECT label, count(*) AS n FROM vec GROUP BY 1),
bt AS (SELECT least(la, lb) AS a, greatest(la, lb) AS b, count(*) AS edges FROM e WHERE la <> lb GROUP BY 1, 2)
SELECT a, b, edges, round(least(1, edges / ((oa.e * nb.n + ob.e * na.n)::DOUBLE / ((SELECT count(*) FROM vec) - 1))), 6) AS connectivity FROM bt JOIN o oa ON oa.la = a JOIN o ob ON ob.la = b JOIN n na ON na.label = a JOIN n nb ON nb.label = b""")
def paga_edges(s, d):
    return r6(neighbors.cluster_graph(_edges(s, d), _vectors(s, d).select("id", "label")), "connectivity")


FATE_SQL = f"""{KNN_SQL}, pts AS (SELECT vec_id AS id, label::VARCHAR AS label, embedding[3]::DOUBLE AS pt FROM embeddings), mp AS (SELECT label, avg(pt) AS m, count(*) AS n FROM pts GROUP BY 1),
term AS (SELECT label, m, n FROM mp WHERE round(m, 9) >= round((SELECT quantile_cont(m, 0.75) FROM mp), 9)), rw AS (SELECT id, sum(exp(-dist)) AS w FROM knn GROUP BY 1),
h AS (SELECT knn.id, label AS fate, sum(exp(-dist)) AS w FROM knn JOIN pts ON pts.id = knn.nbr SEMI JOIN term USING (label) GROUP BY 1, 2),
pr AS (SELECT p.id, t.label AS fate, coalesce(h.w / greatest(rw.w, 1e-10), 0) AS p FROM pts p CROSS JOIN term t LEFT JOIN h ON h.id = p.id AND h.fate = t.label LEFT JOIN rw ON rw.id = p.id)"""


def _fate_cells(s, d):
    return B.layout(s, d).select(F.col("cell_id").alias("id"), F.col("cluster").alias("label"), "pt")


@query(f"WITH {FATE_SQL} SELECT label AS cluster, round(m, 6) AS mean_pseudotime, n AS n_cells FROM term")
def terminal_states(s, d):
    return r6(neighbors.terminal_clusters(_fate_cells(s, d)), "mean_pseudotime")


@query(f"WITH {FATE_SQL} SELECT id, fate, round(p / greatest(sum(p) OVER (PARTITION BY id), 1e-10), 6) AS probability FROM pr")
def fate_probabilities(s, d):
    return r6(neighbors.fate_probabilities(_edges(s, d), _fate_cells(s, d)), "probability")


@query("""WITH vec AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label::VARCHAR AS label FROM embeddings), c AS (SELECT label, list(m ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM vec) GROUP BY 1, 2) GROUP BY 1),
q AS (SELECT id, c.label, round(list_sum(list_transform(list_zip(v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) AS d2 FROM vec CROSS JOIN c)
SELECT id, label, round(sqrt(d2), 6) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, label) AS rn FROM q) WHERE rn = 1""")
def nearest_centroid(s, d):
    v = _vectors(s, d)
    return r6(neighbors.nearest_centroid(v.select("id", "vec"), v.select("id", "label")), "dist")


@query(f"""WITH {KNN_SQL}, k2 AS (SELECT a.cell_id AS id, b.cell_id AS nbr, row_number() OVER (PARTITION BY a.cell_id ORDER BY (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y), b.cell_id) AS rank, b.pt - a.pt AS w FROM layout a JOIN layout b ON a.cell_id <> b.cell_id),
p AS (SELECT (b.pt - a.pt) * k2.w AS p FROM knn JOIN k2 ON k2.id = knn.id AND k2.nbr = knn.nbr AND k2.rank <= 60 JOIN layout a ON a.cell_id = knn.id JOIN layout b ON b.cell_id = knn.nbr)
SELECT round(sum(CASE WHEN p > 0 THEN abs(p) ELSE 0 END) / nullif(sum(abs(p)), 0), 6) AS consistency FROM p""")
def direction_consistency(s, d):
    pt = _fate_cells(s, d).select("id", "pt")
    signed = lambda e: e.join(pt.select(F.col("id").alias("src"), F.col("pt").alias("a")), "src").join(pt.select(F.col("id").alias("dst"), F.col("pt").alias("b")), "dst").select("src", "dst", (F.col("b") - F.col("a")).alias("weight"))
    second = neighbors.knn_2d(_points(s, d).select("id", "x", "y"), 60).select(F.col("id").alias("src"), F.col("nbr").alias("dst"))
    return r6(neighbors.direction_consistency(signed(_edges(s, d)), signed(second)), "consistency")


# -- agreement


AGREE_SQL = """ct AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM labels GROUP BY 1, 2), s AS (SELECT sum(n * (n - 1) / 2.0)::DOUBLE AS sij, sum(n)::DOUBLE AS t FROM ct),
si AS (SELECT sum(n * (n - 1) / 2.0)::DOUBLE AS si FROM (SELECT sum(n) AS n FROM ct GROUP BY a)), sj AS (SELECT sum(n * (n - 1) / 2.0)::DOUBLE AS sj FROM (SELECT sum(n) AS n FROM ct GROUP BY b))"""


@query(f"WITH {AGREE_SQL.format(a='quality', b='toxic')} SELECT round((sij - si * sj / (t * (t - 1) / 2)) / ((si + sj) / 2 - si * sj / (t * (t - 1) / 2)), 6) AS ari FROM s, si, sj", views=False)
def adjusted_rand(s, d):
    return r6(ranking.adjusted_rand(B.read(s, d, "labels"), "quality", "toxic"), "ari")


@query(f"WITH {AGREE_SQL.format(a='quality', b='toxic')} SELECT round(sij / sj, 6) AS precision, round(sij / si, 6) AS recall, round(2 * (sij / sj) * (sij / si) / (sij / sj + sij / si), 6) AS f1 FROM s, si, sj", views=False)
def pairwise_f1(s, d):
    return r6(ranking.pairwise_f1(B.read(s, d, "labels"), "quality", "toxic"), "precision", "recall", "f1")


@query("""WITH a AS (SELECT p_brand AS label, p_type AS gene FROM part WHERE p_size <= 10 GROUP BY 1, 2), b AS (SELECT p_brand AS label, p_type AS gene FROM part WHERE p_size > 45 GROUP BY 1, 2),
na AS (SELECT label, count(*) AS n FROM a GROUP BY 1), nb AS (SELECT label, count(*) AS n FROM b GROUP BY 1), h AS (SELECT a.label, b.label AS other, count(*) AS k FROM a JOIN b USING (gene) GROUP BY 1, 2),
best AS (SELECT h.label, max(2.0 * k / (na.n + nb.n)) AS f FROM h JOIN na ON na.label = h.label JOIN nb ON nb.label = h.other GROUP BY 1) SELECT round(avg(coalesce(f, 0)), 6) AS marker_f1 FROM na LEFT JOIN best USING (label)""", views=False)
def marker_f1(s, d):
    part = B.read(s, d, "part")
    pick = lambda c: part.where(c).select(F.col("p_brand").alias("label"), F.col("p_type").alias("gene")).distinct()
    return r6(ranking.marker_f1(pick("p_size <= 10"), pick("p_size > 45")), "marker_f1")


# -- reads


READS_SQL = """reads AS (SELECT p_brand AS chrom, l_partkey AS gn, o_custkey AS cb, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) % 1500 AS st, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) % 1500 + l_quantity::BIGINT AS en, l_linenumber, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 5 AND l_returnflag <> 'R'),
ex AS (SELECT p_brand AS chrom, p_partkey AS gene, p_size * 10 + k * 450 AS s, p_size * 10 + k * 450 + 300 AS e FROM part, range(3) t(k)),
cls AS (SELECT r.*, l_linenumber = 1 OR EXISTS (SELECT 1 FROM ex WHERE ex.chrom = r.chrom AND ex.gene = r.gn AND r.st >= ex.s AND r.en <= ex.e) AS spliced FROM reads r)"""


def _classified(s, d):
    return reads.classify_reads(B.reads(s, d), B.exons(s, d))


@query(f"WITH {READS_SQL} SELECT chrom, spliced, count(*) AS n FROM cls GROUP BY 1, 2")
def splice_classify(s, d):
    return _classified(s, d).groupBy("chrom", "spliced").agg(F.count("*").alias("n"))


@query(f"WITH {READS_SQL} SELECT cb AS cell_id, gn AS gene_id, count(*) FILTER (spliced) AS spliced, count(*) FILTER (NOT spliced) AS unspliced FROM cls GROUP BY 1, 2")
def splice_matrix(s, d):
    return reads.layer_counts(_classified(s, d))


@query(f"""WITH {READS_SQL}, l AS (SELECT cb, gn, count(*) FILTER (spliced) AS s, count(*) FILTER (NOT spliced) AS u FROM cls GROUP BY 1, 2), g AS (SELECT gn AS gene_id, sum(s * u)::DOUBLE AS xy, sum(s * s)::DOUBLE AS xx, sum(s)::DOUBLE AS sx, sum(u)::DOUBLE AS sy FROM l GROUP BY 1),
o AS (SELECT *, CASE WHEN abs(n * xx - sx * sx) > 1e-9 THEN (n * xy - sx * sy) / (n * xx - sx * sx) ELSE 0 END AS slope FROM g, ncells)
SELECT gene_id, round(coalesce(xy / nullif(xx, 0), 0), 6) AS gamma, round((sy - slope * sx) / n, 6) AS "offset", round(slope, 6) AS slope FROM o""")
def velocity_steady_state(s, d):
    layers = written(reads.layer_counts(_classified(s, d)).select("cell_id", "gene_id", F.col("spliced").cast("double").alias("s"), F.col("unspliced").cast("double").alias("u")), "layers")
    with_offset = reads.gamma_offset(layers, "s", "u", float(B.cells(s, d).count())).withColumnRenamed("gamma", "slope")
    return r6(reads.gamma_origin(layers, "s", "u").join(with_offset, "gene_id"), "gamma", "offset", "slope")


#: A comment, an exon, its gene, an exon without a gene's name, and one of another contig, of each part.
GTF_SQL = r"""lines AS (SELECT unnest(['#!part ' || p_partkey, 'chr' || p_size || e'\tX\texon\t' || (p_partkey + 1) || e'\t' || (p_partkey + p_size) || e'\t.\t+\t.\tgene_id "g' || p_partkey || '"; gene_name "N' || p_partkey || '"; exon_number "1";',
  'chr' || p_size || e'\tX\tgene\t1\t9\t.\t+\t.\tgene_id "g' || p_partkey || '"; gene_name "N' || p_partkey || '";', e'chr2\tX\texon\t50\t90\t.\t-\t.\tgene_id "g' || p_partkey || '";', e'chrM\tX\texon\t5\t9\t.\t-\t.\tgene_name "M' || p_partkey || '"']) AS line FROM part)"""


@query(rf"""WITH {GTF_SQL}, f AS (SELECT string_split(line, e'\t') AS f FROM lines WHERE line NOT LIKE '#%'), x AS (SELECT f[1] AS chrom, regexp_extract(f[9], 'gene_name "([^"]*)"', 1) AS gene, f[4]::BIGINT - 1 AS start, f[5]::BIGINT AS "end" FROM f WHERE f[3] = 'exon')
SELECT * FROM x WHERE gene <> ''""", views=False)
def gtf_parse(s, d):
    part = B.read(s, d, "part")
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    end = (F.col("p_partkey") + F.col("p_size")).cast("string")
    lines = F.array(
        text("#!part ", key),
        text("chr", size, "\tX\texon\t", (F.col("p_partkey") + 1).cast("string"), "\t", end, '\t.\t+\t.\tgene_id "g', key, '"; gene_name "N', key, '"; exon_number "1";'),
        text("chr", size, '\tX\tgene\t1\t9\t.\t+\t.\tgene_id "g', key, '"; gene_name "N', key, '";'),
        text('chr2\tX\texon\t50\t90\t.\t-\t.\tgene_id "g', key, '";'),
        text('chrM\tX\texon\t5\t9\t.\t-\t.\tgene_name "M', key, '"'),
    )
    return gtf.exons_of_lines(part.select(F.explode(lines).alias("value")))


# -- tables behind figures


@query(f"""WITH {WILCOXON_SQL} SELECT gene_id, grp, round(lfc, 6) AS lfc, round(-log10(greatest(padj, 1e-300)), 4) AS neg_log10_padj,
CASE WHEN round(padj, 9) < 0.9 AND abs(lfc) > 0.25 THEN CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END ELSE 'ns' END AS flag FROM ranked""")
def volcano(s, d):
    x = _ranked(s, d)
    v = views.volcano(x.withColumn("padj", F.round("padj", 9)), 0.9).select("gene_id", "grp", "flag", F.round("lfc", 6).alias("lfc"))
    exact = views.volcano(x).select("gene_id", "grp", F.round("neg_log10_padj", 4).alias("neg_log10_padj"))
    return v.join(exact, ["gene_id", "grp"])


@query("""WITH x AS (SELECT gene_id, chromosome, row_number() OVER (ORDER BY chromosome, start, gene_id) - 1 AS place, lag(chromosome) OVER (ORDER BY chromosome, start, gene_id) AS was FROM genes) SELECT chromosome, place FROM x WHERE was <> chromosome""")
def chromosome_boundaries(s, d):
    return views.boundaries(B.genes(s, d))


@query("WITH x AS (SELECT cell_id, row_number() OVER (ORDER BY cell_id) - 1 AS r, count(*) OVER () AS n FROM cells) SELECT cell_id FROM x WHERE r % greatest(1, n // 500) = 0")
def arrow_sample(s, d):
    return views.every_kth(B.cells(s, d), "cell_id").select("cell_id")


@query(f"""WITH {CORR_SQL}, tg AS (SELECT gene_id FROM cor ORDER BY round(abs(corr), 9) DESC, gene_id LIMIT 30), w AS (SELECT greatest(1, least(50, CASE WHEN count(*) // 5 = 0 THEN 1 ELSE count(*) // 5 END)) AS s FROM ptime),
x AS (SELECT tg.gene_id, p.cell_id, coalesce(v.value, 0) AS v, row_number() OVER (PARTITION BY tg.gene_id ORDER BY p.pt, p.cell_id) AS i, count(*) OVER (PARTITION BY tg.gene_id) AS n FROM tg CROSS JOIN ptime p LEFT JOIN norm v ON v.cell_id = p.cell_id AND v.gene_id = tg.gene_id),
m AS (SELECT gene_id, cell_id, n, unnest(range(i - s // 2, i + s - s // 2)) AS j FROM x, w), t AS (SELECT *, CASE WHEN j < 1 THEN 1 - j WHEN j > n THEN 2 * n + 1 - j ELSE j END AS k FROM m)
SELECT t.gene_id, t.cell_id, round(avg(x.v), 6) AS smoothed FROM t JOIN x ON x.gene_id = t.gene_id AND x.i = t.k GROUP BY 1, 2""")
def gene_trends(s, d):
    x, pt = written(matrix.normalize(B.expr(s, d)), "norm"), B.pseudotime(s, d)
    top = ranking.pearson_with_cells(x, pt, "pt").orderBy(F.desc(F.round(F.abs("corr"), 9)), "gene_id").limit(30).select("gene_id")
    return r6(views.gene_trends(x, pt, top), "smoothed").select("gene_id", "cell_id", "smoothed")


@query("""WITH g AS (SELECT cluster, count(pt) AS n, stddev_samp(pt) AS sd FROM layout GROUP BY 1), b AS (SELECT min(pt) AS lo, max(pt) AS hi FROM layout),
x AS (SELECT l.cluster, n, sd * pow(n, -0.2) AS h, pt, i, lo + i * (hi - lo) / 49 AS x FROM layout l JOIN g USING (cluster), b, range(50) t(i))
SELECT cluster, round(x, 6) AS x, round(sum(exp(-0.5 * ((x - pt) / h) * ((x - pt) / h)) / h) / any_value(n) / sqrt(2 * pi()), 6) AS density FROM x GROUP BY cluster, x""")
def pseudotime_density(s, d):
    return r6(views.density(B.layout(s, d), "cluster", "pt", 50), "x", "density")


@query(f"WITH {SCORE_SQL} SELECT set_name, round(abs(avg(score)), 6) AS strength FROM scores GROUP BY 1 ORDER BY round(abs(avg(score)), 9) DESC, set_name LIMIT 15")
def absolute_ranking(s, d):
    return r6(views.absolute_ranking(_scores(s, d)[0], "set_name", "score"), "strength")


@query(r"""WITH t AS (SELECT doc_id, coalesce(text, '') || ' see doi 10.' || (1000 + doc_id) || '/abc.' || doc_id || '. And 10.12345/x-y_' || doc_id || ', too' AS text FROM documents)
SELECT doc_id, list_transform(regexp_extract_all(text, '10\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+'), lambda x: regexp_replace(x, '[.,;)]+$', ''))::VARCHAR AS dois FROM t""", views=False)
def doi_extract(s, d):
    i = F.col("doc_id").cast("string")
    t = B.read(s, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" see doi 10."), (F.col("doc_id") + 1000).cast("string"), F.lit("/abc."), i, F.lit(". And 10.12345/x-y_"), i, F.lit(", too")).alias("text"))
    return views.dois(t, "text").select("doc_id", F.concat(F.lit("["), F.array_join("dois", ", "), F.lit("]")).alias("dois"))


# -- iterative and learned; tested by pytest


@query()
def connectivities(s, d):
    return neighbors.connectivities(neighbors.knn_blocks(_vectors(s, d).select("id", "vec"), 14))


@query()
def pca_projection(s, d):
    scores, _ = embedding.pca(_vectors(s, d).select("id", "vec"), 8)
    return scores


@query()
def metacell_kmeans(s, d):
    return embedding.kmeans(_vectors(s, d).select("id", "vec"), 50)


@query()
def louvain_clusters(s, d):
    e = neighbors.connectivities(neighbors.knn_blocks(_vectors(s, d).select("id", "vec"), 14))
    return embedding.communities(e, 0.8)


@query()
def diffusion_pseudotime(s, d):
    e = neighbors.connectivities(neighbors.knn_blocks(_vectors(s, d).select("id", "vec"), 14))
    maps, eigen = embedding.diffusion_map(e, 6, 20)
    root = maps.agg(F.min_by("id", F.get("vec", F.lit(1)))).first()[0]
    return embedding.diffusion_pseudotime(maps, eigen, root)


@query()
def doublet_scores(s, d):
    x = written(B.expr(s, d), "counts")
    top = [r.gene_id for r in matrix.highly_variable(matrix.normalize(x), matrix.count_cells(B.cells(s, d)), 200).collect()]
    return embedding.doublet_scores(x, B.cells(s, d), top)


@query()
def harmony_embedding(s, d):
    v = _vectors(s, d).select("id", "vec", (F.col("label").cast("int") % 3).cast("string").alias("batch"))
    return embedding.harmony(v, "batch")


@query()
def hierarchical_clones(s, d):
    return cnv.window_clones(written(matrix.normalize(B.expr(s, d)), "lognorm"), B.cells(s, d), B.genes(s, d), 20)


from cytolake import catalog_tables  # noqa: E402,F401  registers its queries here
