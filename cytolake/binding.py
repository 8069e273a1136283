"""The single-cell tables as views of the relational test tables.

expr(cell_id, gene_id, value) holds the stored (non-zero) values only; every mean over cells divides by the number
of cells, never by stored rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    return (
        items.select("l_orderkey", "l_partkey", "l_quantity")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"))
        .agg(F.sum("l_quantity").alias("value"))
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("cell_id"), F.col("n_name").alias("sample"), F.col("c_mktsegment").alias("cell_type"), F.col("c_acctbal").alias("score"))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("symbol"), F.col("p_brand").alias("chromosome"), F.col("p_type").alias("set_name"), F.col("p_partkey").alias("start"))


def gene_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_type").alias("set_name"), F.col("p_partkey").alias("gene_id"))


def pseudotime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order day of each cell, scaled to 0..1 over all cells."""
    first = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cell_id")).agg(F.min(F.unix_date(F.to_date("o_orderdate"))).alias("day"))
    span = first.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    return first.join(F.broadcast(span)).select("cell_id", ((F.col("day") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("pt"))


def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-D coordinates, pseudotime and cluster of the embedding table, in double precision."""
    v = lambda i: F.col("embedding")[i].cast("double")
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cell_id"), v(0).alias("x"), v(1).alias("y"), v(2).alias("pt"), F.col("label").cast("string").alias("cluster"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned reads: gene, cell, interval, mapping quality, flags and CIGAR derived from order lines."""
    items, orders, part = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders"), read(spark, sf_dir, "part")
    day = F.unix_date(F.to_date("l_shipdate")).cast("long")
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_brand").alias("chrom"), F.pmod(day, F.lit(1500)).alias("start"), (F.pmod(day, F.lit(1500)) + F.col("l_quantity").cast("long")).alias("end"),
            F.when(F.col("l_linenumber") > 5, 60).otherwise(255).alias("mapq"), (F.col("l_returnflag") == "R").alias("is_secondary"), F.lit(False).alias("is_supplementary"), F.lit(False).alias("is_unmapped"),
            F.col("o_custkey").alias("cb"), F.col("l_partkey").alias("gn"), F.when(F.col("l_linenumber") == 1, "20M100N30M").otherwise("50M").alias("cigar"),
        )
    )


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three exons a gene, 0-based and half open."""
    part = read(spark, sf_dir, "part")
    k = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")
    return part.select("p_partkey", "p_brand", "p_size", k).select(F.col("p_brand").alias("chrom"), F.col("p_partkey").alias("gene"), (F.col("p_size") * 10 + F.col("k") * 450).cast("long").alias("start"), (F.col("p_size") * 10 + F.col("k") * 450 + 300).cast("long").alias("end"))


#: The same views for DuckDB.
SQL = """
expr AS (SELECT o_custkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
cells AS (SELECT c_custkey AS cell_id, n_name AS sample, c_mktsegment AS cell_type, c_acctbal AS score FROM customer JOIN nation ON c_nationkey = n_nationkey),
genes AS (SELECT p_partkey AS gene_id, p_name AS symbol, p_brand AS chromosome, p_type AS set_name, p_partkey AS start FROM part),
day0 AS (SELECT o_custkey AS cell_id, min(date_diff('day', DATE '1970-01-01', o_orderdate::DATE)) AS day FROM orders GROUP BY 1),
ptime AS (SELECT cell_id, (day - (SELECT min(day) FROM day0))::DOUBLE / ((SELECT max(day) FROM day0) - (SELECT min(day) FROM day0)) AS pt FROM day0),
layout AS (SELECT vec_id AS cell_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS pt, label::VARCHAR AS cluster FROM embeddings),
ncells AS (SELECT count(*)::DOUBLE AS n FROM cells),
norm AS (SELECT cell_id, gene_id, ln(1 + value * 10000 / sum(value) OVER (PARTITION BY cell_id)) AS value FROM expr)
"""
