"""Expression matrices, gene-set dictionaries and a content-keyed cache."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytolake.sources.files import exists


def _lines(spark: SparkSession, folder: str, name: str) -> DataFrame:
    for n in (f"{name}.gz", name):
        if exists(spark, f"{folder}/{n}"):
            return spark.read.text(f"{folder}/{n}")
    raise FileNotFoundError(f"{folder} has neither {name}.gz nor {name}")


def _numbered(lines: DataFrame) -> DataFrame:
    """Adds the 1-based line number of a text that Spark reads as one piece."""
    if lines.select(F.spark_partition_id()).distinct().limit(2).count() > 1:
        raise ValueError("barcode and feature lists must be read as one piece; compress them")
    return lines.withColumn("line", F.monotonically_increasing_id() + 1)


def read_10x(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """cells (cell_id, barcode), genes (gene_id, ensembl, symbol; repeated symbols numbered) and expr (cell_id, gene_id, value) of a Matrix Market folder."""
    from cytolake.operators.matrix import unique_symbols

    cells = _numbered(_lines(spark, folder, "barcodes.tsv")).select(F.col("line").alias("cell_id"), F.trim("value").alias("barcode"))
    f = F.split("value", "\t")
    genes = _numbered(_lines(spark, folder, "features.tsv")).select(F.col("line").alias("gene_id"), f[0].alias("ensembl"), F.coalesce(F.get(f, F.lit(1)), f[0]).alias("symbol"))
    body = _lines(spark, folder, "matrix.mtx").select("value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_block_start").alias("block")).where(~F.startswith("value", F.lit("%")))
    size_line = body.where("block = 0").agg(F.min("at")).first()[0]
    if size_line is None:
        raise ValueError(f"{folder}: the matrix has no size line")
    p = F.split(F.trim("value"), r"\s+")
    expr = body.where(F.col("at") != size_line).select(p[1].cast("long").alias("cell_id"), p[0].cast("long").alias("gene_id"), p[2].cast("double").alias("value"))
    return cells, unique_symbols(genes), expr.groupBy("cell_id", "gene_id").agg(F.sum("value").alias("value")).where("value <> 0")


def read_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{folder}/{n}") for n in ("cells", "genes", "expr"))


def read_any(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A folder of cells, genes and expr tables, or a 10x folder."""
    if exists(spark, f"{folder}/expr"):
        return read_tables(spark, folder)
    return read_10x(spark, folder)


def coo(rows: list[int], cols: list[int], values: list[float], spark: SparkSession) -> DataFrame:
    """expr of coordinate lists; duplicates add up."""
    df = spark.createDataFrame(list(zip(rows, cols, values, strict=True)), "cell_id long, gene_id long, value double")
    return df.groupBy("cell_id", "gene_id").agg(F.sum("value").alias("value"))


def read_dictionary(path: str) -> dict[str, list[str]]:
    """A JSON object of names and gene lists."""
    return {str(k): [str(g) for g in v] for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items()}


def newest_input(root: str) -> Path | None:
    """The newest run folder below root that holds tables, by time of change."""
    found = [p.parent for p in Path(root).glob("*/*/expr") if p.is_dir()]
    return max(found, key=lambda p: p.stat().st_mtime, default=None)


def cache_key(**parts) -> str:
    return hashlib.blake2b(json.dumps(parts, sort_keys=True, default=str).encode(), digest_size=20).hexdigest()


def cached(spark: SparkSession, folder: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table under the key; made and written if it is not there yet."""
    at = f"{folder.rstrip('/')}/{key}"
    if not exists(spark, f"{at}/_SUCCESS"):
        make().write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)
