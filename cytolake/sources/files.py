"""Small text files in any store that Spark reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _open(spark, path)
    data = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _open(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _open(spark, path)
    fs.delete(p, True)


def write_csv(df: DataFrame, path: str) -> None:
    """One file with a header, for summary-sized tables."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
