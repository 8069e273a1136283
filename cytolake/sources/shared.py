"""Written tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under spark.checkpoint.dir. Where that is unset, a temporary folder serves a local session, whose
    driver and executors are one machine; any other session is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cytolake-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes written tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written and read again: cuts lineage, and survives lost executors."""
    at = shared_path(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
