"""Places in an order over a whole table, without one task that holds it."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytolake.sources.shared import partitions, written


def placed(df: DataFrame, order: list[str], out: str = "place") -> DataFrame:
    """df with each row's place, from 0, in the order (columns that make rows distinct). Rows are dealt by ranges of the
    order and written; a place is that within the range plus the rows of the ranges before, of which there are as many as partitions."""
    dealt = df.repartitionByRange(partitions(df.sparkSession), *order).withColumn("range_no", F.spark_partition_id())
    x = written(dealt, "placed")
    before = F.coalesce(F.sum("rows").over(W.partitionBy(F.lit(0)).orderBy("range_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row a range
    start = x.groupBy("range_no").agg(F.count("*").alias("rows")).select("range_no", before.alias("rows_before"))
    own = F.row_number().over(W.partitionBy("range_no").orderBy(*order)) - 1
    return x.join(F.broadcast(start), "range_no").withColumn(out, own + F.col("rows_before")).drop("range_no", "rows_before")


def quantiles(df: DataFrame, value: str, at: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """by, and under each name of at the exact quantile of the values, interpolated as F.percentile does; null values do not count. Without by it is
    one row, null if there is no value; a group without a value has no row. Equal values are counted first and the distinct ones dealt by ranges
    of their order, so no task holds them all, as that of F.percentile does; only ranges that hold a wanted place are sorted."""
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    x = df.select(key.alias("q_by"), F.col(value).cast("double").alias("q_v")).where("q_v is not null").groupBy("q_by", "q_v").agg(F.count("*").alias("q_n"))
    x = written(x.repartitionByRange(partitions(df.sparkSession), "q_by", "q_v").withColumn("q_range", F.spark_partition_id()), "quantiles")
    group = W.partitionBy("q_by")  # a row a group and range
    before = F.coalesce(F.sum("rows").over(group.orderBy("q_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = x.groupBy("q_by", "q_range").agg(F.sum("q_n").alias("rows")).select("q_by", "q_range", "rows", before.alias("q_before"), (F.sum("rows").over(group) - 1).alias("q_last"))
    place = {name: F.lit(float(q)) * F.col("q_last") for name, q in at.items()}
    held = lambda p, start, n: (F.col(start) <= p) & (p < F.col(start) + F.col(n))
    ends = [f(p) for p in place.values() for f in (F.floor, F.ceil)]
    some = ranges.where(reduce(or_, [held(p, "q_before", "rows") for p in ends])).drop("rows")
    own = F.coalesce(F.sum("q_n").over(W.partitionBy("q_by", "q_range").orderBy("q_v").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    x = x.join(F.broadcast(some), ["q_by", "q_range"]).withColumn("q_at", F.col("q_before") + own)
    found = []
    for name, p in place.items():
        found += [F.max(F.when(held(f(p), "q_at", "q_n"), F.col("q_v"))).alias(f"{end}_{name}") for end, f in (("lo", F.floor), ("hi", F.ceil))]
    x = (x.groupBy("q_by") if by else x).agg(F.max("q_last").alias("q_last"), *found)
    between = lambda name, p: (F.ceil(p) - p) * F.col(f"lo_{name}") + (p - F.floor(p)) * F.col(f"hi_{name}")
    return x.select(*[F.col(f"q_by.{c}") for c in by or []], *[F.when(F.col(f"lo_{name}") == F.col(f"hi_{name}"), F.col(f"lo_{name}")).otherwise(between(name, p)).alias(name) for name, p in place.items()])
