"""Numbering the rows of a whole table in an order, without all of them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import stored


def numbered(df: DataFrame, order: list, name: str, ranges: int | None = None) -> DataFrame:
    """Adds name: the number of each row from 0 in the order given, which must leave no ties that matter.

    Rows are dealt to ranges of the order and numbered in each; the sizes of the ranges, one row each, give what comes
    before. A spread of equal first keys is dealt by the later ones too.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    offsets = F.broadcast(sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return parts.withColumn("_i", inside).join(offsets, "_range").withColumn(name, (F.col("_before") + F.col("_i") - 1).cast("long")).drop("_range", "_i", "_before")
