"""Exact medians per key of any number of values, without a task that holds a key's values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from batchgate.session import scratch_folder


def medians(table: DataFrame, key: str, value: str) -> DataFrame:
    """Columns ``key`` and ``median``; nulls do not count.

    Equal values are counted before they meet.  The counted values are sorted over the cluster
    into ranges; a row per key and range says how many values lie in front of it, and only the
    one or two ranges with a key's middle are looked at value by value.
    """
    spark = table.sparkSession
    counted = table.where(F.col(value).isNotNull()).groupBy(key, value).agg(
        F.count(F.lit(1)).alias("n"))
    path = scratch_folder(spark)
    counted.repartitionByRange(key, value).withColumn(
        "range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    per_range = ranged.groupBy(key, "range").agg(F.sum("n").alias("here"))
    over_key = Window.partitionBy(key)
    before = over_key.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_range.select(
        key, "range", "here", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"),
        F.sum("here").over(over_key).alias("all"))
    # The middle value or values, counted from 1.
    low, high = F.floor((F.col("all") + 1) / 2), F.floor(F.col("all") / 2) + 1
    middle = placed.withColumns({"low": low, "high": high}).where(
        (F.col("high") > F.col("before")) & (F.col("low") <= F.col("before") + F.col("here")))
    up_to = Window.partitionBy(key, "range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, 0)
    values = ranged.join(middle, [key, "range"]).withColumn(
        "end", F.col("before") + F.sum("n").over(up_to))
    holds = lambda place: (F.col(place) <= F.col("end")) & (
        F.col(place) > F.col("end") - F.col("n"))
    return values.groupBy(key).agg(
        F.max(F.when(holds("low"), F.col(value))).alias("_low"),
        F.max(F.when(holds("high"), F.col(value))).alias("_high"),
    ).select(key, ((F.col("_low") + F.col("_high")) / 2).alias("median"))
