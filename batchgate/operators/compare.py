"""Comparing datasets and reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from batchgate.sources.landing import Delivery, input_fingerprint, list_delivery


def snapshot_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs: all columns, ``left_rows``, ``right_rows``.

    One aggregation that combines copies before its shuffle answers both directions.
    """
    columns = left.columns
    tagged = left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
        .where("left_rows <> right_rows")
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    return snapshot_diff(left, right).isEmpty()


def same_report(left: dict, right: dict, ignore: Iterable[str] = ("run_id", "engine")) -> bool:
    """Equal in every field that does not name the run itself."""
    skip = {*ignore, "quarantine", "recorded_at"}
    keep = lambda r: {k: v for k, v in r.items() if k not in skip}
    return keep(left) == keep(right)


def raw_bytes_differ(spark: SparkSession, left: str, right: str, sites: list[str]) -> bool:
    """Do two deliveries differ as files?  Sizes decide first, contents only if needed.

    Lines are compared with what stands before their LF, so line ends count.
    """
    sizes = lambda found: [[f.size for f in d.data] for d in found]
    one: list[Delivery] = list_delivery(spark, left, sites)
    two: list[Delivery] = list_delivery(spark, right, sites)
    if sizes(one) != sizes(two):
        return True
    one_print, two_print = (input_fingerprint(spark, x, sites, "\n") for x in (left, right))
    return one_print != two_print
