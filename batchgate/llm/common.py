"""Helpers shared by the operators: reading tables, scratch tables, digests, prefix sums."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchgate.session import scratch_folder

# A rough bound of the text that one task holds at a time, whatever the Arrow batch size.
CHUNK_BYTES = 8 << 20
# Rows of a batch between Spark and Python, in queries over long texts.
ARROW_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table to the shared scratch area and read it again: lineage ends there.

    The folder outlives the call, because the returned frame reads it lazily.
    """
    spark = df.sparkSession
    path = folder or scratch_folder(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def running_offsets(counts: DataFrame, order: str, count: str, by: list[str],
                    block: int = 1024) -> DataFrame:
    """Add ``base``: the sum of ``count`` over all smaller ``order`` within ``by``.

    ``order`` is a non-negative number.  The sum runs inside blocks of ``block`` neighbouring
    numbers and over the totals of the blocks, so no task holds all rows of a group.
    """
    blocked = counts.withColumn("_block", F.floor(F.col(order) / block))
    before = lambda *cols: Window.partitionBy(*cols).rowsBetween(
        Window.unboundedPreceding, -1)
    totals = blocked.groupBy(*by, "_block").agg(F.sum(count).alias("_total"))
    totals = totals.withColumn(
        "_before", F.coalesce(F.sum("_total").over(before(*by).orderBy("_block")), F.lit(0)))
    inner = blocked.withColumn(
        "_inner", F.coalesce(F.sum(count).over(before(*by, "_block").orderBy(order)), F.lit(0)))
    joined = inner.join(totals.drop("_total"), [*by, "_block"])
    return joined.withColumn("base", (F.col("_before") + F.col("_inner")).cast("long")).drop(
        "_block", "_before", "_inner")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that clashes with none of the frame's, case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    return F.col("`" + re.sub("`", "``", name) + "`")


def bounded_sample(frame: DataFrame, key: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of ``key``.

    A rate from the count lets about twice as many pass, so that tasks send few rows to the
    driver, whatever their number; small tables pass whole.
    """
    rate = min(1.0, 2 * rows / max(1, frame.count()))
    place = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / (1 << 30)
    return frame.where(place <= rate).orderBy(F.xxhash64(*key), *key).limit(rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return freed memory of this Python worker to the machine; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A task's function over batches that leaves little memory behind in its worker."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return wrapped
