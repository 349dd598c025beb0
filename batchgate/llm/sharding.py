"""Sharding by a two-pass external shuffle, in DataFrame operations alone.

Pass one scatters the records uniformly into buckets that fit in memory, by a seeded hash; bucket
k goes to task k mod tasks, so every task has its fair share of them.  Pass
two shuffles each bucket with Fisher and Yates' algorithm (Spark's ``shuffle``), numbers the
records through all buckets, and writes record number p to shard ``p mod shards`` at slot
``p div shards``: the counts of two shards differ by one at most, and the slots have no gaps.

The hash takes the row's number in the scan along with its id, so equal rows, null ids and one
id with a third of all rows scatter like any others.  The numbers of the buckets' first records
come from a count over the same hash; it reads the ids alone.  The input must give the same rows
in the same splits twice, as tables do; the written shards are counted against it.

Cases: a null text is empty and has size 1; an empty table gives empty shards; other columns are
carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import fresh, quoted, running_offsets
from batchgate.session import scratch_folder, settings

# Text that one task holds while it shuffles a bucket, whatever the number of buckets.
BUCKET_BYTES = 32 << 20
# Beyond it a task takes several buckets, sorted by bucket and held one at a time.
MAX_TASKS = 1 << 16
# Bounds the table of first record numbers, which is broadcast: 16 bytes a bucket, 64 MB in all.
# Buckets stay within their size up to 128 TB of text and grow beyond.
MAX_BUCKETS = 1 << 22
# Aggregate sorted groups: a task then holds one bucket, where a hash table would hold many.
ONE_AT_A_TIME = {"spark.sql.execution.useObjectHashAggregateExec": "false"}


def size_of(text: str):
    """UTF-8 bytes of a text column plus 1; null: 1."""
    return (F.coalesce(F.octet_length(quoted(text)), F.lit(0)) + 1).cast("long")


def scatter(numbered: DataFrame, bucket: str, buckets: int, max_tasks: int) -> DataFrame:
    """Rows of bucket k in partition k mod tasks; with a task a bucket nothing shares one."""
    return numbered.repartitionById(min(buckets, max_tasks), bucket)


def shard(records: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id",
          text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, max_tasks: int = MAX_TASKS,
          folder: str | None = None) -> DataFrame:
    """Write the records into shards and return them as written: all columns, shard, slot.

    The files lie under ``shard=<n>/`` of the folder, each in slot order.  Columns of the input
    that are called ``shard`` or ``slot`` keep their names; the new ones then get underscores.
    """
    spark = records.sparkSession
    total = records.agg(F.sum(size_of(text_col))).first()[0] or 0
    buckets = max(1, min(MAX_BUCKETS, -(-total // bucket_bytes)))
    shard_col, slot_col = fresh(records, "shard"), fresh(records, "slot")
    bucket_col, row_col, base_col = (fresh(records, n) for n in ("bucket", "scan_row", "base"))

    numbered = records.withColumn(row_col, F.monotonically_increasing_id())
    scattered = numbered.withColumn(bucket_col, F.pmod(
        F.xxhash64(F.lit(seed), quoted(id_col), F.col(row_col)), F.lit(buckets)).cast("int"))
    counts = scattered.groupBy(bucket_col).agg(F.count("*").alias("n"))
    first = running_offsets(counts.withColumn("all", F.lit(0)), bucket_col, "n", ["all"]).select(
        bucket_col, F.col("base").alias(base_col))

    # Sorted, so that a repeated task shuffles alike.
    record = F.struct(row_col, *[quoted(c) for c in records.columns])
    held = (scatter(scattered, bucket_col, buckets, max_tasks).groupBy(bucket_col)
            .agg(F.sort_array(F.collect_list(record)).alias("records"))
            .join(F.broadcast(first), bucket_col).sortWithinPartitions(bucket_col))
    mixed = held.select(base_col, F.posexplode(F.shuffle("records", seed)).alias("at", "r"))
    number = F.col(base_col) + F.col("at")
    placed = mixed.select(
        *[F.col("r")[c].alias(c) for c in records.columns],
        (number % shards).cast("int").alias(shard_col),
        F.floor(number / shards).cast("long").alias(slot_col))
    path = folder or scratch_folder(spark)
    with settings(spark, ONE_AT_A_TIME):
        placed.sortWithinPartitions(shard_col, slot_col).write.partitionBy(shard_col).parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    kept, there = written.select(slot_col).count(), counts.agg(F.sum("n")).first()[0] or 0
    if kept != there:
        raise RuntimeError(f"{kept} records written, {there} read: the input changed meanwhile")
    return written


def op6_sharding(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Where each document went, read from the written shards."""
    written = shard(docs.select("doc_id", "text"), shards)
    return written.select(
        "doc_id", size_of("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
