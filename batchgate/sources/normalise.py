"""Landing step: read the sender's raw CSV strictly and land it as header + LF CSV.

All sites go through one scan and one write, with the site as the partition; the sites' folders
are renamed afterwards.  The smallest locator of a record with another field count is aggregated
along with the write, so the error names the same record whatever the tasks' order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from batchgate.errors import InvalidRecord
from batchgate.operators.contract import DEFAULT, Contract
from batchgate.sources import files
from batchgate.sources.landing import (
    assemble_records, control_path, data_path, list_delivery, locate, number_lines, opens,
    quote_states, raw_fields, read_lines, stays_open, unquote, with_offsets,
)
from batchgate.sources.synthetic import write_csv, write_site
from batchgate.session import batch_settings, scratch_folder


def _records(spark: SparkSession, folder: str, contract: Contract,
             scratch: str) -> tuple[DataFrame, DataFrame | None]:
    """All records but the files' first lines: ``hospital, file, value`` and a locator ``at``.

    ``at`` grows within a file.  Where no field spans lines it is the split and place, and the
    splits' line counts come along to turn one into a line; else it is the line itself.
    """
    value = F.col("value")
    lines = read_lines(spark, [data_path(folder, site) for site in contract.sites])
    keys = ["hospital", "file", "block"]
    lines.groupBy(*keys).agg(
        F.min("mid").alias("first_mid"), F.count(F.lit(1)).alias("lines"),
        F.bool_or(opens(value)).alias("opens")).write.parquet(f"{scratch}/splits")
    splits = spark.read.parquet(f"{scratch}/splits")
    if splits.where("opens").isEmpty():
        # One short row per file; splits are cut alike in both scans.
        first = splits.groupBy("hospital", "file").agg(
            F.min_by("first_mid", "block").alias("mid"))
        rest = lines.where(value != "").join(first, ["hospital", "file", "mid"], "left_anti")
        at = F.struct("block", "mid")
        return rest.select("hospital", "file", at.alias("at"), "value"), splits
    lines.write.parquet(f"{scratch}/lines")
    numbered = number_lines(spark.read.parquet(f"{scratch}/lines"))
    flagged = numbered.withColumns({"opens": opens(value), "stays": stays_open(value)})
    records = assemble_records(quote_states(flagged)).where("line > 1")
    at = F.struct(F.lit(0).cast("long").alias("block"), F.col("line").alias("mid"))
    return records.select("hospital", "file", at.alias("at"), "value"), None


def _site_number(contract: Contract) -> Column:
    """Sites as numbers, which need no escaping in a folder's name."""
    return F.array_position(F.array(*map(F.lit, contract.sites)), F.col("hospital"))


def _invalid(spark: SparkSession, found, splits: DataFrame | None) -> InvalidRecord:
    line = found["at"]["mid"]
    if splits is not None:
        row = spark.createDataFrame(
            [(found["hospital"], found["file"], found["at"]["block"], line)],
            "hospital string, file string, block long, mid long")
        line = locate(row, with_offsets(splits)).first()["line"]
    return InvalidRecord(found["hospital"], found["file"], line)


def land(spark: SparkSession, raw: str, landing: str, contract: Contract = DEFAULT) -> None:
    """Land every site from ``raw`` to ``landing``; the control files travel along.

    Nothing of ``landing`` is replaced before all records have been read; the first invalid one
    (by site, file and line) raises :class:`InvalidRecord`.
    """
    scratch, width = scratch_folder(spark), len(contract.columns)
    landing = str(landing).rstrip("/")
    # Beside the target: a rename moves nothing.
    landed = f"{landing}/.landing-{uuid.uuid4().hex}"
    delivered = list_delivery(spark, raw, contract.sites)
    invalid = Observation("invalid")
    try:
        with batch_settings(spark, sum(f.size for d in delivered for f in d.data)):
            records, splits = _records(spark, raw, contract, scratch)
            split = records.withColumn("_f", raw_fields(F.col("value"))).withColumn(
                "_site", _site_number(contract))
            bad = F.when(F.size("_f") != width, F.struct(
                F.col("_site").alias("site"), "file", "at", "hospital"))
            observed = split.observe(invalid, F.min(bad).alias("first"))
            rows = observed.sortWithinPartitions("_site", "file", "at").select(
                "_site", *[unquote(F.get("_f", F.lit(i))).alias(c)
                           for i, c in enumerate(contract.columns)])
            write_csv(rows, landed, by="_site")
        if invalid.get["first"] is not None:
            raise _invalid(spark, invalid.get["first"], splits)
        for number, site in enumerate(contract.sites, 1):
            if files.exists(spark, f"{landed}/_site={number}"):
                files.replace_tree(spark, f"{landed}/_site={number}", data_path(landing, site))
            else:  # a header and nothing else
                write_site(spark, rows.drop("_site").limit(0), landing, site)
            files.copy(spark, control_path(raw, site), control_path(landing, site))
    finally:
        files.delete_tree(spark, landed)
        files.delete_tree(spark, scratch)
