"""Staging: one scan of the delivery to typed rows, rejects with locators, and tallies."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchgate.errors import BatchError
from batchgate.functions.tokens import pack_tokens
from batchgate.operators.contract import CANONICAL, Contract, canonical, classify
from batchgate.operators.gates import quarantine
from batchgate.sources import landing
from batchgate.sources.fingerprint import line_digest
from batchgate.sources.landing import Delivery


@dataclass
class Staged:
    """What one delivery turned into; the DataFrames read tables under the scratch folder."""

    accepted: DataFrame
    rejected: DataFrame
    files: Sequence
    input_rows: Counter = field(default_factory=Counter)
    accepted_rows: Counter = field(default_factory=Counter)
    rejected_rows: Counter = field(default_factory=Counter)
    reasons: dict[str, Counter] = field(default_factory=dict)
    engine: dict[str, str] = field(default_factory=dict)
    bad_header: set[str] = field(default_factory=set)
    unreadable: set[str] = field(default_factory=set)

    def tally(self, site: str, reason: str | None, rows: int) -> None:
        if rows == 0:
            return
        self.input_rows[site] += rows
        if reason is None:
            self.accepted_rows[site] += rows
        else:
            self.rejected_rows[site] += rows
            self.reasons.setdefault(site, Counter())[reason] += rows


def typed_rows(records: DataFrame, day: date, key: bytes, contract: Contract,
               keep: tuple[str, ...]) -> DataFrame:
    """Classify records (``value`` = one CSV record) and project the accepted ones."""
    fields = landing.with_fields(records, contract.columns, ("hospital", *keep))
    return canonical(
        classify(fields, day, contract=contract), key, contract,
        batch_date=F.lit(day), keep=(*keep, "is_header"),
    )


def _token_columns(contract: Contract) -> list[str]:
    return [rule.target for rule in contract.ids.values()]


def stage_lines(spark: SparkSession, paths: Sequence[str], day: date, key: bytes,
                contract: Contract, typed: bool = True) -> DataFrame:
    """Every line as a record of its own; lines that cannot be one say so in ``kind``.

    Without ``typed`` no row is classified: ``reason`` is null and the published columns are
    missing.
    """
    value = F.col("value")
    lines = landing.read_lines(spark, paths).withColumns({
        "line_hash": landing.line_hash(value), "line_digest": line_digest(value),
        "kind": landing.line_kind(value), "stays": landing.stays_open(value),
        "long": landing.is_long(value),
    })
    keep = (*landing.LINE_KEY[1:], "line_hash", "line_digest", "kind", "stays", "long")
    if not typed:
        return landing.with_fields(lines, contract.columns, ("hospital", *keep)).select(
            "hospital", *keep, "is_header", F.lit(None).cast("string").alias("reason"))
    return pack_tokens(typed_rows(lines, day, key, contract, keep), _token_columns(contract))


def find_spanning(staged: DataFrame, sites: Sequence[str], offsets: DataFrame) -> DataFrame:
    """Locators of all lines that belong to line-spanning records: ``LINE_KEY``, ``record``,
    ``line``, ``line_hash``.

    Only lines whose quotes change or set the state are sorted; they give intervals, whose lines
    find their hashes by key.  Long lines come along as records of one line, because a field
    limit holds for files with such records.
    """
    some = staged.where(F.col("hospital").isin(*sites))
    opens = F.col("kind") == "open"
    events = some.where(opens | ~F.col("stays")).select(
        *landing.LINE_KEY, opens.alias("opens"), "stays")
    intervals = landing.spanning_intervals(
        events, offsets.where(F.col("hospital").isin(*sites)))
    inside = landing.interval_lines(intervals)
    keys = list(landing.LINE_KEY)
    spanning = some.select(*keys, "line_hash").join(inside, keys)
    alone = some.where("long").select(*keys, "line_hash").join(inside, keys, "left_anti")
    return landing.locate(spanning.unionByName(alone.withColumn("record", F.col("mid"))), offsets
                          ).select(*keys, "record", "line", "line_hash")


def stage_spanning(spark: SparkSession, paths: Sequence[str], spanning: DataFrame, day: date,
                   key: bytes, contract: Contract, scratch: str) -> tuple[DataFrame, set[str]]:
    """Line-spanning records put together and typed, from a second look at their lines.

    Splits are cut as in the first scan, and every line must hash to what that scan saw.
    Records longer than any with the contract's columns have more of them, or a field beyond the
    limit: the former stand as a record of too many empty columns, the latter's sites are named.
    """
    value = F.col("value")
    same = landing.line_hash(value) == F.col("line_hash")
    landing.read_lines(spark, paths).join(spanning, list(landing.LINE_KEY)).withColumn(
        "value", F.when(same, value).otherwise(F.raise_error(F.lit("line changed")))
    ).write.parquet(f"{scratch}/text")
    text = spark.read.parquet(f"{scratch}/text")
    if text.count() != spanning.count():
        raise BatchError("INTERNAL_ERROR")
    keys = ["hospital", "file", "record"]
    landing.oversized_records(text, len(contract.columns)).write.parquet(f"{scratch}/oversized")
    too_long = spark.read.parquet(f"{scratch}/oversized").select(*keys)
    stubs = None
    refused: set[str] = set()
    if not too_long.isEmpty():
        long_lines = text.join(too_long, keys, "left_semi")
        wide = landing.longest_fields(long_lines).where(F.col("longest") > landing.FIELD_LIMIT)
        broken = long_lines.where(~F.is_valid_utf8(value))
        refused = {r["hospital"] for r in wide.select("hospital").unionByName(
            broken.select("hospital")).distinct().collect()}
        stubs = long_lines.groupBy(*keys).agg(F.max("line").alias("line")).select(
            "hospital", "file", "line", F.lit("," * len(contract.columns)).alias("value"))
        text = text.join(too_long, keys, "left_anti")
    if refused:
        text = text.where(~F.col("hospital").isin(*refused))
        stubs = stubs.where(~F.col("hospital").isin(*refused))
    kind: Column = (
        F.when(~F.is_valid_utf8(value), "undecodable")
        .when(landing.too_wide(value), "oversized").otherwise("row")
    )
    records = landing.join_records(text)
    if stubs is not None:
        records = records.unionByName(stubs)
    records = records.withColumn("kind", kind)
    typed = typed_rows(records, day, key, contract, ("file", "line", "kind"))
    pack_tokens(typed, _token_columns(contract)).write.parquet(f"{scratch}/records")
    return spark.read.parquet(f"{scratch}/records"), refused


def stage(spark: SparkSession, deliveries: Sequence[Delivery], folder: str, day: date, key: bytes,
          contract: Contract, scratch: str, typed: bool = True) -> Staged:
    """Scan the delivery once; put line-spanning records together where a site has any.

    The tokens of ``accepted`` are packed.  Without ``typed`` the rows are only counted and
    digested, for a batch that its files have stopped already: ``accepted`` and ``rejected`` are
    the scanned lines then, and no row has a reason.
    """
    sites = [d.site for d in deliveries]
    paths = [landing.data_path(folder, s) for s in sites]
    stage_lines(spark, paths, day, key, contract, typed).write.option(
        "compression", "lz4").parquet(f"{scratch}/stage")
    staged = spark.read.parquet(f"{scratch}/stage")

    outcome = ["kind", "is_header", "reason"]
    landing.line_counts(staged, ("hospital", "file", "block", *outcome)).write.parquet(
        f"{scratch}/tallies")
    tallies = spark.read.parquet(f"{scratch}/tallies")
    counts = tallies.groupBy("hospital", *outcome).agg(F.sum("lines").alias("lines")).collect()
    blocks = landing.with_offsets(landing.merge_counts(
        tallies, ("hospital", "file", "block"),
        F.min_by("is_header", "first_mid").alias("starts_with_header"),
    ))
    summaries = landing.file_summary(
        blocks, staged, F.min_by("starts_with_header", "block").alias("has_header"))

    result = Staged(staged, staged, summaries)
    headers = Counter(r["hospital"] for r in summaries if r["has_header"])
    result.bad_header = {d.site for d in deliveries if headers[d.site] != len(d.data)}
    result.unreadable = {r["hospital"] for r in counts if r["kind"] == "undecodable"}
    slow = {r["hospital"] for r in counts if r["kind"] == "open"}
    result.engine = {s: "records" if s in slow else "lines" for s in sites}

    records = None
    single = staged
    slow -= result.bad_header | result.unreadable
    if slow:
        find_spanning(staged, sorted(slow), blocks).write.parquet(f"{scratch}/spanning")
        spanning = spark.read.parquet(f"{scratch}/spanning")
        records, refused = stage_spanning(spark, paths, spanning, day, key, contract, scratch)
        result.unreadable |= refused
        single = staged.join(spanning, list(landing.LINE_KEY), "left_anti")
        counts = single.groupBy("hospital", *outcome).agg(
            F.count(F.lit(1)).alias("lines")).collect()
        for row in records.groupBy("hospital", "kind", "reason").agg(
                F.count(F.lit(1)).alias("lines")).collect():
            if row["kind"] != "row":
                result.unreadable.add(row["hospital"])
            result.tally(row["hospital"], row["reason"], row["lines"])
    for row in counts:
        if row["kind"] == "row":
            # The header line of each file went through the contract like any other line.
            header = headers.pop(row["hospital"], 0) if row["is_header"] else 0
            result.tally(row["hospital"], row["reason"], row["lines"] - header)
    if not typed:
        return result

    rows = single.where(F.col("kind") == "row")
    result.accepted = rows.where(F.col("reason").isNull()).select(*CANONICAL)
    result.rejected = quarantine(
        landing.locate(rows.where(F.col("reason").isNotNull()), blocks).where("line > 1"))
    if records is not None:
        result.accepted = result.accepted.unionByName(
            records.where(F.col("reason").isNull()).select(*CANONICAL))
        result.rejected = result.rejected.unionByName(quarantine(records))
    return result
