"""Delivered CSV files as DataFrames: lines, locators, fields, records, fingerprints.

A site delivers ``hospital_<site>.csv`` (one file, or a folder of part files that each
start with the header) and ``hospital_<site>.rows`` with the number of data rows.
Files are read as text lines, so any file splits over the whole cluster.  Every line
keeps its split (``file``, ``block``) and its place in the split (``mid``); the line
number follows from the line counts of earlier splits, without a global sort or window.
"""

from __future__ import annotations

import csv
import hashlib
import io
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from batchgate.errors import BatchError
from batchgate.session import scratch_folder
from batchgate.sources import files, fingerprint

# One CSV field: quoted (with doubled quotes, and whatever trails the closing quote) or
# bare.  Possessive repeats keep the match linear and off the Java stack.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_QUOTED}"[^,]*+|(?!")[^,]*+)'
# Does a line that starts outside (inside) a quoted field end inside one?
_OPENS = rf'\A(?:{_FIELD},)*+"{_QUOTED}\z'
_STAYS_OPEN = rf'\A{_QUOTED}(?:\z|"[^,]*+(?:,{_FIELD})*+,"{_QUOTED}\z)'
_TOKEN = rf',("{_QUOTED}(?:"[^,]*+|\z)|(?!")[^,]*+)'

# Fixed value: longest field a record that spans lines may have, in characters.
FIELD_LIMIT = 131072


class Delivery(NamedTuple):
    """One site's files as listed at one moment."""

    site: str
    root: str
    data: tuple[files.FileInfo, ...]
    control: tuple[files.FileInfo, ...]

    def name(self, info: files.FileInfo) -> str:
        """``hospital_<site>.csv``, and the part file's name behind it."""
        return f"hospital_{self.site}.csv{info.path.removeprefix(self.root)}"


def data_path(folder: str, site: str) -> str:
    return f"{str(folder).rstrip('/')}/hospital_{site}.csv"


def control_path(folder: str, site: str) -> str:
    return f"{str(folder).rstrip('/')}/hospital_{site}.rows"


def list_delivery(spark: SparkSession, folder: str, sites: Sequence[str]) -> list[Delivery]:
    found = []
    for site in sites:
        data = files.list_data_files(spark, data_path(folder, site))
        if not data:
            raise BatchError("MISSING_HOSPITAL_FILE")
        control = files.list_data_files(spark, control_path(folder, site))
        if not control:
            raise BatchError("MISSING_CONTROL_FILE")
        root = files.qualified(spark, data_path(folder, site))
        found.append(Delivery(site, root, tuple(data), tuple(control)))
    return found


def has_header(spark: SparkSession, delivery: Delivery, columns: Sequence[str]) -> bool:
    """Does the delivery start with the header?

    Reads no more of its first file than the longest spelling of the header, every field
    quoted: a first record that goes on behind it is another one.  The text readers drop a
    byte-order mark silently; here it still counts as part of the first column's name.
    """
    longest = sum(2 * len(c.encode()) + 3 for c in columns) + 8
    head = files.read_head(spark, delivery.data[0].path, longest)
    text = head.decode("utf-8", errors="replace")
    first = next(csv.reader(io.StringIO(text, newline="")), None)
    return first == list(columns)


def read_lines(spark: SparkSession, paths: Iterable[str], line_sep: str | None = None) -> DataFrame:
    """All physical lines: ``hospital, file, block, mid, value``.

    The site is that of the path in ``paths`` a file lies under, whatever the file is called.
    Without ``line_sep`` lines end as CSV lines do, with LF, CRLF or CR.
    """
    paths = list(paths)
    # The metadata column escapes a path as a URI does.
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    path = F.regexp_replace(F.url_decode(escaped), r"\Afile:/+", "file:/")
    hospital = file = F.lit(None).cast("string")
    for given in paths:
        root = files.qualified(spark, given)
        name = given.rstrip("/").rsplit("/", 1)[-1]
        inside = (path == root) | F.startswith(path, F.lit(root + "/"))
        hospital = F.when(inside, F.lit(
            name.removeprefix("hospital_").removesuffix(".csv"))).otherwise(hospital)
        file = F.when(inside, F.concat(F.lit(name), F.substr(
            path, F.lit(len(root) + 1)))).otherwise(file)
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    return reader.text(paths).select(
        hospital.alias("hospital"), file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"),
        "value",
    )


def raw_fields(record: Column) -> Column:
    """Array of the CSV fields of one record, quotes still in place."""
    tokens = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_TOKEN), F.lit(1))
    return F.when(record.contains('"'), tokens).otherwise(F.split(record, ",", -1))


def unquote(raw: Column) -> Column:
    """Text of one raw field; what trails a closing quote belongs to it."""
    inside = F.regexp_extract(raw, rf'\A"({_QUOTED})', 1)
    trailing = F.regexp_extract(raw, rf'\A"{_QUOTED}"([^,]*+)\z', 1)
    return F.when(
        raw.startswith('"'), F.concat(F.replace(inside, F.lit('""'), F.lit('"')), trailing)
    ).otherwise(raw)


def line_kind(line: Column) -> Column:
    """``row``, ``blank``, ``undecodable``, or ``open`` (a quoted field runs on)."""
    return (
        F.when(line == "", "blank")
        .when(~F.is_valid_utf8(line), "undecodable")
        .when(opens(line), "open")
        .otherwise("row")
    )


def with_fields(records: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Split ``value`` into the expected text columns, ``field_count`` and ``is_header``.

    ``plain`` marks records of visible ASCII only, whose fields need no stripping.
    """
    split = records.withColumns({
        "_raw": raw_fields(F.col("value")), "plain": F.col("value").rlike(r"\A[!-~]*+\z"),
    })
    texts = split.select(
        *keep, "plain", F.size("_raw").alias("field_count"),
        *[unquote(F.get("_raw", F.lit(i))).alias(c) for i, c in enumerate(columns)],
    )
    header = F.col("field_count") == len(columns)
    for name in columns:
        header = header & (F.col(name) == name)
    return texts.withColumn("is_header", F.coalesce(header, F.lit(False)))


# --- locators and fingerprints ------------------------------------------------------


def line_counts(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group (at least a split): line count and first ``mid``."""
    return lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("lines"), F.min("mid").alias("first_mid"))


def merge_counts(counts: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """Roll :func:`line_counts` up to fewer columns."""
    return counts.groupBy(*by).agg(
        F.sum("lines").alias("lines"), F.min("first_mid").alias("first_mid"), *extra)


def with_offsets(blocks: DataFrame) -> DataFrame:
    """Add ``offset``: lines of the file before this split.

    One row per split reaches the window, so even a file of many terabytes is a sort of
    some hundred thousand short rows.
    """
    before = Window.partitionBy("hospital", "file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return blocks.withColumn("offset", F.coalesce(F.sum("lines").over(before), F.lit(0)))


def locate(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add ``line`` (the header is line 1) to rows that carry ``file, block, mid``."""
    keys = ["hospital", "file", "block"]
    return rows.join(offsets.select(*keys, "offset", "first_mid"), keys).withColumn(
        "line", F.col("offset") + F.col("mid") - F.col("first_mid") + 1
    ).drop("offset", "first_mid")


def file_summary(blocks_with_offsets: DataFrame, lines: DataFrame, *extra: Column) -> list:
    """Per file: ``lines`` and the ``root`` of its tree of line digests.

    ``lines`` are materialised, with ``mid`` and ``line_digest``.
    """
    files_seen = blocks_with_offsets.groupBy("hospital", "file").agg(
        F.sum("lines").alias("lines"), *extra)
    most = files_seen.agg(F.max("lines")).first()[0] or 0
    roots = fingerprint.file_roots(lines, blocks_with_offsets, most)
    return files_seen.join(roots, ["hospital", "file"], "left").collect()


def line_hash(line: Column) -> Column:
    return F.xxhash64(line)


def digest_of_files(
    deliveries: Sequence[Delivery], controls: dict[str, str], summaries: Sequence
) -> str:
    """Fingerprint of a whole delivery from per-file summaries, sizes and control texts."""
    by_file = {(r["hospital"], r["file"]): r for r in summaries}
    digest = hashlib.sha256()
    for delivery in deliveries:
        digest.update(f"{delivery.site}\n{controls[delivery.site]!r}\n".encode())
        for info in delivery.data:
            name = delivery.name(info)
            row = by_file.get((delivery.site, name))
            if row is None and info.size:
                raise BatchError("SOURCE_CHANGED")  # listed, but not among what was read
            content = f"{row['lines']} {row['root']}" if row else ""
            digest.update(f"{name!r}\n{info.size}\n{content}\n".encode())
    return digest.hexdigest()


def input_fingerprint(spark: SparkSession, folder: str, sites: Sequence[str],
                      line_sep: str | None = None) -> str:
    """Content fingerprint of a delivery: one scan, which writes 32 bytes a line for the tree.

    With ``line_sep`` LF it tells apart deliveries that differ in their line ends alone.
    """
    deliveries = list_delivery(spark, folder, sites)
    scratch = scratch_folder(spark)
    try:
        lines = read_lines(spark, [data_path(folder, s) for s in sites], line_sep)
        lines.withColumn("line_digest", fingerprint.line_digest(F.col("value"))).drop(
            "value").write.parquet(scratch)
        digests = spark.read.parquet(scratch)
        blocks = with_offsets(line_counts(digests, ("hospital", "file", "block")))
        summaries = file_summary(blocks, digests)
    finally:
        files.delete_tree(spark, scratch)
    return digest_of_files(deliveries, control_texts(spark, deliveries), summaries)


# --- control files ------------------------------------------------------------------


def read_controls(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Control files: ``hospital, text, control_rows, digits``; null digits = not a number.

    The parts of a control folder are one text, in the order of their names.  ``control_rows``
    is null beyond 38 digits, which no count of rows reaches.
    """
    path = F.col("_metadata.file_path")
    parts = spark.read.text(list(paths), wholetext=True).select(
        F.regexp_extract(path, r"hospital_([^/.]+)\.rows(?:/[^/]*)?\z", 1).alias("hospital"),
        F.struct(path.alias("path"), "value").alias("part"))
    whole = parts.groupBy("hospital").agg(
        F.array_join(F.array_sort(F.collect_list("part")).value, "").alias("text"))
    digits = F.btrim("text", F.lit(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"))
    digits = F.when(digits.rlike(r"\A[0-9]+\z"), F.ltrim(digits, F.lit("0")))
    return whole.select(
        "hospital", "text",
        F.when(digits == "", 0).otherwise(digits.try_cast("decimal(38,0)")).alias("control_rows"),
        digits.alias("digits"))


def control_files(deliveries: Sequence[Delivery]) -> list[str]:
    return [c.path for d in deliveries for c in d.control]


def control_texts(spark: SparkSession, deliveries: Sequence[Delivery]) -> dict[str, str]:
    rows = read_controls(spark, control_files(deliveries)).collect()
    texts = {r["hospital"]: r["text"] for r in rows}
    return {d.site: texts.get(d.site, "") for d in deliveries}


# --- records that span lines --------------------------------------------------------


LINE_KEY = ("hospital", "file", "block", "mid")


def number_lines(lines: DataFrame) -> DataFrame:
    """Lines with their file-wide ``line`` number, from the counts per split."""
    blocks = lines.groupBy("hospital", "file", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.min("mid").alias("first_mid")
    )
    return locate(lines, with_offsets(blocks))


def opens(line: Column) -> Column:
    """Does a line that starts outside quotes end inside them?"""
    return line.contains('"') & line.rlike(_OPENS)


def stays_open(line: Column) -> Column:
    """Does a line that starts inside quotes end inside them?"""
    return ~line.contains('"') | line.rlike(_STAYS_OPEN)


def quote_states(lines: DataFrame) -> DataFrame:
    """Mark where records start: adds ``starts``, ``ends_open`` and ``record``.

    ``lines`` carries the flags ``opens`` and ``stays`` of the functions above and must be
    materialised (``mid`` is compared across two reads).  The flags map the state "inside
    quotes" before a line to the state after it; most lines keep it.  The maps compose per
    split first, then over the few splits of a file, so no file is ever walked by one task.
    ``record`` is the ``mid`` of the record's first line.
    """
    keys = ["hospital", "file", "block"]
    in_block = Window.partitionBy(*keys).orderBy("mid")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    flips = F.sum((F.col("opens") & ~F.col("stays")).cast("int")).over(so_far) % 2 == 1
    scanned = lines.withColumn("_flips", flips).withColumn(
        "_fixed",
        F.last(
            F.when(F.col("opens") == F.col("stays"), F.col("opens") != F.col("_flips")),
            ignorenulls=True,
        ).over(so_far),
    )
    # The same composition, one row per split.
    over_file = Window.partitionBy("hospital", "file").orderBy("block")
    before = over_file.rowsBetween(Window.unboundedPreceding, -1)
    flips_before = F.coalesce(F.sum(F.col("_flips").cast("int")).over(before), F.lit(0)) % 2 == 1
    block = scanned.groupBy(*keys).agg(
        F.max_by("_flips", "mid").alias("_flips"), F.max_by("_fixed", "mid").alias("_fixed")
    ).withColumn("_before", flips_before)
    fixed = F.last(
        F.when(F.col("_fixed").isNotNull(), F.col("_fixed") != F.col("_before")), ignorenulls=True
    ).over(before)
    entry = block.select(
        *keys, (F.coalesce(fixed, F.lit(False)) != F.col("_before")).alias("_entry")
    )
    after = F.coalesce("_fixed", "_entry") != F.col("_flips")
    stated = scanned.join(entry, keys).withColumn("ends_open", after)
    prior = F.coalesce(F.lag("ends_open").over(in_block), F.col("_entry"))
    started = stated.withColumn("starts", ~prior)
    own = F.last(F.when(F.col("starts"), F.col("mid")), ignorenulls=True).over(so_far)
    started = started.withColumn("_own", own).drop("_flips", "_fixed", "_entry")
    heads = started.groupBy(*keys).agg(F.max("_own").alias("_last")).withColumn(
        "_carried", F.last("_last", ignorenulls=True).over(before)
    )
    return started.join(heads.select(*keys, "_carried"), keys).withColumn(
        "record", F.coalesce("_own", "_carried")
    ).drop("_own", "_carried")


def spanning_lines(marked: DataFrame) -> DataFrame:
    """The lines of records that span lines, from :func:`quote_states`."""
    return marked.where(~F.col("starts") | F.col("ends_open"))


def spanning_intervals(events: DataFrame, blocks: DataFrame) -> DataFrame:
    """Where quoted fields run over line ends: ``hospital, file, block, first, last, record``.

    ``events`` are the lines that do not leave the state "inside quotes" as it is, which takes a
    quote: ``LINE_KEY``, ``opens``, ``stays``, materialised.  ``blocks`` has every split's
    ``lines`` and ``first_mid``.  Windows run over the events of a split and over the splits of a
    file, whatever number of other lines there are.  An interval lies in one split; ``record``
    is the ``mid`` of the record's first line, which may lie in an earlier one.
    """
    keys = ["hospital", "file", "block"]
    in_block = Window.partitionBy(*keys).orderBy("mid")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    # An event keeps, swaps or sets the state; the state after it is the last one set, or the
    # split's entry, swapped as often as events have swapped it since.
    swapped = F.sum((F.col("opens") & ~F.col("stays")).cast("int")).over(so_far) % 2 == 1
    scanned = events.withColumn("_swapped", swapped).withColumn("_set", F.last(
        F.when(F.col("opens") == F.col("stays"), F.col("opens") != F.col("_swapped")),
        ignorenulls=True).over(so_far))
    per_block = scanned.groupBy(*keys).agg(
        F.max_by("_swapped", "mid").alias("_swapped"), F.max_by("_set", "mid").alias("_set"))
    earlier = Window.partitionBy("hospital", "file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = blocks.select(*keys, "lines", "first_mid").join(per_block, keys, "left").withColumn(
        "_before", F.coalesce(F.sum(F.coalesce(F.col("_swapped"), F.lit(False)).cast("int")).over(
            earlier), F.lit(0)) % 2 == 1)
    set_before = F.last(F.when(F.col("_set").isNotNull(), F.col("_set") != F.col("_before")),
                        ignorenulls=True).over(earlier)
    splits = splits.select(
        *keys, (F.col("first_mid") + F.col("lines") - 1).alias("_end"), "first_mid",
        (F.coalesce(set_before, F.lit(False)) != F.col("_before")).alias("_entry"))
    stated = scanned.join(splits, keys).withColumn(
        "_after", F.coalesce("_set", "_entry") != F.col("_swapped"))
    changes = stated.withColumn(
        "_prior", F.coalesce(F.lag("_after").over(in_block), F.col("_entry"))).where(
        F.col("_after") != F.col("_prior")).withColumn("_next", F.lead("mid").over(in_block))
    opened = changes.where("_after").select(
        *keys, F.col("mid").alias("first"), F.coalesce("_next", "_end").alias("last"),
        F.col("mid").alias("record"))
    # Splits that begin inside a record of an earlier one.
    heads = changes.groupBy(*keys).agg(
        F.min("mid").alias("_closing"), F.max(F.when(F.col("_after"), F.col("mid"))).alias("_last"))
    entered = splits.join(heads, keys, "left").withColumn(
        "record", F.last("_last", ignorenulls=True).over(earlier)).where("_entry").select(
        *keys, F.col("first_mid").alias("first"), F.coalesce("_closing", "_end").alias("last"),
        "record")
    return opened.unionByName(entered)


def interval_lines(intervals: DataFrame) -> DataFrame:
    """``LINE_KEY`` and ``record`` of every line in the intervals, some thousand at a time."""
    parts = intervals.withColumn("_at", F.explode(F.sequence("first", "last", F.lit(4096))))
    end = F.least(F.col("_at") + 4095, F.col("last"))
    return parts.select("hospital", "file", "block", F.explode(
        F.sequence("_at", end)).alias("mid"), "record")


def is_long(line: Column) -> Column:
    """Long enough to hold a field beyond the limit."""
    return F.octet_length(line) > FIELD_LIMIT


def join_records(spanning: DataFrame) -> DataFrame:
    """One row per line-spanning record: ``hospital, file, line`` (its last) and ``value``.

    Leave :func:`oversized_records` out, which bounds every group.
    """
    return spanning.groupBy("hospital", "file", "record").agg(
        F.max("line").alias("line"),
        F.array_sort(F.collect_list(F.struct("line", "value"))).alias("_parts"),
    ).select(
        "hospital", "file", "line", F.array_join(F.col("_parts.value"), "\n").alias("value")
    )


def assemble_records(marked: DataFrame) -> DataFrame:
    """All records of lines that carry ``value`` and ``line``; blank lines are none."""
    single = marked.where(F.col("starts") & ~F.col("ends_open") & (F.col("value") != ""))
    return single.select("hospital", "file", "line", "value").unionByName(
        join_records(spanning_lines(marked))
    )


def oversized_records(spanning: DataFrame, columns: int) -> DataFrame:
    """Line-spanning records longer than any record with fields within the limit.

    The sizes are summed before the shuffle, so an unclosed quote that swallows the rest
    of a file costs one partial sum per task.
    """
    longest = columns * (2 * FIELD_LIMIT + 3)
    return (
        spanning.groupBy("hospital", "file", "record")
        .agg(F.sum(F.length("value") + 1).alias("size"))
        .where(F.col("size") > longest)
    )


def longest_fields(lines: DataFrame) -> DataFrame:
    """Per line-spanning record its longest field: ``hospital, file, record, longest``.

    Nothing is put together: a line counts the characters of its pieces of fields, and pieces of
    one field meet by its number in the record.  A line behind the first starts inside quotes.
    """
    keys = ["hospital", "file", "record"]
    inside = F.when(F.col("mid") == F.col("record"), F.col("value")).otherwise(
        F.concat(F.lit('"'), F.col("value")))
    pieces = F.transform(raw_fields(inside), lambda f: F.length(unquote(f)).cast("long"))
    counted = lines.select(*keys, "line", pieces.alias("p")).select(
        *keys, "line", F.size("p").alias("n"), F.get("p", F.lit(0)).alias("first"),
        F.element_at("p", -1).alias("last"), F.array_max("p").alias("most"))
    before = Window.partitionBy(*keys).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn(
        "at", F.coalesce(F.sum(F.col("n") - 1).over(before), F.lit(0)))
    # A piece that goes on in the next line has the line end between them.
    ends = F.array(
        F.struct(F.col("at").alias("field"), F.col("first").alias("size")),
        F.when(F.col("n") > 1, F.struct(
            (F.col("at") + F.col("n") - 1).alias("field"), F.col("last").alias("size"))))
    fields = placed.select(*keys, "most", F.explode(F.array_compact(ends)).alias("e")).groupBy(
        *keys, "e.field").agg((F.sum("e.size") + F.count(F.lit(1)) - 1).alias("size"),
                              F.max("most").alias("most"))
    return fields.groupBy(*keys).agg(F.max(F.greatest("size", "most")).alias("longest"))


def too_wide(record: Column) -> Column:
    """Has a field beyond the limit that holds once records span lines."""
    longest = F.array_max(F.transform(raw_fields(record), lambda f: F.length(unquote(f))))
    return F.when(is_long(record), longest > FIELD_LIMIT).otherwise(F.lit(False))
