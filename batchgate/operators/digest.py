"""Order-independent content digests: sha256 per row, merged as a tree of sorted hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from batchgate.session import scratch_folder

# Row hashes per leaf stay near this, whatever the table size.
_LEAF = 16384
_STEP = 3


def row_text(columns: Sequence[str]) -> Column:
    """Unambiguous text of a row: every value behind its length in bytes, ``-`` for null.

    Cast doubles to decimals first; their text form is not portable.
    """

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat_ws("|", *[part(c) for c in columns])


def row_hash(columns: Sequence[str]) -> Column:
    return F.sha2(row_text(columns), 256)


def tree_depth(rows: int) -> int:
    """Hex digits of the leaf prefix; depends on the row count alone."""
    depth = 0
    while rows > _LEAF * 16**depth:
        depth += 1
    return depth


def _group_depths(copies: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns ``by`` and ``depth``: every group's own, from its number of different rows."""
    rows = F.count(F.lit(1))
    # As many as a table can count: 16384 rows times 16 to the power of 12.
    depth = sum(((rows > _LEAF * 16**k).cast("int") for k in range(1, 12)),
                (rows > _LEAF).cast("int"))
    return copies.groupBy(*by).agg(depth.alias("depth"))


def tree_digest(hashes: DataFrame, depth: int | None = None, by: Sequence[str] = (),
                distinct: bool = False) -> DataFrame:
    """Columns ``by`` plus ``digest`` over the column ``h`` of row hashes (hex).

    Copies of a row are counted first and stand in the tree as one, so a row that repeats any
    number of times is one partial sum per task.  A node is the sha256 of the joined bytes of its
    sorted children; leaves collect the rows that share ``depth`` hex digits, and upper nodes
    carry their prefix in front of their hash.  Order and partitioning do not matter, and no value
    grows with the table.  Without ``depth`` every group of ``by`` has its own, which depends on
    its rows alone.  Without ``by`` an empty table gives the empty string.  With ``distinct`` the
    caller knows that no row repeats within its group, and the shuffle that counts copies is left
    out; the digest is the same.
    """
    by = list(by)
    node = "sha2(listagg(b, X'') WITHIN GROUP (ORDER BY b), 256)"
    if distinct:
        copies = hashes.select(*by, "h", F.lit(1).cast("long").alias("n"))
    else:
        copies = hashes.groupBy(*by, "h").agg(F.count(F.lit(1)).alias("n"))
    if depth is None:
        path = scratch_folder(hashes.sparkSession)  # the rows behind the hashes are read once
        copies.write.parquet(path)
        copies = hashes.sparkSession.read.schema(copies.schema).parquet(path)
        depths = _group_depths(copies, by)
        deepest = depths.agg(F.max("depth")).first()[0] or 0
        level = copies.join(depths, by) if by else copies.withColumn("depth", F.lit(deepest))
    else:
        deepest = depth
        level = copies.withColumn("depth", F.lit(depth))
    single = F.when(F.col("n") == 1, F.col("h")).otherwise(
        F.sha2(F.concat("h", F.lit(":"), F.col("n").cast("string")), 256))
    level = level.select(*by, "depth", F.expr("substring(h, 1, depth)").alias("p"),
                         F.unhex(single).alias("b"))
    for _ in range(-(-deepest // _STEP)):
        upper = F.greatest(F.lit(0), F.col("depth") - _STEP)
        lower = level.where("depth > 0").groupBy(*by, "depth", "p").agg(F.expr(node).alias("d"))
        lower = lower.select(
            *by, upper.alias("depth"), F.substr("p", F.lit(1), upper).alias("up"),
            F.concat(F.encode("p", "UTF-8"), F.unhex("d")).alias("b"))
        level = lower.withColumnRenamed("up", "p").unionByName(level.where("depth = 0"))
    return level.groupBy(*by).agg(F.expr(f"coalesce({node}, '')").alias("digest"))


def table_digest(table: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """One row ``digest`` for a table of ``rows`` rows."""
    return tree_digest(table.select(row_hash(columns).alias("h")), tree_depth(rows))


def combine_digests(digests: dict[str, str]) -> str:
    """Digest of a snapshot from the digests of its tables, in the given order."""
    text = "\n".join(f"{name}:{digest}" for name, digest in digests.items())
    return hashlib.sha256(text.encode()).hexdigest()
