"""Hash trees kept beside a table, and comparison by descent.

A tree orders the different rows of a table by their hash.  ``rows/`` holds them, each with its
number of copies, in folders by the first digits of the hash and sorted within; ``nodes/`` holds a
digest for every prefix of the hash down to leaves of some thousand rows.  Equal contents have
equal nodes however they were written, so two trees are compared from the root downwards, along
prefixes whose nodes differ, and only the rows of differing leaves are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from batchgate.operators.compare import snapshot_diff
from batchgate.operators.digest import row_hash
from batchgate.session import scratch_folder

LEAF_ROWS = 16384
# Folders of a tree's rows, as digits: 256 at most, whatever the number of leaves.
_FOLDER_DIGITS = 2
# Up to so many differing leaves go into the scan as a filter; more are joined.
_LISTED = 1024
_NODE = "sha2(listagg(b, X'') WITHIN GROUP (ORDER BY b), 256)"


def _written(table: DataFrame, path: str) -> DataFrame:
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def write_tree(table: DataFrame, folder: str, leaf_rows: int = LEAF_ROWS) -> None:
    """Keep the table's tree under ``folder``.

    Copies are counted before rows are dealt to leaves, so a row that repeats without bound is
    one partial count per task.  The depth follows from the number of rows alone.
    """
    depth, total = 0, table.count()
    while total > leaf_rows * 16**depth:
        depth += 1
    columns = table.columns
    copies = table.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_h", row_hash(columns))
    leaf = F.substr("_h", F.lit(1), F.lit(depth))
    directory = F.concat(F.lit("x"), F.substr("_h", F.lit(1), F.lit(min(depth, _FOLDER_DIGITS))))
    rows = copies.withColumn("_leaf", leaf).withColumn("_dir", directory)
    # Ranges of the hash are even, and a task writes to neighbouring folders only.
    rows.repartitionByRange("_h").sortWithinPartitions("_dir", "_h").write.partitionBy("_dir").parquet(
        f"{folder}/rows")
    stored = table.sparkSession.read.schema(rows.schema).parquet(f"{folder}/rows")
    copied = F.concat("_h", F.lit(":"), F.col("_n").cast("string"))
    level = stored.select(F.col("_leaf").alias("prefix"), F.encode(copied, "UTF-8").alias("b"))
    for k in range(depth, -1, -1):
        nodes = _written(level.groupBy("prefix").agg(F.expr(_NODE).alias("digest")),
                         f"{folder}/nodes/level={k}")
        level = nodes.select(
            F.substr("prefix", F.lit(1), F.lit(max(k - 1, 0))).alias("prefix"),
            F.encode(F.concat("prefix", F.lit(":"), "digest"), "UTF-8").alias("b"))


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("prefix string, digest string, level int").parquet(f"{folder}/nodes")


def differing_prefixes(spark: SparkSession, left: str, right: str) -> DataFrame | None:
    """Prefixes of the leaves that differ between two trees, or None.

    A level is read below differing nodes only.  Where the trees differ in depth, the descent
    ends with the flatter one.
    """
    one, two = _nodes(spark, left), _nodes(spark, right)
    depth = min(t.agg(F.max("level")).first()[0] or 0 for t in (one, two))
    found = None
    for k in range(depth + 1):
        sides = [t.where(F.col("level") == k).select("prefix", "digest") for t in (one, two)]
        if found is not None:
            above = F.substr("prefix", F.lit(1), F.lit(k - 1))
            sides = [t.withColumn("above", above).join(
                found.withColumnRenamed("prefix", "above"), "above", "left_semi").drop("above")
                for t in sides]
        a, b = sides
        same = a.withColumnRenamed("digest", "a").join(
            b.withColumnRenamed("digest", "b"), "prefix", "full_outer")
        found = _written(same.where(~F.col("a").eqNullSafe(F.col("b"))).select("prefix"),
                         scratch_folder(spark))
        if found.isEmpty():
            return None
    return found


def _rows_below(spark: SparkSession, folder: str, columns: DataFrame, prefixes: DataFrame,
                listed: list[str] | None, digits: int) -> DataFrame:
    schema = StructType([*columns.schema.fields, StructField("_n", LongType()),
                         *(StructField(c, StringType()) for c in ("_h", "_leaf", "_dir"))])
    rows = spark.read.schema(schema).parquet(f"{folder}/rows")
    own = F.substr("_h", F.lit(1), F.lit(digits))
    if listed is None:
        return rows.withColumn("prefix", own).join(prefixes, "prefix", "left_semi")
    # The folder prunes files, the bounds of the hash prune row groups.
    folders = sorted({f"x{p[:_FOLDER_DIGITS]}" for p in listed})
    if digits >= _FOLDER_DIGITS:
        rows = rows.where(F.col("_dir").isin(folders))
    else:
        start = F.substr("_dir", F.lit(2), F.lit(digits))
        rows = rows.where(start.isin([p[:digits] for p in listed]) | (F.length("_dir") <= digits))
    low, high = min(listed), max(listed) + "g"  # behind every hex digit
    return rows.where((F.col("_h") >= low) & (F.col("_h") < high) & own.isin(listed))


def tree_diff(spark: SparkSession, left: str, right: str, columns: DataFrame) -> DataFrame:
    """What :func:`snapshot_diff` gives for the tables of two trees, from differing leaves alone.

    ``columns`` is a table with the columns of both, for its schema.
    """
    prefixes = differing_prefixes(spark, left, right)
    if prefixes is None:
        return snapshot_diff(columns.limit(0), columns.limit(0))
    few = [r["prefix"] for r in prefixes.limit(_LISTED + 1).collect()]
    digits = len(few[0])
    listed = few if len(few) <= _LISTED else None
    tagged = None
    for folder, sides in ((left, ("_n", "0")), (right, ("0", "_n"))):
        rows = _rows_below(spark, folder, columns, prefixes, listed, digits).selectExpr(
            *[f"`{c}`" for c in columns.columns], f"cast({sides[0]} as bigint) as _l",
            f"cast({sides[1]} as bigint) as _r")
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return tagged.groupBy(*columns.columns).agg(
        F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows")).where(
        "left_rows <> right_rows")
