"""Stored hash trees: equal to the plain comparison, and reading differing leaves only."""

import pytest
from pyspark.sql import functions as F

from batchgate.operators import hashtree
from batchgate.operators.compare import snapshot_diff


def numbers(spark, n, copies=1):
    return spark.range(n * copies).select(
        (F.col("id") % n).alias("k"), F.concat(F.lit("v"), (F.col("id") % n % 7).cast("string"))
        .alias("v"), F.when(F.col("id") % n % 5 > 0, F.col("id") % n).alias("w"))


def both(spark, tmp_path, left, right, leaf_rows):
    for name, table in (("l", left), ("r", right)):
        hashtree.write_tree(table, str(tmp_path / name), leaf_rows)
    plain = sorted(map(tuple, snapshot_diff(left, right).collect()), key=repr)
    found = hashtree.tree_diff(spark, str(tmp_path / "l"), str(tmp_path / "r"), left)
    return plain, found


@pytest.mark.parametrize("leaf_rows", [30, 300, 100_000])
def test_equal_to_the_plain_comparison(spark, tmp_path, leaf_rows):
    left = numbers(spark, 3000, copies=2)
    right = left.where("k % 500 <> 3").unionByName(
        left.where("k in (7, 1000)")).unionByName(left.where("k = 9").withColumn("v", F.lit("new")))
    plain, found = both(spark, tmp_path, left, right, leaf_rows)
    assert plain and sorted(map(tuple, found.collect()), key=repr) == plain
    assert found.columns == ["k", "v", "w", "left_rows", "right_rows"]


def test_only_differing_leaves_are_read(spark, tmp_path):
    left = numbers(spark, 6000)
    right = left.withColumn("v", F.when(F.col("k") == 77, "x").otherwise(F.col("v")))
    plain, found = both(spark, tmp_path, left, right, 30)
    assert len(plain) == 2 and sorted(map(tuple, found.collect()), key=repr) == plain
    prefixes = hashtree.differing_prefixes(spark, str(tmp_path / "l"), str(tmp_path / "r"))
    assert 1 <= prefixes.count() <= 2
    everything = len(spark.read.parquet(str(tmp_path / "l" / "rows")).inputFiles())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_dir" in plan and everything > 200


@pytest.mark.parametrize("sizes", [(50, 2000), (2000, 50), (0, 40), (0, 0)])
def test_trees_of_other_depths_and_empty_ones(spark, tmp_path, sizes):
    left, right = (numbers(spark, n) for n in sizes)
    plain, found = both(spark, tmp_path, left, right, 30)
    assert sorted(map(tuple, found.collect()), key=repr) == plain


def test_many_differing_leaves_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hashtree, "_LISTED", 3)
    left = numbers(spark, 4000)
    plain, found = both(spark, tmp_path, left, left.where("k % 3 > 0"), 100)
    assert len(plain) > 1000 and sorted(map(tuple, found.collect()), key=repr) == plain


def test_equal_tables_written_apart_have_equal_nodes(spark, tmp_path):
    left = numbers(spark, 2000, copies=3)
    plain, found = both(spark, tmp_path, left, left.repartition(7).orderBy("w"), 50)
    assert plain == [] and found.count() == 0
    assert hashtree.differing_prefixes(spark, str(tmp_path / "l"), str(tmp_path / "r")) is None
