"""What publishing leaves undone because it is known already, with the same results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from batchgate.catalogue import queries
from batchgate.operators.digest import tree_digest


@pytest.fixture(scope="module")
def events_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("events"))
    rows = [(k, datetime(2024, 1, 10) + timedelta(minutes=k), k % 40, "click", k / 7, "{}")
            for k in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, "
                          "event_type string, value double, props string").write.parquet(
        f"{root}/events.parquet")
    return root


def test_distinct_rows_have_the_same_digest_without_counting_copies(spark):
    hashes = spark.range(50_000).select(
        (F.col("id") % 3).alias("table"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    both = [tree_digest(hashes, 2, ["table"], distinct) for distinct in (False, True)]
    plain, known = (sorted(map(tuple, d.collect())) for d in both)
    assert plain == known and len(known) == 3
    shuffles = [d._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") for d in both]
    assert shuffles[1] == shuffles[0] - 1


def test_a_replayed_delivery_is_written_once(spark, events_dir, monkeypatch):
    written, deliver = [], queries.deliver_files
    monkeypatch.setattr(
        queries, "deliver_files", lambda *a: (written.append(1), deliver(*a))[1])
    (row,) = queries.publish_replay(spark, events_dir).collect()
    assert written == [1] and (row["status"], row["runs"], row["digests"]) == ("COMMITTED", 2, 1)
