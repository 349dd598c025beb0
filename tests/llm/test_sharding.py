import zlib

from pyspark.sql import functions as F

from batchgate.llm import sharding


def test_shards_hold_all_records(spark):
    texts = [None, "", "é", "same", "same", "long " * 50_000] + [f"t{k}" for k in range(300)]
    rows = [(None if k % 7 == 0 else k // 2, t, "s", k) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string, k long")
    written = sharding.shard(frame.repartition(3, "k"), 8, bucket_bytes=2_000)
    got = written.collect()
    assert sorted((r.k, r.text, r.doc_id, r.shard) for r in got) == sorted(
        ((k, t, d, s) for d, t, s, k in rows), key=lambda x: x[0])
    counts = [sorted(r["_slot"] if "_slot" in r else r.slot for r in got if r["_shard"] == s)
              for s in range(8)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    # Neighbours in a shard are not neighbours in the input.
    first = [r.k for r in sorted(got, key=lambda r: r.slot) if r["_shard"] == 0]
    assert first != sorted(first)


def test_digest_columns(spark, tables):
    docs = tables("documents")
    rows = sharding.op6_sharding(spark.createDataFrame(docs)).collect()
    texts = dict(zip(docs.doc_id, docs.text))
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "rows")
        assert r.grown_shard is None


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.op6_sharding(frame).count() == 0


def test_main_path_is_native(spark, tables):
    frame = spark.createDataFrame(tables("documents")).limit(20)
    plan = sharding.op6_sharding(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_buckets_share_no_task(spark):
    for buckets, tasks in [(17, 100), (96, 96), (40, 8)]:
        numbered = spark.range(20_000).withColumn("bucket", F.expr(f"cast(id % {buckets} as int)"))
        placed = sharding.scatter(numbered, "bucket", buckets, tasks)
        got = placed.groupBy(F.spark_partition_id().alias("task"), "bucket").count().collect()
        assert len(got) == buckets
        sizes = {}
        for r in got:
            sizes.setdefault(r.task, []).append(r["count"])
        assert len(sizes) == min(buckets, tasks)
        assert max(sum(s) for s in sizes.values()) <= 2 * 20_000 / len(sizes)


def test_more_buckets_than_tasks(spark):
    frame = spark.range(5_000).selectExpr("id AS doc_id", "repeat('x', cast(id % 90 as int)) AS text")
    written = sharding.shard(frame, 3, bucket_bytes=2_000, max_tasks=4)
    rows = written.collect()
    assert sorted(r.doc_id for r in rows) == list(range(5_000))
    slots = [sorted(r.slot for r in rows if r["shard"] == s) for s in range(3)]
    assert all(s == list(range(len(s))) for s in slots)
    assert spark.conf.get("spark.sql.execution.useObjectHashAggregateExec") == "true"


def test_scatter_is_the_only_shuffle_of_texts(spark):
    numbered = spark.range(100).selectExpr("id", "cast(id % 7 as int) AS bucket")
    grouped = sharding.scatter(numbered, "bucket", 7, 7).groupBy("bucket").agg(
        F.collect_list("id").alias("ids"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
