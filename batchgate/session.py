"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.codegen.cache.maxEntries": "2000",
}

# The JVM compiles no method above 8000 bytes of bytecode.  The row contract fused into one
# generated method is larger and would run interpreted, three times slower; with this limit
# Spark generates smaller pieces instead.
COMPILED_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# The token key's pads are literals of the plan.  Within these settings neither plan texts nor
# the event log's plan trees show them: texts blank out long hex numbers, trees leave out the
# lists of expressions.
SECRET_PLANS = {
    "spark.sql.redaction.string.regex": "(?i)[0-9a-f]{128}",
    "spark.sql.debug.maxToStringFields": "0",
}


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the local benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("batchgate")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in (SETTINGS | COMPILED_METHODS).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# A shuffle costs map tasks times reduce tasks; both grow with the volume up to a number
# that keeps this product and the driver's map statuses in hand.  Beyond it tasks get
# larger and spill.
_BYTES_PER_REDUCER = 256 << 20
# Session settings of one's own name raise these defaults: batchgate.maxReducers, .maxSplits.
_MAX_REDUCERS = 40_000
_MAX_SPLITS = 100_000


def _limit(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"batchgate.{name}", str(default)))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a block, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def batch_settings(spark: SparkSession, input_bytes: int):
    """Settings for one delivery, put back afterwards.

    Two scans must cut its files into the same splits: Spark sizes them by the cores of the
    moment, so that number is fixed at the start.  Generated code is kept compilable.
    """
    largest, cores = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    split = max(to_bytes(spark.conf.get(largest)), input_bytes // _limit(spark, "maxSplits", _MAX_SPLITS))
    number = spark.conf.get(cores, None) or str(spark.sparkContext.defaultParallelism)
    return settings(spark, COMPILED_METHODS | SECRET_PLANS | {
        largest: f"{split}b", cores: number})


def wide_shuffles(spark: SparkSession, input_bytes: int):
    """Within it, shuffles start with partitions for the volume; AQE merges small ones.

    Only for shuffles of whole rows or keys: small aggregations need no such width.
    """
    reducers = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                   min(_limit(spark, "maxReducers", _MAX_REDUCERS),
                       input_bytes // _BYTES_PER_REDUCER))
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    return settings(spark, {initial: str(reducers)})


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for tables that cut lineage, in the area all executors share.

    The cluster names that area in ``spark.checkpoint.dir``; only where it is unset, as in
    local tests, a temporary folder of this machine stands in.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="batchgate-")
    return f"{shared.rstrip('/')}/batchgate-{uuid.uuid4().hex}"
