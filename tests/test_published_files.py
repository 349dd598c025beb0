"""Volume of the published tables."""

import pyarrow.parquet as pq
from deliveries import DAY

from batchgate import digest_snapshot, run_batch
from batchgate.plans import store as stores
from batchgate.plans.tables import TABLES
from batchgate.session import settings
from batchgate.sources import files


def test_published_tables_are_small_and_the_digest_can_be_recomputed(spark, delivery, store):
    with settings(spark, {"spark.sql.parquet.compression.codec": "snappy"}):
        report = run_batch(spark, str(delivery), store, DAY)
    assert digest_snapshot(spark, store, DAY) == report["snapshot_sha256"]
    for table in TABLES:
        for info in files.list_data_files(
                spark, stores.run_path(store, table, report["run_id"], DAY)):
            group = pq.ParquetFile(info.path.removeprefix("file:")).metadata.row_group(0)
            assert group.column(0).compression == "ZSTD"
