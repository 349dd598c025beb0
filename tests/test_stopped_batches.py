"""Batches that their files have stopped, and the broken deliveries they are tried with."""

from datetime import datetime, timedelta

import pytest
from deliveries import DAY

from batchgate import BatchError, run_batch, runs
from batchgate.catalogue import queries
from batchgate.plans import batch as batch_plan
from batchgate.plans import stage as stage_plan
from batchgate.sources import files


@pytest.fixture(scope="module")
def events_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("events"))
    rows = [(k, datetime(2024, 1, 10) + timedelta(minutes=k), k % 40, "click", k / 7, "{}")
            for k in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, "
                          "event_type string, value double, props string").write.parquet(
        f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("damage, code, input_rows", [
    (lambda d: d.control("B").write_text("many\n"), "INVALID_CONTROL_FILE", 88),
    (lambda d: d.file("B").write_text("a,b\n1,2\n"), "SCHEMA_MISMATCH", 44),
    (lambda d: (d.control("B").write_text("many\n"), d.control("A").write_text("7\n")),
     "SOURCE_ROW_COUNT_MISMATCH", 44),
    (lambda d: (d.control("B").write_text("many\n"), d.append("A", '"two\nlines"\n', 45)),
     "INVALID_CONTROL_FILE", 89),
])
def test_rows_of_a_batch_that_files_have_stopped_are_not_typed(
        spark, delivery, store, monkeypatch, damage, code, input_rows):
    """The site's files that come first name the code; rows are counted all the same."""
    damage(delivery)
    asked = []

    def staged(*args):
        asked.append(args[-1])
        return stage_plan.stage(*args)

    monkeypatch.setattr(batch_plan, "stage", staged)
    with pytest.raises(BatchError) as caught:
        run_batch(spark, str(delivery), store, DAY)
    assert str(caught.value) == code and asked == [False]
    ledger = runs(spark, store).collect()
    assert [r.status for r in ledger] == ["FAILED"]
    assert f'"input_rows": {input_rows}' in ledger[0].metrics_json


def test_broken_deliveries_are_made_without_copying(spark, events_dir, monkeypatch):
    monkeypatch.setattr(files, "copy", lambda *a: pytest.fail("a delivery was copied"))
    found = {r["case"]: tuple(r)[2:] for r in queries.gate_matrix(spark, events_dir).collect()}
    assert len(found) == 9 and set(found.values()) == {("FAILED", 1, 0)}
