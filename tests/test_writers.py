"""Several writers of one store, its commit log, and the leases of runs under way."""

import json
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest

from batchgate import BatchError, run_batch, runs, snapshot
from batchgate.plans import store as stores
from batchgate.sources import files
from deliveries import DAY, Landing

OTHER = "2026-09-26"


def outcome(session, *args, **options):
    try:
        return run_batch(session, *args, **options)
    except BatchError as error:
        return str(error)


def race(spark, monkeypatch, jobs):
    """Run batches side by side that all start from the same commit."""
    start, waiting = threading.Barrier(len(jobs)), threading.local()
    plain = stores.head

    def head(session, store):
        number = plain(session, store)
        if not getattr(waiting, "done", False):
            waiting.done = True
            start.wait(60)
        return number

    monkeypatch.setattr(stores, "head", head)
    with ThreadPoolExecutor(len(jobs)) as pool:
        found = [pool.submit(outcome, spark.newSession(), *args, **options)
                 for args, options in jobs]
        found = [f.result() for f in found]
    monkeypatch.setattr(stores, "head", plain)
    return found


def test_two_batches_of_one_date(spark, delivery, store, tmp_path, monkeypatch):
    other = Landing(tmp_path / "other").fill(60)
    found = race(spark, monkeypatch, [((str(delivery), store, DAY), {}),
                                      ((str(other), store, DAY), {})])
    won = [f for f in found if isinstance(f, dict)]
    assert len(won) == 1 and "INTERNAL_ERROR" in found
    assert stores.digest_snapshot(spark, store, DAY) == won[0]["snapshot_sha256"]
    ledger = {r.status: r for r in runs(spark, store).collect()}
    assert ledger["COMMITTED"].run_id == won[0]["run_id"]
    assert json.loads(ledger["FAILED"].metrics_json)["overtaken_by"] == won[0]["run_id"]
    # A retry starts from the commit that won.
    assert run_batch(spark, str(delivery), store, DAY)["accepted_rows"] == 80
    assert stores.head(spark, store) == 2


def test_two_batches_of_two_dates(spark, delivery, store, tmp_path, monkeypatch):
    other = Landing(tmp_path / "other").fill(60, day=OTHER)
    found = race(spark, monkeypatch, [((str(delivery), store, DAY), {}),
                                      ((str(other), store, OTHER), {})])
    assert all(isinstance(f, dict) for f in found)
    for day, report in zip((DAY, OTHER), found):
        assert stores.digest_snapshot(spark, store, day) == report["snapshot_sha256"]
    assert sorted(r.number for r in stores.commit_log(spark, store).collect()) == [1, 2]
    assert files.list_names(spark, f"{store}/leases") == []


def test_first_commits_under_two_keys(spark, delivery, store, tmp_path, monkeypatch):
    other = Landing(tmp_path / "other").fill(60, day=OTHER)
    found = race(spark, monkeypatch, [
        ((str(delivery), store, DAY), {}),
        ((str(other), store, OTHER), {"key": b"another-test-key-12345"})])
    assert sum(isinstance(f, dict) for f in found) == 1 and "KEY_VERSION_MISMATCH" in found
    assert stores.commit_log(spark, store).count() == 1


def test_a_record_has_one_writer(spark, store):
    """Many threads after the same numbers: every commit gets its own, without gaps."""
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda k: stores.commit(
            spark, store, f"run{k}", str(date(2026, 1, 1) + timedelta(k)), "", {}, "key"),
            range(40)))
    assert sorted(numbers) == list(range(1, 41))
    log = {r.number: r.run_id for r in stores.commit_log(spark, store).collect()}
    assert log == {n: f"run{k}" for k, n in enumerate(numbers)}


def write_commits(store, first, last, days):
    """Records as commits leave them, written without a session."""
    from pathlib import Path
    for number in range(first, last + 1):
        path = Path(stores._record_path(store, number))
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({
            "number": number, "run_id": f"run{number}", "status": "COMMITTED", "key_id": "key",
            "batch_date": str(date(2000, 1, 1) + timedelta(number % days))}))


def test_checkpointed_log(spark, store):
    write_commits(store, 1, 2_500, 2_000)
    whole = sorted(tuple(r) for r in stores.commit_log(spark, store).collect())
    assert stores.head(spark, store) == 2_500 and len(whole) == 2_500
    assert stores.checkpoint(spark, store) == 2_500
    assert stores.checkpoint(spark, store) == 2_500
    write_commits(store, 2_501, 2_510, 2_000)
    assert stores.checkpoint(spark, store, every=500) == 2_500
    log = stores.commit_log(spark, store)
    # Of the records only the last folder's are read.
    read = [f for f in log.inputFiles() if f.endswith(".json")]
    assert len(read) == 511 and log.count() == 2_510
    assert sorted(tuple(r) for r in log.where("number <= 2500").collect()) == whole
    assert stores.latest_commit(spark, store, "2000-01-02")["run_id"] == "run2001"
    assert stores.latest_commit(spark, store, "2000-01-01")["run_id"] == "run2000"
    assert stores.latest_commit(spark, store, "2024-01-01") is None
    assert stores.newest_commits(log).count() == 2_000
    assert stores.newest_commits(log, 2).count() == 2_510
    assert stores.checkpoint(spark, store) == 2_510
    write_commits(store, 2_511, 2_512, 2_000)
    assert stores.checkpoint(spark, store) == 2_512
    # The one before the last stays for its readers.
    tables = [n for n in files.list_names(spark, f"{store}/checkpoints") if n[0] == "c"]
    assert [int(n.split("-")[1]) for n in tables] == [2_510, 2_512]


def test_empty_folder_of_the_next_thousand(spark, store, tmp_path):
    write_commits(store, 1, 999, 10)
    (tmp_path / "store/commits/0000001").mkdir()
    assert stores.head(spark, store) == 999
    assert stores.commit(spark, store, "next", DAY, "", {}, "key", None) == 1000
    assert stores.head(spark, store) == 1000


def test_vacuum_spares_a_run_under_way(spark, delivery, store, monkeypatch):
    plain, seen = stores.commit, []

    def commit(*args, **options):
        seen.append(stores.vacuum(spark, store))
        return plain(*args, **options)

    monkeypatch.setattr(stores, "commit", commit)
    report = run_batch(spark, str(delivery), store, DAY)
    assert seen == [[]]
    assert stores.digest_snapshot(spark, store, DAY) == report["snapshot_sha256"]


def test_a_lease_that_ran_out(spark, delivery, store, monkeypatch):
    plain, seen = stores.commit, []
    monkeypatch.setattr(stores, "take_lease", lambda *a, lease=stores.take_lease: lease(*a, -1))

    def commit(*args, **options):
        seen.append(stores.vacuum(spark, store))
        return plain(*args, **options)

    monkeypatch.setattr(stores, "commit", commit)
    with pytest.raises(BatchError, match="INTERNAL_ERROR"):
        run_batch(spark, str(delivery), store, DAY)
    assert len(seen[0]) == 1 and stores.head(spark, store) == 0
    assert snapshot(spark, store, "visit_snapshot").isEmpty()
