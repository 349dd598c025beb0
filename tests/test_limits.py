"""Sizes, names and line ends that must not change what is read."""

import pytest

from batchgate import run_batch
from batchgate.errors import BatchError
from batchgate.operators.compare import raw_bytes_differ
from batchgate.operators.contract import DEFAULT
from batchgate.plans import store as stores
from batchgate.sources import landing
from batchgate.sources.normalise import land
from deliveries import DAY, Landing


def as_folder(path, names):
    """Replace a delivered file by a folder of part files with the same rows."""
    header, *rows = path.read_text(encoding="utf-8").splitlines(keepends=True)
    path.unlink()
    path.mkdir()
    for k, name in enumerate(names):
        (path / name).write_text(header + "".join(rows[k::len(names)]), encoding="utf-8")


def test_control_text_of_any_length_lands_and_counts(spark, delivery, store, tmp_path):
    text = " " * 5000 + "44\n"
    delivery.control("A").write_text(text)
    land(spark, str(delivery), str(tmp_path / "landed"))
    assert (tmp_path / "landed/hospital_A.rows").read_text() == text
    assert run_batch(spark, str(tmp_path / "landed"), store, DAY)["input_rows"] == 88


@pytest.mark.parametrize("text,code", [
    ("9" * 50, "SOURCE_ROW_COUNT_MISMATCH"), ("0" * 60 + "44", None), ("4 4", "INVALID_CONTROL_FILE"),
])
def test_control_numbers_of_many_digits(spark, delivery, store, text, code):
    delivery.control("A").write_text(text)
    if code is None:
        assert run_batch(spark, str(delivery), store, DAY)["status"] == "COMMITTED"
    else:
        with pytest.raises(BatchError, match=code):
            run_batch(spark, str(delivery), store, DAY)


def test_every_part_of_a_control_folder_counts(spark, delivery, store):
    control = delivery.control("A")
    control.unlink()
    control.mkdir()
    (control / "part-0").write_text("44\n")
    assert run_batch(spark, str(delivery), store, DAY)["status"] == "COMMITTED"
    (control / "part-1").write_text("999\n")
    with pytest.raises(BatchError, match="INVALID_CONTROL_FILE"):
        run_batch(spark, str(delivery), store, DAY)


@pytest.mark.parametrize("quote", ["", '"'])
def test_header_longer_than_any_block(spark, tmp_path, quote):
    columns = [f"column_{k}_{'x' * 200}" for k in range(120)]
    Landing(tmp_path / "wide").fill()
    line = ",".join(f"{quote}{c}{quote}" for c in columns)
    for text, good in ((line + "\r\n1,2\n", True), (line, True), (line + "y\n", False),
                       (line + ",z\n", False), ("﻿" + line + "\n", False)):
        (tmp_path / "wide/hospital_A.csv").write_text(text, encoding="utf-8", newline="")
        found = landing.list_delivery(spark, str(tmp_path / "wide"), ["A"])[0]
        assert landing.has_header(spark, found, columns) is good


@pytest.mark.parametrize("names", [["part 1.csv", "a+b%20.csv"], ["hospital_A_0001.csv", "ü.csv"],
                                   ["hospital_B.csv", "x.csv"]])
def test_part_files_of_any_name(spark, delivery, store, names):
    path = delivery.file("A")
    as_folder(path, names)
    before = landing.input_fingerprint(spark, str(delivery), DEFAULT.sites)
    assert run_batch(spark, str(delivery), store, DAY)["source_sha256"] == before
    part = path / names[0]
    part.write_text(part.read_text(encoding="utf-8").replace(",90,", ",91,"), encoding="utf-8")
    assert landing.input_fingerprint(spark, str(delivery), DEFAULT.sites) != before


def test_line_ends_of_equal_size_differ(spark, tmp_path):
    one, two = Landing(tmp_path / "one").fill(), Landing(tmp_path / "two").fill()
    assert not raw_bytes_differ(spark, str(one), str(two), list(DEFAULT.sites))
    raw = two.file("A").read_bytes()
    first, second = raw.split(b"\r\n", 2)[:2]
    # A CR moves from the second line's end to the first line's.
    one.file("A").write_bytes(raw.replace(first + b"\r\n", first + b"\n", 1))
    two.file("A").write_bytes(raw.replace(second + b"\r\n", second + b"\n", 1))
    assert one.file("A").stat().st_size == two.file("A").stat().st_size
    assert raw_bytes_differ(spark, str(one), str(two), list(DEFAULT.sites))


def test_commit_record_of_any_size(spark, store):
    metrics = {"engine": {f"site{k}": "lines" for k in range(100_000)}}
    stores.commit(spark, store, "run1", DAY, "source", metrics, "key")
    assert stores.latest_commit(spark, store, DAY)["run_id"] == "run1"


def test_vacuum_leaves_what_readers_follow(spark, delivery, store):
    first = run_batch(spark, str(delivery), store, DAY)["run_id"]
    with pytest.raises(BatchError):
        run_batch(spark, str(delivery), store, DAY, fail_at="after_insert")
    last = run_batch(spark, str(delivery), store, DAY)["run_id"]
    digest = stores.digest_snapshot(spark, store, DAY)
    assert [r.run_id for r in stores.runs(spark, store).collect()][::2] == [first, last]
    failed = stores.vacuum(spark, store, keep=2)
    assert len(failed) == 1 and first not in failed and last not in failed
    assert stores.vacuum(spark, store) == [first]
    assert stores.vacuum(spark, store) == []
    assert stores.digest_snapshot(spark, store, DAY) == digest
    assert stores.runs(spark, store).count() == 3
