"""Gates, digests, comparisons, audit and JSON batches against brute force."""

import hashlib
import random
import statistics
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from deliveries import DAY, Landing, sample_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType, LongType, StringType, StructField, StructType,
)

from batchgate import quarantine_rows, run_batch, snapshot
from batchgate.operators import audit as expect
from batchgate.operators import gates
from batchgate.operators.compare import snapshot_diff
from batchgate.operators.digest import row_hash, table_digest, tree_depth, tree_digest
from batchgate.operators.median import medians
from batchgate.plans.store import latest_runs
from batchgate.session import batch_settings, wide_shuffles
from batchgate.sources.jsonbatch import expand_json, pack_json

_SLOW = settings(max_examples=12, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])
_SMALL = st.one_of(st.none(), st.integers(0, 3))


@_SLOW
@given(st.lists(st.tuples(_SMALL, _SMALL), max_size=30), st.sets(st.integers(0, 3)),
       st.lists(st.integers(0, 3), min_size=4, max_size=4))
def test_orphan_count_equals_joined_orphans(spark, rows, patients, owners):
    measured = spark.createDataFrame([("A", v, p) for v, p in rows], "h string, v int, p int")
    visits = spark.createDataFrame([("A", v, owners[v]) for v in (0, 1, 2)], "h string, v int, p int")
    known = spark.createDataFrame([("A", p) for p in patients], "h string, p int")
    expected = sum(
        1 for v, p in rows if v not in (0, 1, 2) or p not in patients or owners[v] != p)
    args = (measured, visits, known, ["h"], "v", "p")
    assert gates.orphan_count(*args).first().orphan_rows == expected
    assert gates.orphans(*args).count() == expected


@_SLOW
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 4), _SMALL), max_size=40))
def test_conflicts(spark, rows):
    frame = spark.createDataFrame(rows, "h string, k int, x int")
    copies = Counter((h, k) for h, k, _ in rows)
    found = gates.conflicting_keys(frame, ["h", "k"]).collect()
    assert {(r.h, r.k): r.rows for r in found} == {k: n for k, n in copies.items() if n > 1}
    values = {}
    for h, k, x in rows:
        values.setdefault((h, k), set()).add(x)
    several = {k for k, v in values.items() if len(v - {None}) > 1}
    found = gates.conflicting_values(frame, ["h", "k"], "x").collect()
    assert {(r.h, r.k) for r in found} == several
    counts = {r.table: r for r in gates.key_counts(
        {"one": frame, "two": frame.limit(0)}, {"one": ("h", "k"), "two": ("h", "x")}).collect()}
    if rows:
        assert counts["one"].rows == len(rows)
        assert counts["one"].conflicts == sum(n > 1 for n in copies.values())


def brute_digest(hashes, depth):
    """The tree with plain Python: nodes are sha256 over their sorted children's bytes."""
    nodes = [(h[:depth], bytes.fromhex(h)) for h in hashes]
    while depth > 0:
        depth = max(0, depth - 3)
        groups = {}
        for prefix, child in nodes:
            groups.setdefault(prefix, []).append(child)
        nodes = [(p[:depth], p.encode() + hashlib.sha256(b"".join(sorted(c))).digest())
                 for p, c in groups.items()]
    return hashlib.sha256(b"".join(sorted(c for _, c in nodes))).hexdigest()


@pytest.mark.parametrize("depth", [0, 1, 3, 4, 7])
def test_tree_digest(spark, depth):
    rng = random.Random(depth)
    hashes = [hashlib.sha256(rng.randbytes(8)).hexdigest() for _ in range(500)]
    rows = spark.createDataFrame([(i % 2, h) for i, h in enumerate(hashes)], "g int, h string")
    digest = tree_digest(rows, depth).first().digest
    assert digest == brute_digest(hashes, depth)
    assert tree_digest(rows.repartition(7).orderBy("h"), depth).first().digest == digest
    by = {r.g: r.digest for r in tree_digest(rows, depth, ["g"]).collect()}
    assert by == {g: brute_digest(hashes[g::2], depth) for g in (0, 1)}
    assert tree_digest(rows.limit(0), depth).first().digest == ""
    assert tree_digest(rows.limit(499), depth).first().digest != digest


def test_every_group_has_its_own_depth(spark, monkeypatch):
    """A group's digest stays what it is when other groups grow, copies included."""
    monkeypatch.setattr("batchgate.operators.digest._LEAF", 20)
    rng = random.Random(3)
    groups = {g: [hashlib.sha256(rng.randbytes(8)).hexdigest() for _ in range(n)]
              for g, n in ((0, 15), (1, 300), (2, 90_000), (3, 2))}
    rows = [(g, h) for g, own in groups.items() for h in own]
    frame = spark.createDataFrame(rows + [(3, groups[3][0])] * 999, "g int, h string")
    found = {r.g: r.digest for r in tree_digest(frame, by=["g"]).collect()}
    groups[3][0] = hashlib.sha256(f"{groups[3][0]}:1000".encode()).hexdigest()
    for (g, own), depth in zip(groups.items(), (0, 1, 4, 0)):
        assert found[g] == brute_digest(own, depth), g
        alone = tree_digest(frame.where(f"g = {g}").select("h")).first().digest
        assert alone == found[g]


def test_medians(spark):
    rng = random.Random(4)
    groups = {"a": [5.0] * 4000 + [rng.random() * 9 for _ in range(3000)],
              "b": [rng.gauss(0, 1) for _ in range(2001)], "c": [1.0, 2.0], "d": [7.0],
              None: [3.0, 1.0, 2.0]}
    rows = [(k, v) for k, own in groups.items() for v in own] + [("d", None), ("e", None)]
    rng.shuffle(rows)
    found = medians(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()
    assert {r.k: r.median for r in found if r.k} == {
        k: statistics.median(own) for k, own in groups.items() if k}


def test_row_hash_is_unambiguous(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a\\", "|b"), ("a", "\\|b"), (None, "x"), ("\\N", "x"),
            ("", "x"), ("x", None), ("x", "")]
    frame = spark.createDataFrame(rows, "a string, b string")
    assert frame.select(row_hash(["a", "b"]).alias("h")).distinct().count() == len(rows)
    assert table_digest(frame, ["a", "b"], 9).first().digest


def test_tree_depth():
    assert [tree_depth(n) for n in (0, 16384, 16385, 10**6, 10**12)] == [0, 0, 1, 2, 7]


@_SLOW
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30))
def test_snapshot_diff(spark, left, right):
    one = spark.createDataFrame([(x,) for x in left], "x int")
    two = spark.createDataFrame([(x,) for x in right], "x int")
    a, b = Counter(left), Counter(right)
    expected = {x: (a[x], b[x]) for x in a | b if a[x] != b[x]}
    found = {r.x: (r.left_rows, r.right_rows) for r in snapshot_diff(one, two).collect()}
    assert found == expected


def test_control_mismatch_and_missing_sites(spark):
    counts = spark.createDataFrame([("A", 5), ("B", 6), ("C", 1)], "hospital string, rows long")
    controls = spark.createDataFrame([("A", 5), ("B", 7), ("D", 2)], "hospital string, control_rows long")
    found = gates.control_mismatch(counts, controls, ["hospital"]).collect()
    assert sorted((r.hospital, r.rows, r.control_rows) for r in found) == [
        ("B", 6, 7), ("C", 1, None), ("D", None, 2)]
    expected = controls.select("hospital")
    assert [r.hospital for r in gates.missing_sites(counts, expected).collect()] == ["D"]


def test_gate_report_names_each_failure(spark):
    rows = spark.createDataFrame(
        [("A", "m1", "v1", "p1", 1980, None), ("A", "m1", "v1", "p2", 1980, None),
         ("A", "m2", "v2", "p1", 1981, None), ("A", None, None, None, None, "MISSING_FIELD")],
        "hospital string, measurement_id string, visit_id string, person_id string, "
        "birth_year int, reason string")
    clean = rows.where("reason is null")
    report = gates.gate_report(rows, clean, ["A", "B"], 0.1).orderBy("gate").collect()
    assert [(r.code, r.observed, r.passed) for r in report] == [
        ("EMPTY_BATCH", 4.0, True), ("REJECT_RATIO_EXCEEDED", 0.25, False),
        ("HOSPITAL_WITHOUT_VALID_ROWS", 1.0, False), ("CONFLICTING_MEASUREMENT", 1.0, False),
        ("CONFLICTING_PERSON", 1.0, False), ("CONFLICTING_VISIT", 1.0, False)]
    empty = gates.gate_report(rows.limit(0), clean.limit(0), ["A"], 0.1).orderBy("gate").collect()
    assert not empty[0].passed and not empty[1].passed


def test_expectations_ignore_nulls_and_count_rows(spark):
    frame = spark.createDataFrame(
        [(1, "a", None), (1, "b", 5), (2, "x", 50), (None, None, 7)], "k int, s string, v int")
    suite = [expect.row_count(5), expect.unique("k"), expect.not_null("k"),
             expect.matches("s", "^[ab]$"), expect.in_set("s", ["a", "x"]), expect.between("v", 5, 7)]
    rows = expect.evaluate(frame, "t", suite).orderBy("position").collect()
    assert [(r.evaluated, r.unexpected, r.success) for r in rows] == [
        (4, 1, False), (4, 2, False), (4, 1, False), (4, 1, False), (4, 1, False), (4, 1, False)]
    empty = expect.evaluate(frame.limit(0), "t", suite[1:]).collect()
    assert all(r.success and r.evaluated == 0 for r in empty)


def test_json_batches_are_strict(spark):
    schema = StructType([StructField("id", LongType()), StructField("t", StringType()),
                         StructField("v", DecimalType(18, 4))])
    rows = spark.createDataFrame([(0, 1, "x", Decimal("1.5000")), (0, 2, None, None)],
                                 "b int, id long, t string, v decimal(18,4)")
    packed = pack_json(rows, "b")
    assert expand_json(packed, schema).drop("b").exceptAll(rows.drop("b")).isEmpty()
    bad = spark.createDataFrame([('[{"id": 1}, {"id": "no"}]',)], "payload string")
    with pytest.raises(Exception):
        expand_json(bad, schema).collect()


def test_latest_run_per_date(spark):
    ledger = spark.createDataFrame(
        [("r1", "2026-01-01", "COMMITTED", 1), ("r2", "2026-01-01", "FAILED", 2),
         ("r3", "2026-01-01", "COMMITTED", 3), ("r4", "2026-01-02", "COMMITTED", 2)],
        "run_id string, batch_date string, status string, recorded_at int")
    assert sorted(r.run_id for r in latest_runs(ledger).collect()) == ["r3", "r4"]


def test_session_settings_follow_the_volume(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    split, cores = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
    before = [spark.conf.get(n, None) for n in (initial, split, cores)]
    with batch_settings(spark, 100 << 40), wide_shuffles(spark, 100 << 40):
        assert spark.conf.get(initial) == "40000"
        assert int(spark.conf.get(split)[:-1]) == (100 << 40) // 100000
        assert spark.conf.get(cores) == str(spark.sparkContext.defaultParallelism)
    with batch_settings(spark, 1 << 20), wide_shuffles(spark, 10 << 30):
        assert spark.conf.get(initial) == "40"
        assert spark.conf.get(split) == f"{128 << 20}b"
    assert [spark.conf.get(n, None) for n in (initial, split, cores)] == before


def test_hot_keys_stay_whole(spark, tmp_path):
    """A third of the rows are one row over, a third belong to one patient."""
    delivery, store = Landing(tmp_path / "landing"), str(tmp_path / "store")
    for site in "AB":
        rows = sample_rows(site, 3000, dirty=False)
        rows += [rows[0]] * 3000
        rows += [dict(r, patient_id="SYN-P-0", visit_id=f"SYN-V-{i + 9000}",
                      measurement_id=f"SYN-M-{i + 9000}") for i, r in enumerate(rows[:3000])]
        rows += [dict(rows[0], unit="x")] * 500
        delivery.write(site, rows)
    report = run_batch(spark, str(delivery), store, DAY)
    assert report["input_rows"] == 19000 and report["accepted_rows"] == 12000
    assert report["duplicate_rows"] == 6000 and report["rejected_rows"] == 1000
    assert report["counts"]["patient_snapshot"] == 3000
    persons = snapshot(spark, store, "measurement_snapshot", DAY).groupBy("person_id").count()
    assert sorted(r["count"] for r in persons.collect())[-2:] == [3002, 3002]
    lines = quarantine_rows(spark, store, report["run_id"]).where(F.col("hospital") == "A")
    assert [r.line for r in lines.collect()] == list(range(9002, 9502))
    assert snapshot(spark, store, "visit_snapshot").first().visit_date == date.fromisoformat(DAY)
