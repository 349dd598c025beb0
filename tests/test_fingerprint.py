"""The tree over line digests against hashlib, and against lines made to collide."""

import hashlib
import random

import pytest
from deliveries import DAY, Landing
from pyspark.sql import functions as F

from batchgate import input_fingerprint, run_batch
from batchgate.sources import fingerprint, landing

MASK = (1 << 64) - 1
P1, P2, P4 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63
P5 = 0x27D4EB2F165667C5


def rotated(x, n):
    return (x << n | x >> 64 - n) & MASK


def mixed(word):
    return rotated(word * P2 & MASK, 31) * P1 & MASK


def unmixed(x):
    return rotated(x * pow(P1, -1, 1 << 64) & MASK, 33) * pow(P2, -1, 1 << 64) & MASK


def step(state, word):
    return (rotated(state ^ mixed(word), 27) * P1 + P4) & MASK


def colliding_lines():
    """Two lines of sixteen visible characters with one 64-bit hash, from its inverse."""
    start = (42 + P5 + 16) & MASK
    rng = random.Random(5)
    one = b"value=10value=20"
    first, second = (int.from_bytes(one[k:k + 8], "little") for k in (0, 8))
    end = step(start, first) ^ mixed(second)
    while True:
        head = bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(8))
        tail = unmixed(step(start, int.from_bytes(head, "little")) ^ end).to_bytes(8, "little")
        if all(33 <= b < 127 and b != 34 for b in tail):
            return one.decode(), (head + tail).decode()


def root_of(lines, leaf=fingerprint.LEAF):
    sha = lambda x: hashlib.sha256(x).digest()
    level = [sha(x.encode()) for x in lines]
    most = max(1, len(level))
    while True:
        level = [sha(b"".join(level[k:k + leaf]))
                 for k in range(0, len(level), leaf)]
        most = -(-most // leaf)
        if most == 1:
            return level[0].hex()


@pytest.mark.parametrize("split,differ", [("100000000", 1), ("3000", 1), ("70000", 0)])
@pytest.mark.parametrize("count", [1, 1023, 1024, 1025, 5000])
def test_roots(spark, tmp_path, split, differ, count):
    lines = [f"{k * differ},{k % 7}" for k in range(count)]
    path = tmp_path / "hospital_A.csv"
    path.write_text("\n".join(lines), newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        landing.read_lines(spark, [str(path)]).select(
            "hospital", "file", "block", "mid",
            fingerprint.line_digest(F.col("value")).alias("line_digest")).write.parquet(
            str(tmp_path / "digests"))
        digests = spark.read.parquet(str(tmp_path / "digests"))
        blocks = landing.with_offsets(
            landing.line_counts(digests, ("hospital", "file", "block")))
        got = landing.file_summary(blocks, digests)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.file, r.lines, r.root) for r in got] == [(path.name, count, root_of(lines))]


@pytest.mark.parametrize("count", [4, 5, 16, 17, 300])
def test_several_levels(spark, count):
    lines = [f"line {k}" for k in range(count)]
    digests = spark.createDataFrame(
        [("A", "f", 0, k, hashlib.sha256(x.encode()).digest()) for k, x in enumerate(lines)],
        "hospital string, file string, block long, mid long, line_digest binary")
    blocks = landing.with_offsets(landing.line_counts(digests, ("hospital", "file", "block")))
    got = fingerprint.file_roots(digests, blocks, count, leaf=4).collect()
    assert [r.root for r in got] == [root_of(lines, 4)]


def test_lines_made_to_collide_are_told_apart(spark, tmp_path):
    one, two = colliding_lines()
    pair = spark.createDataFrame([(one,), (two,)], "value string")
    assert one != two and pair.select(landing.line_hash(F.col("value"))).distinct().count() == 1
    delivery = Landing(tmp_path / "landing").fill()
    text = delivery.file("A").read_text(encoding="utf-8")
    seen = set()
    for line in (one, two):
        delivery.file("A").write_text(text + line + "\r\n", encoding="utf-8", newline="")
        seen.add(input_fingerprint(spark, str(delivery), ["A", "B"]))
    assert len(seen) == 2


def test_a_batch_names_the_same_value(spark, tmp_path):
    delivery = Landing(tmp_path / "landing").fill(3000)
    seen = input_fingerprint(spark, str(delivery), ["A", "B"])
    report = run_batch(spark, str(delivery), str(tmp_path / "store"), DAY,
                       expected_fingerprint=seen)
    assert report["source_sha256"] == seen


def test_an_empty_file_has_no_root(spark, tmp_path):
    delivery = Landing(tmp_path / "landing").fill()
    seen = input_fingerprint(spark, str(delivery), ["A", "B"])
    delivery.file("B").write_bytes(b"")
    assert input_fingerprint(spark, str(delivery), ["A", "B"]) != seen
