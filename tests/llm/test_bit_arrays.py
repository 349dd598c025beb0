"""Bit arrays reach the driver in a few jobs, whatever the number of shuffle partitions."""

import numpy as np
import pytest

from batchgate.llm import membership, phrases


@pytest.fixture
def iterated(spark, monkeypatch):
    """Partitions of the frames that the driver iterates over, with many shuffle partitions."""
    many = {"spark.sql.shuffle.partitions": "60",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in many}
    seen, frame = [], type(spark.range(0))
    plain = frame.toLocalIterator

    def noted(self, *args, **how):
        seen.append(self.rdd.getNumPartitions())
        return plain(self, *args, **how)

    monkeypatch.setattr(frame, "toLocalIterator", noted)
    for k, v in many.items():
        spark.conf.set(k, v)
    yield seen
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_places_of_phrases(spark, iterated):
    keys = np.arange(1, 4001, dtype=np.uint64).reshape(-1, 2) * np.uint64(0x9E3779B97F4A7C15)
    frame = spark.createDataFrame([(k.tobytes(),) for k in keys], "key binary")
    got = phrases.marked(frame, 22)
    want = np.zeros(1 << 22, bool)
    want[phrases.places(list(keys.T), 22)] = True
    assert (got == want).all()
    assert iterated and max(iterated) <= 8


def test_places_of_numbers(spark, iterated):
    frame = spark.range(5000).selectExpr("id * 7919 as n")
    bits = membership.bit_array(frame, "n", membership.own_spot)
    spots = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
    assert spots.tolist() == sorted(n * 7919 % membership.BITS for n in range(5000))
    assert iterated and max(iterated) <= 8
