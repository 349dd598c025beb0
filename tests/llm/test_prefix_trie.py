"""The prefix trie against a dictionary of all beginnings."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from batchgate.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(t)] for c, t in by.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = ({k: 0 for k in members} for _ in range(3))
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, m in members.items():
        weight = (len(m) - 1) * len(k[-1][1]) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += weight
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k],
                    leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def built(frame, **how):
    rows = p.trie(frame, **how).drop("digest").collect()
    return sorted((tuple(r[c] for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")) for r in rows), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 50_000])
def test_slots_are_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    assert sorted(p.minimal_perfect_hash(keys).tolist()) == list(range(n))


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        p.minimal_perfect_hash(np.ones((2, 2), np.uint64))


def test_against_brute_force(spark, tables):
    rows = [tuple(r) for r in tables("conversations")[
        ["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert len(want) > 20 and built(frame) == want
    assert built(frame, segment=2, shard_turns=7) == want


def test_shared_beginnings_copies_and_long_conversations(spark):
    """Most conversations share turns; segments and shards are smaller than they are."""
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 60), *range(100, 130), 250, 3_000_000_001]:
        for turn in range(rng.choice([1, 2, 5, 7, 12])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice("ab")))
    for c in range(300, 340):  # one large group of copies
        rows += [(c, t, "user", "same é" * (t + 1)) for t in range(8)]
    rows += [(400, t, "user", f"t{t}") for t in range(150)]
    rows += [(c, t, "user", f"t{t}") for c in (401, 402, 403) for t in range(120 + c % 100)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows)
    for segment, turns in ((4096, 200_000), (3, 20), (10, 100), (1, 5)):
        assert built(frame, segment=segment, shard_turns=turns) == want, segment


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 1, "user", "x"), (1, 1, "user", "x"), (None, 1, "user", "y"),
            (7, 5, "a", ""), (7, 5, "", "a"), (8, -3, "user", "long " * 100_000), (-5, 0, "u", "v"),
            (-5, 1, "u", "w"), (9, 0, None, ""), (100, 0, "u", "1"), (105, 0, "q", "2"),
            (105, 1, "q", "3"), (105, 2, "q", "4"), (105, 3, "q", "5"), (105, 4, "q", "6")]
    rows += [(c, 0, "u", "1") for c in range(110, 130)]  # some are left without turns
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as digest", "2 as depth", "3 as shard", "4 as at").repartition(3)
    convs = [r for r in rows if r[0] is None or r[0] >= 0]
    assert any(not t for t in rebuilt(convs).values())
    assert built(frame.where("conv_id is null or conv_id >= 0")) == brute(convs)
    negative = [r for r in rows if r[0] == -5]  # -5 % 100 is -5 in SQL: its family is 0
    assert len(built(frame.where("conv_id = -5"))) <= len(negative) + 1


def test_empty_table(spark):
    assert p.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert p.trie(spark.createDataFrame([(None, 0, "u", "x")], SCHEMA)).count() == 0
