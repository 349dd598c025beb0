"""Phrase mining against a plain count of all phrases."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from batchgate.llm import phrases as p

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_count, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = tuple(re.findall("[^ \t]+", piece))
            total[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(w[i:i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        often = {w: a for w, a in c.items() if len(w) > 1 and a >= min_count}
        drop = {w[i:i + k] for w, a in often.items() for k in range(2, len(w))
                for i in range(len(w) - k + 1) if 100 * a >= 80 * c[w[i:i + k]]}
        scored = []
        for w, a in often.items():
            if w not in drop:
                score, k = min((2_000_000 * a // (c[w[:k]] + c[w[k:]]), k)
                               for k in range(1, len(w)))
                scored.append((-score, -a, " ".join(w).encode(), c[w[:k]], c[w[k:]]))
        out += [(lang, rank, name.decode(), -a, left, right, total[lang], -s)
                for rank, (s, a, name, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def mined(frame, **how):
    return sorted(tuple(r) for r in p.phrases(frame, **how).collect())


@given(st.lists(st.text(st.sampled_from("aB é.,\t\n\r\x0b界"), max_size=12), max_size=5))
@settings(max_examples=300, deadline=None)
def test_words_and_pieces(texts):
    got = p.tokens_of(texts)
    for text, numbers in zip(texts, got):
        want = [re.findall("[^ \t]+", x) for x in re.split("[.,;:!?\n-\r]", text.translate(LOWER))]
        want = [w for w in want if w]
        assert [len(w) for w in want] == [
            len(part) for part in np.split(numbers, np.flatnonzero(numbers == 0))
            for part in [part[part != 0]] if len(part)]
        flat = [w for piece in want for w in piece]
        one = p.tokens_of(flat)
        assert [x.tolist() for x in one] == [[n] for n in numbers[numbers != 0].tolist()]


def test_against_brute_force(spark, tables):
    docs = tables("documents")
    rows = list(zip(docs.lang.tolist(), docs.text.tolist()))
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for min_count, top, shards in ((8, 2000, 3), (5, 7, 2)):
        want = brute(rows, min_count, top)
        assert want and mined(frame, min_count=min_count, top=top, shards=shards) == want


def test_odd_texts(spark):
    rows = ([("en", "New York City hall")] * 3 + [("en", "new york, city hall")] * 2
            + [(None, None), ("", ""), ("xx", "   \t"), (None, "a a a a a a a"), ("und", "a a"),
               ("fr", "x" * 100_000 + " y " + "x" * 100_000 + " y"), ("en", "New york"),
               ("zh", "一 二 三 四 五 " * 50), ("zh", "界" * 5000)])
    frame = spark.createDataFrame(rows, "lang string, text string").selectExpr(
        "*", "1 as n", "'x' as key", "2 as lang_id", "3 as shard").repartition(4)
    want = brute(rows, 2)
    assert want and mined(frame, min_count=2) == want


def test_a_long_text_is_counted_in_overlapping_slices(spark, monkeypatch):
    rows = [("en", "one two three four five six seven " * 40), ("en", "two three four " * 9)]
    monkeypatch.setattr(p, "SLICE", 7)
    words = p.tokens_of([r[1] for r in rows])
    starts = np.zeros(1 << 10, np.uint8)  # everything counts from the start
    whole, sliced = Counter(), Counter()
    for text in words:
        for out, step in ((whole, len(text)), (sliced, 7)):
            for a in range(0, len(text), step):
                part = text[a:a + step + 3]
                for key, n, _ in p.slice_counts(part, 5, starts, 0, 3, min(step, len(part))):
                    for k, many in zip(key.tolist(), n.tolist()):
                        out[tuple(k)] += many
    assert whole == sliced and sum(whole.values()) > 1000


@pytest.mark.parametrize("rows", [[], [("en", None)], [("en", "one two")]])
def test_nothing_frequent(spark, rows):
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert mined(frame) == []


def test_full_activation_array_changes_nothing(spark, monkeypatch, tables):
    """With one place for all phrases everything is counted, with the same result."""
    docs = tables("documents").head(60)
    rows = list(zip(docs.lang.tolist(), docs.text.tolist()))
    frame = spark.createDataFrame(rows, "lang string, text string")
    want = brute(rows, 6)
    monkeypatch.setattr(p, "PLACE_BITS", (1, 1))
    assert want and mined(frame, min_count=6) == want


@pytest.mark.parametrize("bits", [4, 8])
def test_shared_places_cut_no_cycle_short(spark, monkeypatch, bits):
    """A phrase whose place was taken early starts with its parts, and so do its extensions.

    Rare words reach the threshold in the last shard, after phrases that share their places.
    """
    rng = np.random.default_rng(5)
    rows = [("en", " ".join(f"{x}{k}" for x in "abcde"[:rng.integers(2, 6)]))
            for k in range(60) for _ in range(int(rng.integers(2, 40)))]
    rng.shuffle(rows)
    rows = [(str(a), str(b)) for a, b in rows]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = brute(rows, 8)
    monkeypatch.setattr(p, "PLACE_BITS", (bits, bits))
    assert want and mined(frame, min_count=8) == want
