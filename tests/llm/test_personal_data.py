"""Patterns against a plain search, Viterbi against all taggings, the field on held-out rows."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from batchgate.llm import personal_data as p

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    pairs = [divmod(int(c) * (1 + k % 2), 10) for k, c in enumerate(reversed(digits))]
    return sum(map(sum, pairs)) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


@given(st.text(st.sampled_from("a@.%-+ 0é1259(\n"), max_size=40))
@settings(max_examples=3000, deadline=None)
def test_patterns_of_odd_texts(text):
    assert p.base_spans(text) == brute(text)


@given(st.text(st.sampled_from("04 -"), min_size=10, max_size=30))
@settings(max_examples=1000, deadline=None)
def test_cards(text):
    assert p.base_spans(text) == brute(text)


@given(st.text(st.sampled_from("1250.."), max_size=40))
@settings(max_examples=1000, deadline=None)
def test_addresses(text):
    assert p.base_spans(text) == brute(text)


def test_patterns_of_documents(tables):
    texts = tables("documents").text.tolist()
    found = [p.base_spans(t) for t in texts]
    assert sum(map(len, found)) > 10 and found == [brute(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "@" * 100_000, "a@" * 100_000,
                                  "1." * 200_000, "+1" * 100_000, "a.b@c" * 50_000])
def test_patterns_take_linear_time(text):
    p.base_spans(text)  # a search from every place would take hours


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_finds_the_best_of_all_taggings(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    tags = 3
    moves = rng.normal(size=(tags + 1, tags))
    lengths = np.array([1, 4, 2, 5])
    scores = rng.normal(size=(4, 5, tags))
    got = p.viterbi(scores, lengths, moves)
    for k, n in enumerate(lengths):
        def value(t):
            return (moves[tags, t[0]] + scores[k, range(n), t].sum() + moves[t[-1], 0]
                    + sum(moves[a, b] for a, b in zip(t, t[1:])))
        best = max(itertools.product(range(tags), repeat=int(n)), key=value)
        assert got[k, :n].tolist() == list(best) and not got[k, n:].any()


def test_training_climbs_the_likelihood():
    """The slope is that of the likelihood: the tags' own chains become the likely ones."""
    rows = p.labelled_rows(60, seed=3)
    field = p.fit(rows, steps=200, decay=0.0)
    for words, tags in rows:
        best = p.viterbi(field.scores(words)[None], np.array([len(words)]), field.moves)[0]
        assert [p.TAGS[t] for t in best] == tags


def test_held_out_accuracy():
    rows = p.labelled_rows(1000, seed=23)
    field = p.fit(rows[:700])
    right = wrong = missed = 0
    for words, tags in rows[700:]:
        best = p.viterbi(field.scores(words)[None], np.array([len(words)]), field.moves)[0]
        got = set(p.tagged(best.tolist()))
        want = set(p.tagged([p.TAGS.index(t) for t in tags]))
        right, wrong, missed = (right + len(got & want), wrong + len(got - want),
                                missed + len(want - got))
    assert right > 100 and wrong < 0.03 * right and missed < 0.05 * right


def test_chains_of_a_text_equal_the_whole_chain_with_the_rest_left_out():
    """Words out of reach are O by definition: the whole text's best tagging under that."""
    field = p.fit(p.labelled_rows())
    text = ("an der on phone: (017) 555-7713 in the ti " + "plain words here " * 5
            + "write to ana [at] mail [dot] com now " + "more of these " * 4 + "card 3782-8224 x 1")
    words = re.findall(r"\S+", text)
    tells = [k for k, w in enumerate(words)
             if re.search("[0-9@]", w) or w.strip("[](){}<>") in ("dot", "DOT", "Dot")]
    near = [any(abs(k - t) <= p.REACH for t in tells) for k in range(len(words))]
    scores = field.scores(words)
    for k, ok in enumerate(near):
        if not ok:
            scores[k, 1:] = -1e6
    best = p.viterbi(scores[None], np.array([len(words)]), field.moves)[0].tolist()
    first, behind, _ = p.chains(text)
    assert [text[a:b] for a, b in zip(first, behind)] == words
    want = []
    for kind, a, b in p.tagged(best):
        x, y = int(first[a]), int(behind[b - 1])
        cut = p.stripped(text[x:y])
        if p.accepted(kind, text[x + cut[0]:x + cut[1]]):
            want.append((kind, x + cut[0], x + cut[1]))
    got = p.added_spans(field, [text], [p.base_spans(text)])[0]
    assert sorted(got) == sorted(want) and {k for k, _, _ in got} >= {"phone", "email"}


def test_other_spellings_are_added_and_base_spans_stay(spark):
    texts = ["écrire: ana [at] mail [dot] com, merci", "tel 030 1234567 or mail x.1@b.example.org",
             "+1 (377) 555-0271 at 10.0.0.1", "no dot here, order 1234567 and 4736962573099581",
             None, "", "   ", "é" * 50_000 + " a@b.c " + "1 " * 50_000, "ana at mail dot com",
             "ana at mail dot com", "version 1.2.3.400 on 2024-01-05 at 10:30"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "a@b.c"), (3, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' as spans", "1 as n_email").repartition(3)
    got = sorted(p.op13_personal_data(frame).collect(), key=lambda r: (r.doc_id is None, repr(r)))
    assert len(got) == len(rows)
    by_text = {k: t for k, t in rows[:-2]}
    for r in got:
        if r.doc_id is None or r.doc_id == 3 and r.spans == "":
            continue
        text = by_text[r.doc_id] or ""
        base = brute(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for k, _, _ in base) for kind in p.KINDS]
        assert r.base_sha256 == hashlib.sha256(p.written(base).encode()).hexdigest()
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= {":".join(s) for s in spans}
    assert {r.doc_id: r.spans for r in got}[0] == "email:8:31"
    assert texts[0][8:31] == "ana [at] mail [dot] com"
    assert {r.doc_id: r.spans for r in got}[10] == ""


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert p.find(frame).count() == 0


def test_documents_gain_no_false_spans(spark, tables):
    """The given texts hold the four kinds in their usual form only."""
    frame = spark.createDataFrame(tables("documents")[["doc_id", "text"]])
    for r in p.find(frame).collect():
        n = r.n_email + r.n_ip + r.n_card + r.n_phone
        assert len([s for s in r.spans.split(",") if s]) == n
