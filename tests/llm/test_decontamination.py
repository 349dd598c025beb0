import hashlib
import re

import pytest

from batchgate.llm import decontamination as d


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[a:a + window]), set()).add(item)
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                own = windows.get(tuple(w[a:a + n]))
                if own is not None:
                    hit.update(range(a, a + n))
                    found |= {str(i) for i in own if i is not None}
        out.append((len(w), len(hit), sorted(found)))
    return out


ITEMS = [(1, "a b c"), (2, "b"), (3, "The of and in. to be is on at by with a"), (4, ""), (5, None),
         (None, "ab cd"), (7, "été 9 x_y"), (8, "z " * 30), (3, "u v w u v w u v w u v w")]
DOCS = ["x A b, c b! c a b c", "q of and in to be is on at by with a b", "", None,
        "b b ab cd the of and in to be is on at by", "ÉTÉ été 9 X-Y", "z " * 12, "z " * 9,
        "q " * 5000 + "to be is on at by with a " * 3, "u v w u v w u v w u v"]


@pytest.mark.parametrize("block_words", [d.BLOCK_WORDS, 4])
@pytest.mark.parametrize("window", [10, 3])
def test_against_brute_force(spark, block_words, window):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(DOCS)] + [(None, "a b c", "x")],
                                 "doc_id long, text string, spans string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = d.contamination(docs, items, window, block_words).collect()
    want = brute([*DOCS, "a b c"], ITEMS, window)
    for r in rows:
        own = want[len(DOCS) if r.doc_id is None else r.doc_id]
        assert (r.n_words, sum(b - a for a, b in r.spans), r["items"]) == own, r.doc_id
    assert len(rows) == len(want)


def test_query_columns(spark, tables):
    docs, items = tables("documents"), tables("benchmark")
    rows = d.op7_benchmark_decontamination(
        spark.createDataFrame(docs), spark.createDataFrame(items)).collect()
    want = dict(zip(docs.doc_id, brute(docs.text, list(zip(items.item_id, items.text)))))
    for r in rows:
        n, hit, found = want[r.doc_id]
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            n, hit, len(found), digest, hit > 0)


@pytest.mark.parametrize("block_words", [d.BLOCK_WORDS, 4])
def test_cleaned_documents_hit_nothing(spark, block_words):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(DOCS)],
                                 "doc_id long, text string, gone string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = d.decontaminate(docs, items, block_words=block_words)
    got = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == docs.columns and len(got) == len(DOCS)
    hit = {k for k, (_, n, _) in enumerate(brute(DOCS, ITEMS)) if n}
    for k, text in enumerate(DOCS):
        if k not in hit:
            assert got[k].text == text
    if block_words == d.BLOCK_WORDS:
        assert all(n == 0 for _, n, _ in brute([r.text for r in got.values()], ITEMS))
    covered = {r.doc_id for r in d.decontaminate(docs, items, max_coverage=0.5).collect()}
    assert covered == {k for k, (n, h, _) in enumerate(brute(DOCS, ITEMS)) if h <= n / 2}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert d.op7_benchmark_decontamination(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert d.op7_benchmark_decontamination(some, items).first().contaminated is False
