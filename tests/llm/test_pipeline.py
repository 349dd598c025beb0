import sys
from pathlib import Path

import pandas as pd
import pytest

from batchgate.llm.common import staged
from test_decontamination import brute as contamination
from test_line_dedup import brute as templates
from test_line_dedup import without
from test_ngram_join import brute as groups

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory, tables):
    """Some documents with planted cases, and the benchmark."""
    path = tmp_path_factory.mktemp("corpus")
    docs = tables("documents").head(120)
    item = tables("benchmark").text[0]
    body = docs.text[3]
    many = [f"some text number {k} that stands\n{docs.text[k]}" for k in range(4, 9)]
    planted = [body, body + " end", item, f"before {' '.join(reversed(docs.text[5].split()))} {item} after", None, "", "12 !!",
               "one two three four five six", "one two three four five six"]
    planted += [m + "\nAll rights are reserved by these people\n" + docs.text[20 + k]
                for k, m in enumerate(many)]
    more = pd.DataFrame({"doc_id": range(10_000, 10_000 + len(planted)), "text": planted,
                         "lang": "en", "source": "planted"})
    more["n_chars"] = more.text.str.len()
    docs = pd.concat([docs, more], ignore_index=True)
    docs["n_chars"] = docs.n_chars.astype("Int64")
    docs.to_parquet(path / "documents.parquet")
    tables("benchmark").to_parquet(path / "benchmark.parquet")
    return str(path)


def test_every_stage_against_a_plain_version(spark, folder, tables):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    rows = lambda frame: {r.doc_id: r for r in frame.collect()}

    out = staged(STAGES[names[0]](spark, docs, folder))
    before, after = rows(docs), rows(out)
    assert out.columns == COLUMNS
    assert before.keys() - after.keys() == {10_004, 10_005, 10_006}
    assert all(after[k] == before[k] for k in after)

    docs, before = out, after
    out = staged(STAGES[names[1]](spark, docs, folder))
    after = rows(out)
    drop = templates([r.text for r in before.values()])
    assert tuple("All rights are reserved by these people".split()) in drop
    want = {k: without(r.text, drop) for k, r in before.items()}
    assert {k: r.text for k, r in after.items()} == {
        k: t for k, (t, n) in want.items() if t or not n}
    assert all(r.n_chars == len(r.text) for r in after.values())

    docs, before = out, after
    out = staged(STAGES[names[2]](spark, docs, folder))
    after = rows(out)
    ids = sorted(before)
    first = [ids[g] for _, g in groups([before[k].text for k in ids])]
    assert after.keys() == {k for k, g in zip(ids, first) if k == g}
    assert {10_000, 10_001, 10_008} & after.keys() == set() and 10_007 in after

    docs, before = out, after
    out = staged(STAGES[names[3]](spark, docs, folder))
    after = rows(out)
    items = list(zip(tables("benchmark").item_id, tables("benchmark").text))
    hit = dict(zip(before, contamination([r.text for r in before.values()], items)))
    assert before.keys() - after.keys() == {k for k, (n, h, _) in hit.items() if n and n == h}
    assert 10_002 not in after and "before" in after[10_003].text
    assert not any(h for _, h, _ in contamination([r.text for r in after.values()], items))
    assert all(after[k] == before[k] for k in after if not hit[k][1])
    assert all(r.n_chars == len(r.text) for r in after.values())

    packed = STAGES[names[4]](spark, out, folder).collect()
    assert {r.doc_id for r in packed} == after.keys()
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_odd_rows_and_empty_tables(spark, folder):
    text = "the same words stand in both of these rows of the table here"
    rows = [(1, text, "en", "s", 1, "x"), (1, text, "en", "s", 1, "x"), (None, text, None, None, None, "x"),
            (None, "other words that nobody else has written down yet today", "en", "s", 2, "x")]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, rejected string"
    frame = spark.createDataFrame(rows * 2 + [(5, "lone", "en", "s", 4, "x")], kinds)
    for frame in (frame, frame.limit(0)):
        many = []
        for name, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, frame, folder))
            if name != "best-fit packing":
                assert out.columns == frame.columns
            frame = out
            many.append(out.count())
        assert many in ([9, 9, 3, 3, 3], [0] * 5)
