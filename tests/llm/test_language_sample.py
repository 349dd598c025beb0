from batchgate.llm import language as g


def test_copies_do_not_thin_the_sample(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(g.TextModel, "fit", classmethod(lambda cls, s: seen.update(s) or cls()))
    texts = [(f"text number {k} of many", "aa") for k in range(300)]
    copies = [("one text over and over", "aa")] * 20_000
    others = [(f"another {k} here", "bb") for k in range(50)]
    frame = spark.createDataFrame(texts + copies + others, "text string, lang string")
    g.fit_text_model(frame.repartition(4), "text", "lang")
    assert sorted(seen["aa"]) == sorted({t for t, _ in texts + copies})
    assert sorted(seen["bb"]) == sorted(t for t, _ in others)
