from batchgate.llm import language


def test_held_out_accuracy(spark, tables):
    docs = tables("documents")
    train, held = docs[docs.doc_id % 2 == 0], docs[docs.doc_id % 2 == 1]
    model = language.TextModel.fit(
        {k: g.text.tolist() for k, g in train.groupby("lang")})
    best = model.evidence(held.text.tolist()).argmax(1)
    right = sum(model.classes[k] == l for k, l in zip(best, held.lang))
    assert right >= 0.98 * len(held)


def test_clean_documents_stay(spark, tables):
    docs = tables("documents")
    rows = language.op8_language_id(spark.createDataFrame(docs)).collect()
    assert len(rows) == len(docs)
    assert sum(r.rejected for r in rows) == 0
    assert sum(r.language == r.declared for r in rows) >= 0.98 * len(docs)


def frame_of(spark, rows):
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, language string")


EN = "the house of the king and the water that is there with them"
DE = "das haus des königs und das wasser ist nicht für die anderen"


def test_odd_rows(spark):
    rows = [(k, EN, "en", "a.example.com", "x") for k in range(30)]
    rows += [(100 + k, DE, "DE-at", "b.example.de", "x") for k in range(30)]
    rows += [(200, None, "en", None, None), (201, "", None, "", None), (202, "123 !!", "en", "a", "x"),
             (203, EN, None, None, "x"), (203, EN, None, None, "x"), (None, DE, "", "h", "x"),
             (204, EN, "xx", "1.2.3.4", "x"), (205, DE * 3000, "de", "b.example.de", "x")]
    out = language.identify(frame_of(spark, rows).repartition(3))
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "language"]
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for key in (200, 201, 202):
        assert by[key]["_language"] == "und" and by[key].rejected
    for key, want in ((0, "en"), (100, "de"), (203, "en"), (None, "de"), (204, "en"), (205, "de")):
        assert by[key]["_language"] == want and not by[key].rejected, key
    assert by[0].language == "x"


def test_host_decides_what_the_text_leaves_open(spark):
    rows = [(k, EN, "en", "en.example.com", "") for k in range(60)]
    rows += [(100 + k, DE, "de", "news.example.de", "") for k in range(60)]
    rows += [(500, "in so war", None, "news.example.de", ""),
             (501, "in so war", None, "en.example.com", "")]
    by = {r.doc_id: r for r in language.identify(frame_of(spark, rows)).collect()}
    open_text = language.TextModel.fit({"en": [EN], "de": [DE]}).evidence(["in so war"])[0]
    assert abs(open_text[0] - open_text[1]) < 8
    assert by[500].confidence != by[501].confidence or by[500]["_language"] != by[501]["_language"]


def test_no_labels_and_empty_table(spark):
    rows = frame_of(spark, [(1, EN, None, "h", "")])
    assert language.identify(rows).first()["_language"] == "und"
    assert language.identify(frame_of(spark, [])).count() == 0
