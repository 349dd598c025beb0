"""A language that has long texts only becomes a class like any other."""

from batchgate.llm import language

EN = "the house of the king and the water that is there with them "
XX = "qozu vixa jyke wuzzo qyxi jaza vukky zaxo wiqqu jexy "


def test_a_language_of_long_texts_only(spark):
    rows = [(k, f"{EN}{k} " * 2, "en", "a.example.com") for k in range(80)]
    rows += [(1000 + k, f"{XX}{k} " * 560, "xx", "b.example.org") for k in range(40)]
    assert min(len(r[1]) for r in rows if r[2] == "xx") > language.TRAIN_CHARS
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = language.identify(docs).select("lang", "language", "text_language", "rejected").collect()
    assert len(got) == len(rows)
    assert all(r.lang == r.language == r.text_language and not r.rejected for r in got)
