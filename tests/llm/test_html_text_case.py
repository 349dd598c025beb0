from batchgate.llm import html_text as h


def test_closing_tags_in_capitals_on_a_page_that_grows_in_lower_case():
    page = "<article><p>İlk one two</p><SCRIPT>var x</SCRIPT><STYLE>p {}</Style><p>three four five"
    assert h.main_text(page, h.DEFAULT_WEIGHTS) == "İlk one two\nthree four five"
