import html
import re

import pytest

from batchgate.llm import html_text as h


@pytest.fixture(scope="module")
def weights(tables):
    return h.fit([(p, None) for p in tables("pages").html])


def article_of(page):
    """What the pages of the test tables hold between their article tags."""
    inner = page.split("<article>")[1].split("</article>")[0]
    inner = re.sub(r"</?(p|h1)>", "\n", inner).replace("<br>", " ").replace("<b>", "")
    lines = (" ".join(html.unescape(x).split()) for x in inner.split("\n"))
    return "\n".join(x for x in lines if x)


def test_all_pages(spark, tables):
    pages = tables("pages")
    frame = spark.createDataFrame(pages.assign(text="x"))
    rows = {r.page_id: r for r in h.op2_html_extraction(frame.select("page_id", "url", "html"))
            .collect()}
    for key, page in zip(pages.page_id, pages.html):
        assert rows[key].text == article_of(page)
        assert rows[key].n_chars == len(rows[key].text)
    clash = h.extract(frame, h.DEFAULT_WEIGHTS)
    assert clash.columns == [*frame.columns, "_text"]


BODY = "many words of the main text that all belong together here "


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p><br>", ""), ("just words", "just words"),
    ("a < b and c > d", "a < b and c > d"),
    (f"<p>{BODY}&amp;lt; &eacute;&#x41;&nbsp;x<p>{BODY}", f"{BODY}&lt; éA x\n{BODY.strip()}"),
    (f"<nav>menu</nav><div class='sidebar-left'>side {BODY}</div><main><p>{BODY}</p></main>",
     BODY.strip()),
    (f"<article><h1>Head</h1><p>{BODY}</p><aside>no {BODY}</aside><form>Name<input></form>"
     f"<div id=ad-7>buy</div><ul><li>one<li>two</ul><p>end</p></article>"
     f"<section class=comments><p>{BODY} {BODY}</p></section>",
     f"Head\n{BODY.strip()}\none\ntwo\nend"),
    (f"<article><p>{BODY}</p><article class='comment'><p>remark {BODY}</p></article></article>",
     BODY.strip()),
    (f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{BODY}"
     "<script>if (a<b) f('</p>')</script> more</article>", f"Title\n{BODY.strip()} more"),
    (f"<article><p>{BODY}<br>x<br/>y</p><!-- <p>not</p> --><![CDATA[ no ]]></article>",
     f"{BODY}x y"),
    (f"<article><p hidden>no</p><p title='a > b'>{BODY}</p><div style='display: none'>no</div>",
     BODY.strip()),
    (f"<article><p>{BODY}</p></article><footer>foot</footer><p>powered by x</p>", BODY.strip()),
])
def test_odd_pages(weights, page, text):
    assert h.main_text(page, weights) == text


def test_very_long_and_broken_pages(weights):
    assert h.main_text("<article>" + "<p>word " * 100_000, weights).count("\n") == 99_999
    assert h.main_text("<" * 100_000, weights) == "<" * 100_000
    assert h.main_text("<div class=\"" * 20_000, weights) == ""
    assert h.main_text("<!-- open " + BODY, weights) == ""
    assert h.main_text("<script>" + BODY, weights) == ""


def test_given_labels():
    page = f"<div><p>{BODY}</p></div><div><i>other</i></div>"
    parts = list(h.tokens(page))
    content = {k for k, p in enumerate(parts) if p[1].strip() == BODY.strip()}
    assert h.main_text(page, h.fit([(page, content)])) == BODY.strip()


def test_rows_without_labels_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<p>a b c</p>")],
                                 "page_id long, url string, html string")
    got = sorted((r.text, r.n_chars) for r in h.op2_html_extraction(rows).collect())
    assert got == [("", 0), ("", 0), ("a b c", 5)]
    assert h.op2_html_extraction(rows.limit(0)).count() == 0
