"""HTML extraction by a maximum-scoring subsequence.

A page becomes a sequence of words and tags.  Words score positive and tags negative, by weights
learned from labelled pages; one linear scan finds the contiguous region with the largest sum,
and its text, block by block, is the page's main text.  Words inside boilerplate elements
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments)
score nothing and are never part of the text, also where the region holds such an element.

Tags of boilerplate elements have one weight, and none inside an article, which goes on behind
them.  The other weights are log odds of a tag (or a word) standing inside the content against outside, in pages
whose content is known; words are kept within WORD_WEIGHT, tags within TAG_WEIGHT.  Labels may be
given; ``labelled_by_markup`` takes them from pages that mark their article, at most SAMPLE_PAGES
of at most SAMPLE_CHARS characters, those with the smallest hashes.

Blocks are what block elements separate; ``<br>`` is white space.  Character references are
decoded, white space within a block becomes one space, and blocks are joined by newlines.

Cases: null and empty pages, and pages without words, give an empty text; malformed markup is
read as far as it makes sense: unclosed elements end with their parent, a ``<`` that starts no
tag is text; repeated rows get the same result each; an empty table gives an empty result; other
columns are carried along by ``extract``.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import bounded_sample, fresh, quoted, tidy
from batchgate.llm.packing import text_chunks

SAMPLE_PAGES, SAMPLE_CHARS = 512, 65_536
WORD_WEIGHT = (0.25, 1.0)
TAG_WEIGHT = (-8.0, -0.05)
UNSEEN_TAG = -1.0
# Of a boilerplate element that is not inside an article.
BOILERPLATE_TAG = -4.0
# Weights without any labelled page.
_CONTENT_TAGS = ("a abbr b blockquote br cite code dd dl dt em figcaption figure h1 h2 h3 h4 h5 h6 "
                 "header i img li ol p pre q small span strong sub sup table tbody td th thead tr u ul")
DEFAULT_WEIGHTS = {"": 1.0} | {
    end + tag: -0.1 for tag in _CONTENT_TAGS.split() for end in ("", "/")}

# Fixed lists of element names and of words in class and id names.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
BOILERPLATE = frozenset(
    "aside audio button canvas dialog footer form head iframe menu nav noembed noframes noscript "
    "object script select style svg template textarea title video xmp".split())
ROLES = frozenset("alert banner complementary contentinfo dialog navigation search".split())
NAMES = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav "
    "navbar navigation newsletter notice pager pagination popup promo promotion related replies "
    "reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar "
    "widget".split())
CONTENT_NAMES = frozenset("article body content entry main page post story text".split())
REMARKS = frozenset("comment comments replies reply".split())
_INLINE_STOP = BLOCKS - {"p"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_CLOSING = {name: re.compile("</" + name, re.I | re.A) for name in RAW}
_WORDS_IN_NAME = re.compile(r"[A-Za-z]+")


def _is_boilerplate(name: str, attributes: str, in_article: bool) -> bool:
    if name in BOILERPLATE:
        return True
    if name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role" and value in ROLES or key == "hidden" or (
                key == "aria-hidden" and value == "true") or (
                key == "style" and re.search(r"display\s*:\s*none", value)):
            return True
        if key in ("class", "id"):
            for one in value.split():
                words = set(_WORDS_IN_NAME.findall(one))
                found = words & (REMARKS if name == "article" else NAMES)
                if found and (found & REMARKS or not words & CONTENT_NAMES):
                    return True
    return False


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """(tag key or "" for text, text, boilerplate, inside an article) in page order."""
    stack: list[tuple[str, bool, bool]] = []  # element, boilerplate from here on, in an article
    at = 0

    def state():
        return stack[-1][1:] if stack else (False, False)

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            yield "", page[at:m.start()], *state()
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    shut = stack[k][1]
                    del stack[k:]
                    yield "/" + name, "", shut, state()[1]
                    break
                if name not in BLOCKS and stack[k][0] in _INLINE_STOP or (
                        name == "p" and stack[k][0] in _INLINE_STOP):
                    break
            continue
        boilerplate, article = state()
        if name == "p" or name == "li":
            # An open one of the same block ends here; formatting inside it goes on.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    stack.pop(k)
                    break
                if stack[k][0] in _INLINE_STOP:
                    break
        boilerplate = boilerplate or _is_boilerplate(name, m[3], article)
        yield name, "", boilerplate, article
        if name in RAW:
            end = _CLOSING[name].search(page, at)
            at = len(page) if end is None else end.start()
            closing = page.find(">", at)
            at = len(page) if closing < 0 else closing + 1
        elif name not in VOID and not m[3].endswith("/"):
            stack.append((name, boilerplate, article or name in ("article", "main")))
    if at < len(page):
        yield "", page[at:], *state()


def fit(pages: list[tuple[str, set[int] | None]]) -> dict[str, float]:
    """Weights from pages with the numbers of their content tokens (None: inside the article)."""
    inside, outside = Counter(), Counter()
    for page, content in pages:
        for k, (key, text, boilerplate, article) in enumerate(tokens(page)):
            if not boilerplate:
                many = len(text.split()) if not key else 1
                within = article if content is None else k in content
                (inside if within else outside)[key] += many
    weights = dict(DEFAULT_WEIGHTS)
    if not inside[""]:
        return weights
    for key in inside.keys() | outside.keys():
        low, high = TAG_WEIGHT if key else WORD_WEIGHT
        odds = math.log((inside[key] + 0.5) / (outside[key] + 0.5))
        weights[key] = min(high, max(low, odds))
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The text of the best region of a page."""
    if not page:
        return ""
    parts = list(tokens(page))
    # The linear scan: the best sum that ends here, and the best one so far.
    total, begin, top, region = 0.0, 0, 0.0, (0, 0)
    for k, (key, text, boilerplate, article) in enumerate(parts):
        if boilerplate:
            score = BOILERPLATE_TAG if key and not article else 0.0
        else:
            score = weights.get(key, UNSEEN_TAG) if key else weights[""] * len(text.split())
        if total <= 0:
            total, begin = 0.0, k
        total += score
        if total > top:
            top, region = total, (begin, k + 1)
    blocks, block = [], []
    for key, text, boilerplate, _ in parts[region[0]:region[1]]:
        if not key:
            if not boilerplate:
                block.append(text)
        elif key.lstrip("/") in BLOCKS:
            blocks.append(block)
            block = []
        elif key == "br":
            block.append(" ")
    blocks.append(block)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def labelled_by_markup(pages: DataFrame, html_col: str = "html") -> list[tuple[str, None]]:
    """A bounded sample of pages whose markup shows their article."""
    page = quoted(html_col)
    chosen = pages.select(page.cast("string").alias("html")).where(
        F.contains(F.lower("html"), F.lit("<article")) & (F.length("html") <= SAMPLE_CHARS))
    return [(r.html, None) for r in bounded_sample(chosen, ["html"], SAMPLE_PAGES).collect()]


def extract(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """All columns of the pages and ``text``; a clashing name gets underscores."""
    name = fresh(pages, "text")
    at = pages.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_chunks(whole, html_col):
                texts = [main_text(p, weights) for p in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                       for f in pages.schema)
    return pages.mapInArrow(tidy(run), f"{schema}, `{name}` string")


def op2_html_extraction(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points."""
    weights = fit(labelled_by_markup(pages))
    return extract(pages.select("page_id", "url", "html"), weights).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
