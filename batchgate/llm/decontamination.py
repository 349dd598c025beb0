"""Benchmark decontamination with a generalised suffix automaton.

The items' words go into one automaton.  Each document streams through it and the automaton
keeps, word by word, the longest match that ends there.  A match of ``window`` words or more is
a hit, and so is a whole item that is shorter than the window.  Hit spans, and documents that
are covered by hits beyond ``max_coverage``, can be removed.

Streaming stops wherever no item has two neighbouring words next to each other: the match cannot
go on across such a place, so the automaton starts anew behind it, and stretches shorter than
any window are skipped without it.  Both are found with array operations over whole batches.

The automaton of a block of items (BLOCK_WORDS) is sent to the executors; more items make more
blocks, and the documents' hits are united by document and text.

Cases: null and empty texts have no words, are not hit and stay; items without words are ignored;
repeated rows each get the result of their text; rows with a null id keep it; items of one id are
windows of one item; items with a null id hit but are not counted; an empty benchmark hits
nothing; other columns are carried along by ``decontaminate``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import fresh, quoted, staged, tidy
from batchgate.llm.packing import text_chunks

# Bounds what is broadcast and what a Python worker builds from it; one item is never divided.
BLOCK_WORDS = 100_000

# Bytes of words: digits, lower-case letters, and every byte of a character beyond ASCII.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case; runs of ASCII letters and digits and of any other characters."""
    return (text or "").encode().translate(_TABLE).split()


class Automaton:
    """Suffix automaton of several word sequences; a state's items are where it occurs."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocabulary: dict[bytes, int] = {}
        pairs: set[tuple[int, int]] = set()
        paths, shortest = [], window
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if not ids:
                continue
            pairs.update(zip(ids, ids[1:]))
            shortest = min(shortest, len(ids))
            last = 0
            for word in ids:
                last = self._extend(last, word)
            paths.append((item, ids))
        self.shortest = shortest
        size = max(1, len(self.vocabulary))
        self.pairs = np.array(sorted(a * size + b for a, b in pairs), np.int64)
        self.items: dict[int, set] = {}
        self.whole: dict[int, set] = {}
        for item, ids in paths:
            self._mark(item, ids)
        # The nearest state on the way of suffix links that is a whole short item.
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.short_at = [-1] * len(self.link)
        for state in order:
            if state in self.whole:
                self.short_at[state] = state
            elif self.link[state] >= 0:
                self.short_at[state] = self.short_at[self.link[state]]

    def _add(self, length: int, link: int, step: dict[int, int]) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        clone = self._add(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, word)
        new = self._add(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = (target if self.length[target] == self.length[state] + 1
                              else self._split(state, target, word))
        return new

    def _mark(self, item: str | None, ids: list[int]) -> None:
        """Note the item at the states of its windows."""
        state = 0
        for n, word in enumerate(ids, 1):
            state = self.next[state][word]
            if n >= self.window:
                # The state of the last ``window`` words alone.
                self.items.setdefault(self._of_window(state), set()).add(item)
        if len(ids) < self.window:
            self.whole.setdefault(state, set()).add(item)

    def _of_window(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def match(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (first, behind) of a stretch of words, and the items that hit."""
        spans, found = [], set()
        state, matched = 0, 0
        step, link, length = self.next, self.link, self.length
        for at, word in enumerate(ids.tolist()):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            target = step[state].get(word)
            if target is None:
                state, matched = 0, 0
                continue
            state, matched = target, matched + 1
            if matched >= self.window:
                spans.append((at + 1 - matched, at + 1))
                found |= self.items[self._of_window(state)]
            short = self.short_at[state]
            if short == state and matched < length[state]:
                short = self.short_at[link[state]]
            while short >= 0:
                spans.append((at + 1 - length[short], at + 1))
                found |= self.whole[short]
                short = self.short_at[link[short]]
        return spans, found

    def hits(self, documents: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """For each document its hit spans, united, and items."""
        get = self.vocabulary.get
        sizes = np.array([len(w) for w in documents], np.int64)
        starts = np.cumsum(sizes + 1) - sizes  # a word of none stands before each document
        ids = np.full(int((sizes + 1).sum()) + 1, -1, np.int64)
        for at, n, words in zip(starts.tolist(), sizes.tolist(), documents):
            ids[at:at + n] = np.fromiter(map(get, words, repeat(-1)), np.int64, n)
        keys = ids[:-1] * max(1, len(self.vocabulary)) + ids[1:]
        joined = (ids[:-1] >= 0) & (ids[1:] >= 0)
        if len(self.pairs):
            near = np.minimum(np.searchsorted(self.pairs, keys[joined]), len(self.pairs) - 1)
            joined[joined] = self.pairs[near] == keys[joined]
        else:
            joined[:] = False
        known = ids >= 0
        first = known & ~np.append(False, joined)
        last = known & ~np.append(joined, False)
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        long = end - begin >= self.shortest
        found: list[tuple[list, set]] = [([], set()) for _ in documents]
        begin, end = begin[long], end[long]
        for a, b, doc in zip(begin.tolist(), end.tolist(),
                             (np.searchsorted(starts, begin, "right") - 1).tolist()):
            spans, items = self.match(ids[a:b])
            if spans:
                shift = a - int(starts[doc])
                found[doc][0].extend((x + shift, y + shift) for x, y in spans)
                found[doc][1].update(items)
        return [(united(spans), items) for spans, items in found]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[list]:
    """The items in blocks of about ``block_words`` words, each small enough to be broadcast."""
    items = benchmark.select(quoted("item_id").alias("item"),
                             F.coalesce(quoted("text").cast("string"), F.lit("")).alias("text"))
    # Two bytes a word at least, so the bytes bound the words.
    words = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    many = max(1, -(-int(words) // block_words))
    if many == 1:
        yield [(r.item, r.text) for r in items.collect()]
        return
    dealt = staged(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(many))))
    for k in range(many):
        some = dealt.where(F.col("block") == k).select("item", "text").collect()
        if some:
            yield [(r.item, r.text) for r in some]


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, items: list, window: int) -> Automaton:
    """A worker builds a block's automaton once, and keeps the last one."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(
            [(None if i is None else str(i), words_of(t)) for i, t in items], window)
    return _BUILT[key]


_HITS = "n_words long, spans array<struct<first: int, behind: int>>, items array<string>"


def _with_hits(rows: DataFrame, items: list, window: int) -> DataFrame:
    """Rows of (doc_id, text) with the hits of one block of items."""
    held, key = rows.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    span = pa.list_(pa.struct([("first", pa.int32()), ("behind", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, held.value, window)
        for whole in batches:
            for batch in text_chunks(whole, "text"):
                documents = [words_of(t) for t in batch.column("text").to_pylist()]
                hits = automaton.hits(documents)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id"), "text": batch.column("text")}
                    | {"n_words": pa.array([len(w) for w in documents], pa.int64()),
                       "spans": pa.array([[{"first": a, "behind": b} for a, b in s]
                                          for s, _ in hits], span),
                       "items": pa.array([sorted(x for x in i if x is not None)
                                          for _, i in hits], pa.list_(pa.string()))})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, text string, {_HITS}")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text, n_words, spans of hit words, items whose windows occur (as strings)."""
    rows = docs.select(quoted("doc_id").alias("doc_id"),
                       quoted("text").cast("string").alias("text"))
    found = [_with_hits(rows, items, window) for items in blocks(benchmark, block_words)]
    if not found:
        found = [_with_hits(rows, [], window)]
    if len(found) == 1:
        return found[0]
    # Equal documents have equal hits, so the text itself joins the blocks' results.
    key = F.sha2(F.col("text"), 256)
    hit = [f.where(F.size("spans") > 0).select(key.alias("k"), "spans", "items") for f in found]
    every = hit[0]
    for more in hit[1:]:
        every = every.unionByName(more)
    per_text = every.groupBy("k").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("all_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("all_items"))
    joined = found[0].select("doc_id", "text", "n_words").withColumn("k", key).join(
        per_text, "k", "left")
    # Spans in order; one that starts inside the last one prolongs it.
    merged = F.aggregate(
        "all_spans", F.array().cast("array<struct<first: int, behind: int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s.first <= F.element_at(acc, -1).behind),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1).first.alias("first"),
                F.greatest(F.element_at(acc, -1).behind, s.behind).alias("behind")))),
        ).otherwise(F.concat(acc, F.array(s))))
    empty = F.array().cast
    return joined.select(
        "doc_id", "text", "n_words",
        F.coalesce(merged, empty("array<struct<first: int, behind: int>>")).alias("spans"),
        F.coalesce("all_items", empty("array<string>")).alias("items"))


def _clean(text: str, automaton: Automaton, max_coverage: float) -> str | None:
    """The text without its hit spans; None if they cover too much of it.

    What a removal brings together is looked at again, until nothing hits.
    """
    first = True
    while True:
        raw = text.encode()
        spans = automaton.hits([words_of(text)])[0][0]
        if not spans:
            return text
        places = [m.span() for m in _WORD.finditer(raw)]
        if first and sum(b - a for a, b in spans) > max_coverage * len(places):
            return None
        first, kept, at = False, [], 0
        for a, b in spans:
            kept.append(raw[at:places[a][0]])
            at = places[b - 1][1]
        text = b"".join([*kept, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  max_coverage: float = 1.0, block_words: int = BLOCK_WORDS,
                  text_col: str = "text") -> DataFrame:
    """The documents without hit spans, all columns kept; documents that hits cover by more than
    ``max_coverage`` of their words go.  Texts without hits are returned as they are."""
    out = docs
    for items in blocks(benchmark, block_words):
        out = _cleaned(out, items, window, max_coverage, text_col)
    return out


def _cleaned(docs: DataFrame, items: list, window: int, max_coverage: float,
             text_col: str) -> DataFrame:
    held, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    gone = fresh(docs, "gone")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, held.value, window)
        for whole in batches:
            for batch in text_chunks(whole, text_col):
                texts = batch.column(at).to_pylist()
                hits = automaton.hits([words_of(t) for t in texts])
                lost = [False] * len(texts)
                for k, (spans, _) in enumerate(hits):
                    if spans:
                        texts[k] = _clean(texts[k], automaton, max_coverage)
                        lost[k] = texts[k] is None
                columns = list(batch.columns)
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lost)], [*batch.schema.names, gone])

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                       for f in docs.schema) + f", `{gone}` boolean"
    return docs.mapInArrow(tidy(run), schema).where(~F.col(gone)).drop(gone)


def op7_benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items found, and their digest."""
    digest = lambda items: F.sha2(F.array_join(items, ","), 256)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.behind - s.first)
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        digest("items").alias("items_sha256"), (n_hit > 0).alias("contaminated"))
