"""Line dedup with a log-template tree.

Lines are parsed into a tree of fixed depth: token count, then the leading LEADING tokens, with
tokens that hold digits as variables.  Within a leaf, a token that stands at its position in
lines of enough documents is constant and every other one is variable; a line's template is its
constants in their places.  Enough is ``min_docs``, and twice, four times, ... as many: a line has
a template for each of these levels, so that names that are frequent in a large table are variable
beside words that are in every line.  Templates that recur across documents are dropped.

A template *recurs* if it occurs in ``min_docs`` or more different texts and either of these holds:

* It stands in changing company: the lines before it, and those after it, fall into at least
  ``min_docs`` different leaves, and at least ``diversity`` as many as there are texts.
* ``min_docs`` of its texts are unrelated: the Jaccard similarity of the pieces of PIECE bytes of
  any two is below RELATED, as estimated from the SKETCH smallest hashes of either.  Passages of
  several lines recur by this, and copies of some of the texts do not change it.

Lines that only near copies share stay; such documents are the business of near-duplicate removal.
The start and end of a text count as a neighbour of its own; a text of one line has no company,
so it is neither counted nor dropped.

All of it is counting, so a line that is in a third of all documents is one partial sum per task:

1. Every line gives four hashes: leaf, masked line, leaf before, leaf behind; and its text's hash.
2. Masked lines that occur often enough need no tree.  Lines and leaves that cannot are told by
   one count each; bit arrays of fixed size keep the others' rows, and all that follows is about
   these few rows.
3. A second look at the texts these rows are in gives their sketches, and the tokens of lines in
   leaves that several lines share.  Tokens are counted by position; lines whose constants make up
   ``agreement`` of them get a template, and templates are counted alike.
4. Unrelated texts of a line are found one by one: the text with the smallest hash, of the texts
   unrelated to it the one with the smallest hash, and so on up to ``min_docs``.
5. The lines found are joined to the texts they are in and cut out there; the join is a shuffle
   at every size.

Scripts that are written without spaces have tokens of two characters.

Cases: lines of fewer than ``min_tokens`` tokens are never dropped, but are neighbours; null and
empty texts stay as they are; equal texts count once and lose the same lines; a text that has
nothing but white space left after losing lines is empty; an empty table gives an empty result;
other columns are carried along by ``without_templates``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import fresh, quoted, staged, tidy
from batchgate.llm.membership import BITS, bit_array, may_hold, own_spot
from batchgate.llm.packing import text_chunks

LEADING = 3
MIN_TOKENS, MIN_DOCS = 3, 3
DIVERSITY, AGREEMENT = 0.3, 0.6
# Texts that share more than half of their words are related.
RELATED = 0.4
SKETCH, PIECE = 64, 32
VARIABLE = "<*>"
_DIGIT = re.compile(r"\d")


# Thai to Khmer, kana and Han: scripts without spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff"
                       "\uf900-\ufaff\U00020000-\U0003ffff]+")


def _spaced(line: str) -> str:
    """A line with spaces around every two characters of a script without them."""
    try:
        line.encode("latin-1")
        return line
    except UnicodeEncodeError:
        return _UNSPACED.sub(lambda m: " " + " ".join(
            m[0][k:k + 2] for k in range(0, len(m[0]), 2)) + " ", line)


def masked(line: str) -> list[str]:
    """The tokens of a line; those with digits are variables."""
    tokens = (line if line.isascii() else _spaced(line)).split()
    if _DIGIT.search(line):
        return [VARIABLE if _DIGIT.search(t) else t for t in tokens]
    return tokens


def number(*parts: str) -> int:
    """A signed 64-bit hash."""
    raw = hashlib.blake2b("\x1f".join(parts).encode(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def leaf_of(tokens: list[str]) -> int:
    return number(str(len(tokens)), *tokens[:LEADING])


def parsed(text: str) -> list[tuple[int, int, int, int, int, list[str]]]:
    """(place, leaf, masked line, leaf before, leaf behind, tokens) of a text's lines with words,
    if there are several."""
    lines = [(k, masked(line)) for k, line in enumerate(text.split("\n"))]
    lines = [(k, t) for k, t in lines if t]
    if len(lines) < 2:
        return []
    own = number(text)
    leaves = [own, *(leaf_of(t) for _, t in lines), own]
    return [(k, leaves[i + 1], number(*t), leaves[i], leaves[i + 2], t)
            for i, (k, t) in enumerate(lines)]


# Digits are variables.
_RANDOM = np.random.default_rng(20240611).integers(0, 1 << 32, 256, dtype=np.uint32)
_RANDOM[48:58] = _RANDOM[48]
_BASE, _BLOCK = 0x9E3779B5, 1 << 20


def _powers(base: int) -> np.ndarray:
    steps = np.full(2 * _BLOCK, base, np.uint32)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint32)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 32))


def _piece_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of each PIECE neighbouring bytes: sums of random numbers times powers, mixed."""
    sums = np.cumsum(_RANDOM[raw] * _UP[:len(raw)], dtype=np.uint32)
    h = sums[PIECE - 1:].copy()
    h[1:] -= sums[:len(h) - 1]
    h *= _DOWN[:len(h)]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return (h >> np.uint32(1)).astype(np.int32)


def _smallest(h: np.ndarray) -> np.ndarray:
    low = np.unique(h[h < (1 << 31) * min(1.0, 4 * SKETCH / len(h))])
    low = low if len(low) >= SKETCH else np.unique(h)
    return low[:SKETCH]


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The SKETCH smallest hashes of each text's pieces of PIECE bytes, in order; texts are
    hashed together, long ones in parts."""
    out: list[np.ndarray] = [None] * len(texts)
    held, size = [], 0

    def flush():
        raw = np.frombuffer(b"".join(part for _, part in held), np.uint8)
        h, at = _piece_hashes(raw), 0
        for k, part in held:
            out[k] = _smallest(h[at:at + len(part) - PIECE + 1])
            at += len(part)

    for k, text in enumerate(texts):
        part = text.encode().ljust(PIECE)
        if len(part) > _BLOCK:
            raw = np.frombuffer(part, np.uint8)
            out[k] = np.zeros(0, np.int32)
            for at in range(0, len(raw) - PIECE + 1, _BLOCK):
                low = _smallest(_piece_hashes(raw[at:at + _BLOCK + PIECE - 1]))
                out[k] = np.unique(np.append(out[k], low))[:SKETCH]
            continue
        if size + len(part) > _BLOCK:
            flush()
            held, size = [], 0
        held.append((k, part))
        size += len(part)
    if held:
        flush()
    return out


def related(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches' texts."""
    both = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both)


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(quoted(text_col).cast("string").alias("text")).where("text is not null")


def line_hashes(docs: DataFrame, text_col: str, min_tokens: int) -> DataFrame:
    """leaf, line, doc, before, behind of all lines that may be dropped; doc is the text's hash.

    A text that several tasks meet gives its rows several times.
    """
    names = ["leaf", "line", "doc", "before", "behind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in text_chunks(whole, "text", 1 << 20):
                rows = []
                for text, doc in zip(batch.column("text").to_pylist(),
                                     batch.column("doc").to_pylist()):
                    if doc not in seen:
                        seen.add(doc)
                        rows += [(leaf, line, doc, before, behind) for
                                 _, leaf, line, before, behind, t in parsed(text)
                                 if len(t) >= min_tokens]
                columns = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names)

    return _texts(docs, text_col).withColumn("doc", F.xxhash64("text")).mapInArrow(
        tidy(run), ", ".join(f"{n} long" for n in names))


def held_rows(lines: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Distinct lines whose key is wanted, and a few others that the bit array lets pass."""
    bits = lines.sparkSession.sparkContext.broadcast(bit_array(wanted, key, own_spot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = may_hold(bits.value, batch.column(key).to_numpy() % BITS + 1)
            yield batch.filter(pa.array(hit, pa.bool_()))

    return lines.mapInArrow(tidy(run), lines.schema).distinct()


def second_look(docs: DataFrame, text_col: str, in_question: DataFrame, leaves: DataFrame,
                min_tokens: int) -> DataFrame:
    """Of texts in question (and of some others): a row of doc and sketch, and rows of leaf, line
    and tokens for the lines in the leaves."""
    held = docs.sparkSession.sparkContext.broadcast(
        (bit_array(in_question, "doc", own_spot), bit_array(leaves, "leaf", own_spot), min_tokens))
    schema = pa.schema([("doc", pa.int64()), ("sketch", pa.list_(pa.int32())),
                        ("leaf", pa.int64()), ("line", pa.int64()),
                        ("tokens", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, open_leaves, least = held.value
        seen: set[int] = set()
        known: set[int] = set()
        for whole in batches:
            hit = may_hold(texts, whole.column("doc").to_numpy() % BITS + 1)
            for batch in text_chunks(whole.filter(pa.array(hit, pa.bool_())), "text", 1 << 20):
                fresh_texts = {}
                for text, doc in zip(batch.column("text").to_pylist(),
                                     batch.column("doc").to_pylist()):
                    if doc not in seen:
                        seen.add(doc)
                        fresh_texts[doc] = text
                found = sketches(list(fresh_texts.values()))
                rows = [(doc, s, None, None, None) for doc, s in zip(fresh_texts, found)]
                for text in fresh_texts.values():
                    lines = [t for t in map(masked, text.split("\n")) if t]
                    lines = [t for t in lines if len(t) >= least] if len(lines) > 1 else []
                    own = np.array([leaf_of(t) for t in lines], np.int64)
                    for k in np.flatnonzero(may_hold(open_leaves, own % BITS + 1)).tolist():
                        line = number(*lines[k])
                        if line not in known:
                            known.add(line)
                            rows.append((None, None, int(own[k]), line, lines[k]))
                columns = zip(*rows) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return _texts(docs, text_col).withColumn("doc", F.xxhash64("text")).mapInArrow(
        tidy(run), "doc long, sketch array<int>, leaf long, line long, tokens array<string>")


def recurring(lines: DataFrame, sketches: DataFrame, key: str, min_docs: int,
              diversity: float) -> DataFrame:
    """Keys that occur in enough texts, and in changing company or in unrelated texts.

    Three counts of distinct pairs, each combined before its shuffle.  Only the other keys of
    enough texts meet sketches.
    """
    counts = None
    for column in ("doc", "before", "behind"):
        one = lines.select(key, column).distinct().groupBy(key).agg(
            F.count("*").alias(f"n_{column}"))
        if column == "doc":
            counts = one.where(F.col("n_doc") >= min_docs)
        else:
            counts = counts.join(one, key)
    counts = staged(counts)
    enough = F.greatest(F.lit(min_docs), diversity * F.col("n_doc"))
    changing = (F.col("n_before") >= enough) & (F.col("n_behind") >= enough)
    left = staged(lines.join(counts.where(~changing).select(key), key).select(
        key, "doc").distinct().join(sketches.hint("merge"), "doc"))
    for _ in range(min_docs - 1):
        # Staged, so that the join with a hot key's rows need not be dealt like the aggregation.
        one = staged(left.groupBy(key).agg(F.min_by("sketch", "doc").alias("other")))
        left = staged(left.join(one, key).where(
            related(F.col("sketch"), F.col("other")) < RELATED).drop("other"))
    return counts.where(changing).select(key).unionByName(left.select(key).distinct())


def templates(open_lines: DataFrame, per_line: DataFrame, min_docs: int,
              agreement: float) -> DataFrame:
    """line and template, for lines of leaves in question that have variable tokens at some level.

    ``per_line`` has the leaf, the line and its number of texts for exactly these lines.
    """
    token = F.posexplode("tokens").alias("at", "token")
    kept = staged(open_lines.join(per_line, ["leaf", "line"]).dropDuplicates(["leaf", "line"]))
    tokens = kept.select("leaf", "line", "docs", F.size("tokens").alias("n"), token)
    constant = tokens.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("d")).where(
        F.col("d") >= min_docs).select(
        "leaf", "at", "token", F.floor(F.log2(F.col("d") / min_docs)).cast("int").alias("level"))
    own = tokens.join(constant, ["leaf", "at", "token"]).groupBy("leaf", "line", "n").agg(
        F.sort_array(F.collect_list(F.struct("at", "token", "level"))).alias("c"))  # one line's
    each = own.select("leaf", "line", "n", "c", F.explode(
        F.array_distinct(F.transform("c", lambda x: x.level))).alias("from")).select(
        "leaf", "line", "n", F.transform(
            F.filter("c", lambda x: x.level >= F.col("from")),
            lambda x: F.struct(x.at.alias("at"), x.token.alias("token"))).alias("c"))
    size = F.size("c")
    return each.where((size < F.col("n")) & (size >= agreement * F.col("n"))).select(
        "line", F.xxhash64("leaf", "n", F.to_json("c")).alias("template"))


def template_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                   min_tokens: int = MIN_TOKENS, diversity: float = DIVERSITY,
                   agreement: float = AGREEMENT) -> DataFrame:
    """doc (hash of a text) and line (hash of a masked line) of all lines to drop."""
    lines = staged(line_hashes(docs, text_col, min_tokens))
    # Rows count a text several times, so these are more lines and leaves than needed.
    often = staged(held_rows(lines, "line", staged(lines.groupBy("line").agg(
        F.count("*").alias("n")).where(F.col("n") >= min_docs).select("line"))))
    busy = staged(lines.groupBy("leaf").agg(
        F.count("*").alias("n"), F.min("line").alias("a"), F.max("line").alias("b")).where(
        (F.col("n") >= min_docs) & (F.col("a") != F.col("b"))).select("leaf"))
    in_leaves = staged(held_rows(lines, "leaf", busy))
    looked = staged(second_look(docs, text_col, often.select("doc").unionByName(
        in_leaves.select("doc")).distinct(), busy, min_tokens))
    sketches = looked.where("doc is not null").select("doc", "sketch").dropDuplicates(["doc"])
    open_lines = looked.where("line is not null").select("leaf", "line", "tokens")

    exact = staged(recurring(often, sketches, "line", min_docs, diversity))
    others = in_leaves.join(exact, "line", "left_anti")
    # Leaves that several different lines and enough texts share.
    leaves = staged(others.select("leaf", "line", "doc").distinct().groupBy("leaf").agg(
        F.count("*").alias("n"), F.min("line").alias("a"), F.max("line").alias("b")).where(
        (F.col("n") >= min_docs) & (F.col("a") != F.col("b"))).select("leaf"))
    per_line = others.join(leaves, "leaf", "left_semi").select("leaf", "line", "doc").distinct(
    ).groupBy("leaf", "line").agg(F.count("*").alias("docs"))
    named = staged(templates(open_lines, per_line, min_docs, agreement))
    alike = others.join(named, "line")
    found = recurring(alike, sketches, "template", min_docs, diversity)
    generalised = named.join(found, "template", "left_semi").select("line")
    return often.unionByName(in_leaves).join(
        staged(exact.unionByName(generalised).distinct()), "line", "left_semi").select(
        "doc", "line").distinct()


def without_templates(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """All columns with the text cut, and how many lines it had and lost.

    The new columns are n_lines and n_dropped; clashing names get underscores.
    """
    limits = {"min_docs": MIN_DOCS, "min_tokens": MIN_TOKENS, "diversity": DIVERSITY,
              "agreement": AGREEMENT} | limits
    gone = staged(template_lines(docs, text_col, **limits))
    per_text = staged(gone.groupBy("doc").agg(F.collect_list("line").alias("gone")))  # one text's
    key, lost = fresh(docs, "text_key"), fresh(docs, "lost_lines")
    names = [fresh(docs, "n_lines"), fresh(docs, "n_dropped")]
    joined = docs.withColumn(key, F.xxhash64(quoted(text_col).cast("string"))).join(
        per_text.select(F.col("doc").alias(key), F.col("gone").alias(lost)).hint("merge"),
        key, "left").select(
        *[quoted(c) for c in docs.columns], lost)
    at, width = docs.columns.index(text_col), len(docs.columns)
    min_tokens = limits["min_tokens"]

    def cut(text: str, drop: set[int]) -> tuple[str, int]:
        lines = text.split("\n")
        tokens = [masked(line) for line in lines]
        kept = [line for line, t in zip(lines, tokens)
                if len(t) < min_tokens or number(*t) not in drop]
        out = "\n".join(kept)
        return (out if out.strip() else ""), len(lines) - len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_chunks(whole, text_col):
                texts = batch.column(at).to_pylist()
                many = [0 if t is None else t.count("\n") + 1 for t in texts]
                dropped = [0] * len(texts)
                for k, drop in enumerate(batch.column(width).to_pylist()):
                    if drop and texts[k] is not None:
                        texts[k], dropped[k] = cut(texts[k], set(drop))
                columns = list(batch.columns[:width])
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(many, pa.int64()), pa.array(dropped, pa.int64())],
                    [*batch.schema.names[:width], *names])

    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                       for f in docs.schema)
    return joined.mapInArrow(tidy(run), schema + "".join(f", `{n}` long" for n in names))


def op5_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, the text without recurring lines, its lines and how many it lost."""
    return without_templates(docs.select("doc_id", "text"))
