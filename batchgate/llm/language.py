"""Language identification by Bayesian fusion of four kinds of evidence.

* **Text**: byte-trigram likelihoods per language and under a background of independent bytes
  (``und``: no language; it must win by UNKNOWN_MARGIN a trigram), tempered so that a text counts as TEXT_WEIGHT trigrams at most.
* **Declared language** (of the markup): how often each language's texts declare what they do.
* **Address suffix**: how often the hosts under a suffix hold each language.
* **Host**: a prior per host, smoothed towards that of its parent domain, which is smoothed
  towards that of the whole table.

Trigrams are learned from a bounded sample, the first TRAIN_CHARS characters of about TRAIN_ROWS
texts for each of the MAX_LANGUAGES languages declared most; whole texts are judged.  Everything else is counted by
grouped aggregation over all rows, by what their text alone says.

A row is rejected if no language is more likely than ``und`` or the best has less than
MIN_CONFIDENCE.

Cases: null and empty texts and texts without letters are ``und`` and rejected; a null or empty
declaration and a host without a suffix are no evidence; a null host is the host ``""``; repeated
rows count and are judged like others; with no labelled rows all texts are ``und``; an empty table
gives an empty result; other columns are carried along, clashing names get underscores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.llm.common import fresh, quoted, staged, tidy
from batchgate.llm.packing import text_chunks

UNKNOWN = "und"
TRAIN_ROWS, TRAIN_CHARS, MAX_LANGUAGES = 400, 20_000, 64
TEXT_WEIGHT = 100
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 20.0
MIN_CONFIDENCE = 0.5
# Log odds per trigram by which independent bytes must explain a text better than any language
# does: odd vocabulary is not yet noise.
UNKNOWN_MARGIN = 2.5
_BITS = 16

# ASCII letters in lower case, other ASCII as a space, bytes of other characters as they are.
_FOLD = np.array([b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
                  for b in range(256)], np.uint8)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of all texts with a space around each, hashed trigrams by place, and where
    each text (with its spaces) ends."""
    parts = [(t or "").encode() for t in texts]
    raw = _FOLD[np.frombuffer(b" " + b"  ".join([*parts, b""]), np.uint8)]
    wide = raw.astype(np.uint32)
    code = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77)
    code = (code + wide[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return raw, code >> np.uint32(32 - _BITS), np.cumsum([len(p) + 2 for p in parts])


@dataclass
class TextModel:
    """Log probabilities of hashed trigrams per class; the last class is the background."""

    classes: list[str] = field(default_factory=lambda: [UNKNOWN])
    tables: np.ndarray | None = None
    singles: np.ndarray = field(default_factory=lambda: np.zeros(256, np.float32))

    @classmethod
    def fit(cls, samples: dict[str, list[str]]) -> TextModel:
        languages = sorted(k for k, v in samples.items() if any(t.strip() for t in v))
        tables, single = [], np.full(256, 0.5)
        for language in languages:
            raw, code, _ = trigrams(samples[language])
            keep = ~((raw[:-2] == 32) & (raw[1:-1] == 32) | (raw[1:-1] == 32) & (raw[2:] == 32))
            count = np.bincount(code[keep], minlength=1 << _BITS) + 0.05
            tables.append(np.log(count / count.sum()))
            single += np.bincount(raw, minlength=256)
        return cls([*languages, UNKNOWN], np.array(tables, np.float32) if tables else None,
                   np.log(single / single.sum()).astype(np.float32))

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Tempered log likelihoods, a row per text."""
        out = np.zeros((len(texts), len(self.classes)))
        if self.tables is None or not texts:
            return out
        raw, code, ends = trigrams(texts)
        # Trigrams with two spaces in a row say nothing, nor do those across texts.
        fine = ~((raw[:-2] == 32) & (raw[1:-1] == 32) | (raw[1:-1] == 32) & (raw[2:] == 32))
        starts = ends - np.diff(ends, prepend=0)
        # The last two places of a text reach into the next one, over two spaces at least once.
        add = lambda x: np.add.reduceat(np.append(x, 0), np.minimum(starts, len(x)))
        n = add(fine.astype(np.float64))
        for k, row in enumerate(self.tables):
            out[:, k] = add(np.where(fine, row[code], 0).astype(np.float64))
        one = self.singles[raw]
        # Bytes that no sample holds are as likely as any trigram, not less.
        noise = np.maximum(one[:-2] + one[1:-1] + one[2:], -np.log(2.0 * (1 << _BITS)))
        out[:, -1] = add(np.where(fine, noise - UNKNOWN_MARGIN, 0).astype(np.float64))
        out *= (TEXT_WEIGHT / (TEXT_WEIGHT + n))[:, None]
        letters = add((raw[:-2] != 32).astype(np.float64))
        out[letters == 0, :-1] = -np.inf
        return out


def primary(declared: Column) -> Column:
    """``en-GB`` and ``EN_gb`` declare ``en``; nothing declares null."""
    tag = F.lower(F.trim(F.regexp_extract(declared.cast("string"), r"\A\s*([^-_]*)", 1)))
    return F.when(F.length(tag) > 0, tag)


def fit_text_model(docs: DataFrame, text_col: str, declared_col: str) -> TextModel:
    """Learn from a bounded sample of rows that declare a language."""
    rows = docs.select(primary(quoted(declared_col)).alias("l"),
                       quoted(text_col).cast("string").alias("text")).where(
        "l is not null and text is not null")
    # Copies of a text count once for the rate, or they would pass or fail together.
    counts = rows.select("l", F.xxhash64("text").alias("h")).groupBy("l").agg(
        F.count("*").alias("rows"), F.count_distinct("h").alias("n")).orderBy(
        F.desc("rows"), "l").limit(MAX_LANGUAGES).collect()
    if not counts:
        return TextModel()
    # Each language's texts pass with the rate that leaves about TRAIN_ROWS.
    rates = F.create_map(*[F.lit(x) for r in counts
                           for x in (r.l, min(1.0, 1.2 * TRAIN_ROWS / r.n))])
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)
    # Long texts are cut, not left out: a language may have no others.
    chosen = rows.where(place < F.try_element_at(rates, F.col("l"))).select(
        "l", F.left("text", F.lit(TRAIN_CHARS)).alias("text")).distinct()
    order = Window.partitionBy("l").orderBy(F.xxhash64("text", F.lit(1)), "text")
    samples: dict[str, list[str]] = {}
    for r in chosen.withColumn("k", F.row_number().over(order)).where(
            F.col("k") <= TRAIN_ROWS).orderBy("l", "k").collect():
        samples.setdefault(r.l, []).append(r.text)
    return TextModel.fit(samples)


def _classes_of_text(rows: DataFrame, model) -> DataFrame:
    """host, declared and the class that the text alone makes most likely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_chunks(whole, "text", 1 << 20):
                best = model.value.evidence(batch.column("text").to_pylist()).argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("host"), batch.column("declared"),
                     pa.array(best.astype(np.int32))], ["host", "declared", "k"])

    return rows.mapInArrow(tidy(run), "host string, declared string, k int")


def _declared_evidence(counts: list, classes: list[str]) -> dict[str, list[float]]:
    """log P(declared | class) from counts of (declared, k, n), one added everywhere."""
    kinds = [*classes[:-1], "other"]
    table = np.ones((len(kinds), len(classes)))
    for r in counts:
        table[kinds.index(r.d) if r.d in kinds else -1, r.k] += r.n
    table[:, -1] = 1  # texts without a language declare anything
    log = np.log(table / table.sum(0))
    return {kind: log[i].tolist() for i, kind in enumerate(kinds)}


def host_evidence(tally: DataFrame, classes: int, total: list[float]) -> DataFrame:
    """host and its evidence: log of the smoothed prior, plus what its suffix says.

    ``tally`` has a row per host: host, c0, c1, ... counts of classes.
    """
    names = [f"c{k}" for k in range(classes)]
    whole = sum(total)
    base = [(n + 1) / (whole + classes) for n in total]
    cut = F.instr("host", ".")
    # The parent of a.b.c is b.c; hosts of two labels or fewer have the table as parent.
    dots = F.length(F.regexp_replace("host", "[^.]", ""))
    tally = tally.withColumn("parent", F.when(dots >= 2, F.expr(
        "substring(host, instr(host, '.') + 1)"))).withColumn(
        "suffix", F.when((cut > 0) & ~F.col("host").rlike(r"^[0-9.:]+$"),
                         F.substring_index("host", ".", -1)))
    sums = lambda by: tally.where(F.col(by).isNotNull()).groupBy(by).agg(
        *[F.sum(n).alias(f"{by}_{n}") for n in names])
    rows = tally.join(staged(sums("parent")), "parent", "left").join(
        staged(sums("suffix")), "suffix", "left")
    count = lambda by: [F.coalesce(F.col(f"{by}_{n}"), F.lit(0)) for n in names]
    add = lambda columns: sum(columns[1:], columns[0])
    parent, suffix, own = count("parent"), count("suffix"), [F.col(n) for n in names]
    evidence = []
    for k in range(classes):
        above = (parent[k] + HOST_WEIGHT * base[k]) / (add(parent) + HOST_WEIGHT)
        prior = (own[k] + HOST_WEIGHT * above) / (add(own) + HOST_WEIGHT)
        # P(class | suffix) / P(class) is P(suffix | class) up to a constant.
        given = (suffix[k] + SUFFIX_WEIGHT * base[k]) / (add(suffix) + SUFFIX_WEIGHT)
        evidence.append(F.log(prior) + F.when(
            F.col("suffix").isNull(), 0.0).otherwise(F.log(given / base[k])))
    return rows.select("host", F.array(*evidence).alias("evidence"))


def identify(docs: DataFrame, text_col: str = "text", declared_col: str = "lang",
             host_col: str = "source") -> DataFrame:
    """All columns and language, confidence, text_language, rejected."""
    spark = docs.sparkSession
    model = fit_text_model(docs, text_col, declared_col)
    classes = model.classes
    held = spark.sparkContext.broadcast(model)
    host = F.lower(F.coalesce(quoted(host_col).cast("string"), F.lit("")))
    known = F.when(primary(quoted(declared_col)).isin(classes[:-1]),
                   primary(quoted(declared_col))).otherwise(F.when(
                       primary(quoted(declared_col)).isNotNull(), "other"))
    seen = staged(_classes_of_text(docs.select(
        host.alias("host"), known.alias("declared"),
        quoted(text_col).cast("string").alias("text")), held).groupBy(
        "host", "declared", "k").agg(F.count("*").alias("n")))
    declared = _declared_evidence(  # at most (MAX_LANGUAGES + 1) squared rows
        seen.where("declared is not null").groupBy(F.col("declared").alias("d"), "k").agg(
            F.sum("n").alias("n")).collect(), classes)
    per_host = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"c{k}")
                for k in range(len(classes))]
    overall = seen.agg(*per_host).first()
    tally = seen.groupBy("host").agg(*per_host)
    priors = staged(host_evidence(tally, len(classes), [float(x or 0) for x in overall]))

    names = {n: fresh(docs, n) for n in ("language", "confidence", "text_language", "rejected")}
    host_key, known_key, prior_key = (fresh(docs, n) for n in ("host_key", "known", "prior"))
    joined = docs.withColumn(host_key, host).withColumn(known_key, known).join(
        priors.select(F.col("host").alias(host_key), F.col("evidence").alias(prior_key)),
        host_key, "left").select(*[quoted(c) for c in docs.columns], known_key, prior_key)
    at, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [0.0] * len(classes)
        for whole in batches:
            for batch in text_chunks(whole, text_col, 1 << 20):
                text = held.value.evidence(
                    [None if t is None else str(t) for t in batch.column(at).to_pylist()])
                says = np.array([declared.get(d, none) for d in batch.column(width).to_pylist()])
                prior = np.array([p or none for p in batch.column(width + 1).to_pylist()])
                log = text + says + prior
                log -= log.max(1, keepdims=True)
                share = np.exp(log)
                share /= share.sum(1, keepdims=True)
                best = share.argmax(1)
                sure = share[np.arange(len(best)), best]
                bad = (best == len(classes) - 1) | (sure < MIN_CONFIDENCE)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], pa.array([classes[k] for k in best], pa.string()),
                     pa.array(sure), pa.array([classes[k] for k in text.argmax(1)], pa.string()),
                     pa.array(bad)], [*batch.schema.names[:width], *names.values()])

    kinds = ("string", "double", "string", "boolean")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                       for f in docs.schema)
    return joined.mapInArrow(
        tidy(run), schema + "".join(f", `{n}` {k}" for n, k in zip(names.values(), kinds)))


def op8_language_id(docs: DataFrame) -> DataFrame:
    """doc_id, declared language, language, confidence, what the text alone says, rejected."""
    return identify(docs.select("doc_id", "text", "lang", "source")).select(
        "doc_id", F.col("lang").alias("declared"), "language",
        F.round("confidence", 6).alias("confidence"), "text_language", "rejected")
