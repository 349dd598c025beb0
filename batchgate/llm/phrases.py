"""Phrase collocation mining by dynamic itemset counting.

Texts become word hashes once, dealt into shards.  Shards are scanned in a cycle, one a step, and
phrases of all lengths are counted side by side: words from the first step on, a longer phrase
from the step after both phrases it gets by leaving out its last or first word have reached the
threshold, and every phrase for exactly one full cycle.  The scans end when no phrase is left
that has not completed its cycle, before one pass per length if the corpus is even.

What is active is told to the tasks by an array of fixed size: a phrase's place in it, by hash,
holds the step from which extensions of the phrase count.  The start of a longer phrase is the
latest of its two parts' steps and starts, so every task finds by itself whether a phrase is
within its cycle.  Two phrases in one place can only let more phrases be counted, never fewer, and each of
those for a full cycle too; the counts themselves are exact, by grouped aggregation over keys of
64-bit word hashes.  Tasks count slices of a million words before they send anything; between
steps only phrases within their cycle are carried, in a written table.

A phrase of two words or more that occurs often enough is scored by its weakest cut, and dropped
if a longer one that holds it occurs nearly as often.  Words are looked up in the texts at the
end, for the phrases that are still in question.

Cases: a null text is empty; a null language is ``und``; repeated rows count as often as they
are there; a table without words, or without frequent phrases, gives no rows; very long texts are
counted in slices that overlap by three words; other columns are ignored.  Different words are
taken to have different hashes (64 bits); those of the words that are returned are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.llm.common import mixed, quoted, staged, tidy
from batchgate.llm.packing import text_chunks
from batchgate.session import scratch_folder
from batchgate.sources import files

LONGEST = 4
MIN_COUNT = 30
TOP = 2000
# A longer phrase with this share of a phrase's count, in percent, takes its place.
SUBSUMED = 80
SCALE = 2_000_000
SHARDS = 3
# Places of the activation array, as a power of two: one for 16 words, within these bounds.
PLACE_BITS = (22, 28)
# Partitions in which the array's bits come to the driver, 32 MB in all at most.
MAP_PARTS = 8
SLICE = 1 << 20
_NEVER = 255
_U = np.uint64

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LETTER = np.arange(1, 257, dtype=np.uint64)
_LETTER[65:91] += _U(32)
_WEIGHT = mixed(np.arange(1 << 20, (1 << 20) + (1 << 12), dtype=np.uint64))


def word_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, each text ended by a break, and first, behind and kinds of their words."""
    raw = np.frombuffer(b"\n".join([*(t.encode() for t in texts), b""]), np.uint8)
    kind = _KIND[raw]
    edge = np.flatnonzero(np.diff((kind > 0).view(np.int8), prepend=1, append=1))
    return raw, edge[::2], edge[1::2], kind


def word_hashes(raw: np.ndarray, first: np.ndarray, behind: np.ndarray,
                kind: np.ndarray) -> np.ndarray:
    """A number for each word, 0 for none: its bytes times a random number for their places."""
    if not len(first):
        return np.zeros(0, np.uint64)
    length = behind - first
    begin = np.cumsum(length) - length
    place = (np.arange(int(length.sum())) - np.repeat(begin, length)).astype(np.int32)
    weight = _WEIGHT
    if length.max() > len(weight):
        weight = mixed(np.arange(1 << 20, (1 << 20) + int(length.max()), dtype=np.uint64))
    hashes = mixed(np.add.reduceat(_LETTER[raw[kind == 0]] * weight[place], begin))
    return np.where(hashes == 0, _U(1), hashes)


def tokens_of(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text, with a 0 between two pieces."""
    raw, first, behind, kind = word_spans(texts)
    hashes = word_hashes(raw, first, behind, kind)
    piece = np.cumsum(kind == 2)[first]
    at = np.arange(len(first)) + np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)
    laid = np.zeros(int(at[-1]) + 1 if len(at) else 0, np.uint64)
    laid[at] = hashes
    ends = np.cumsum([len(t.encode()) + 1 for t in texts])
    bound = [0, *np.searchsorted(first, ends).tolist()]
    return [laid[at[a]:at[b - 1] + 1] if b > a else laid[:0] for a, b in zip(bound, bound[1:])]


def _documents(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(quoted(lang_col).cast("string"), F.lit("und"))
    return docs.select(F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
                       lang.alias("lang"), F.xxhash64(lang).alias("lang_id"))


def shard_table(documents: DataFrame, shards: int, folder: str) -> DataFrame:
    """Write the texts' words, dealt into shards; a row holds one text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for whole in batches:
            for batch in text_chunks(whole, "text", 1 << 20):
                words = tokens_of(batch.column("text").to_pylist())
                dealt = (number + np.arange(len(words))) % shards
                number += len(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(dealt, pa.int32()), batch.column("lang_id"), batch.column("lang"),
                     pa.array([np.count_nonzero(w) for w in words], pa.int64()),
                     pa.array([w.tobytes() for w in words], pa.binary())],
                    ["shard", "lang_id", "lang", "n_words", "words"])

    schema = "lang_id long, lang string, n_words long, words binary, shard int"
    rows = documents.mapInArrow(tidy(run), "shard int, lang_id long, lang string, n_words long, "
                                           "words binary").where("n_words > 0")
    rows.write.partitionBy("shard").parquet(folder)
    return documents.sparkSession.read.schema(schema).parquet(folder)


def places(columns: list[np.ndarray], bits: int) -> np.ndarray:
    """Places of phrases in the activation array; the first column is the language."""
    x = columns[0]
    for column in columns[1:]:
        x = mixed(x * _U(0x9E3779B97F4A7C15) + column)
    return (x >> _U(64 - bits)).astype(np.int64)


def slice_counts(words: np.ndarray, lang: int, starts: np.ndarray, step: int,
                 shards: int, owned: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys (rows of language and words), counts and start steps of the phrases that count now.

    They begin at one of the first ``owned`` words.
    """
    bits = len(starts).bit_length() - 1
    distinct, number = np.unique(words, return_inverse=True)
    seed = np.array([lang], np.int64).view(np.uint64)

    def found(at: np.ndarray, code: np.ndarray, width: int, start: np.ndarray):
        _, one, n = np.unique(code, return_index=True, return_counts=True)
        where = at[one]
        key = np.empty((len(where), width + 1), np.uint64)
        key[:, 0] = seed
        for k in range(width):
            key[:, k + 1] = words[where + k]
        return key, n, start[one]

    if step < shards:
        at = np.flatnonzero(words[:owned])
        yield found(at, number[at], 1, np.zeros(len(at), np.int16))
    own = starts[places([np.broadcast_to(seed, len(distinct)), distinct], bits)].astype(np.int16)
    own[distinct == 0] = _NEVER
    before = own[number]
    for width in range(2, LONGEST + 1):
        both = np.maximum(before[:-1], before[1:])
        at = np.flatnonzero((both[:owned] <= step) & (both[:owned] > step - shards))
        if len(at):
            code = number[at] << 21 | number[at + 1]
            if width == 3:
                code = code << 21 | number[at + 2]
            elif width == 4:
                rest = number[at + 2] << 21 | number[at + 3]
                code, rest = (np.unique(x, return_inverse=True)[1] for x in (code, rest))
                code = code << 21 | rest
            yield found(at, code, width, both[at])
        before = np.full(len(both), _NEVER, np.int16)
        live = np.flatnonzero(both <= step)
        if not len(live) or width == LONGEST:
            return
        # Not before the phrase itself counts, whatever else lies in its place: until then its
        # extensions are not seen, and their cycle would be cut short.
        before[live] = np.maximum(both[live], starts[places(
            [np.broadcast_to(seed, len(live)), *(words[live + k] for k in range(width))], bits)])


def _counted(shard: DataFrame, starts, step: int, shards: int) -> DataFrame:
    """key, n, start of the phrases that count in this step, in parts."""

    def rows_of(words: np.ndarray, lang: int) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(words), SLICE):
            part = words[a:a + SLICE + LONGEST - 1]
            for key, n, start in slice_counts(part, lang, starts.value, step, shards,
                                              min(SLICE, len(part))):
                width = key.shape[1] * 8
                for b in range(0, len(key), 1 << 18):
                    few = np.ascontiguousarray(key[b:b + (1 << 18)])
                    ends = np.arange(len(few) + 1, dtype=np.int32) * width
                    yield pa.RecordBatch.from_arrays(
                        [pa.Array.from_buffers(pa.binary(), len(few), [
                            None, pa.py_buffer(ends), pa.py_buffer(few)]),
                         pa.array(n[b:b + (1 << 18)], pa.int64()),
                         pa.array(start[b:b + (1 << 18)], pa.int32())], ["key", "n", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        gap = np.zeros(1, np.uint64)

        def flush():
            for lang, texts in held.items():
                yield from rows_of(np.concatenate([x for t in texts for x in (t, gap)]), lang)
            held.clear()

        for batch in batches:
            for lang, raw in zip(batch.column("lang_id").to_pylist(),
                                 batch.column("words")):
                words = np.frombuffer(raw.as_buffer(), np.uint64).copy()
                held.setdefault(lang, []).append(words)
                size += len(words)
                if size >= SLICE:
                    yield from flush()
                    size = 0
        yield from flush()

    return shard.select("lang_id", "words").mapInArrow(
        tidy(run), "key binary, n long, start int")


def marked(keys: DataFrame, bits: int) -> np.ndarray:
    """Which places the keys have, as an array of fixed size built by grouped aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("key").to_pylist()
            out = np.zeros(len(raw), np.int64)
            sizes = np.array([len(r) for r in raw], np.int64)
            for width in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == width)
                key = np.frombuffer(b"".join([raw[k] for k in at]), np.uint64).reshape(len(at), -1)
                out[at] = places(list(key.T), bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(out) + 1, pa.int64())], ["p"])

    spots = keys.select("key").mapInArrow(tidy(run), "p long").select(
        F.bitmap_bucket_number("p").alias("k"), F.bitmap_bit_position("p").alias("bit"))
    out = np.zeros(1 << bits, bool)
    maps = spots.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("m"))
    # The driver runs a job for each partition it iterates over.
    for row in maps.coalesce(MAP_PARTS).toLocalIterator():
        own = np.unpackbits(np.frombuffer(row.m, np.uint8), bitorder="little")
        at = (row.k - 1) * 32768
        out[at:at + len(own)] |= own[:len(out) - at].astype(bool)
    return out


def _words(key: Column | str) -> Column:
    return F.octet_length(key) / 8 - 1


def _part(key: str, first: Column, many: Column) -> Column:
    """The key of ``many`` words of a key, from word ``first`` (from 0) on."""
    return F.concat(F.substring(key, 1, 8),
                    F.substring(F.col(key), 9 + 8 * first, 8 * many))


def frequent_phrases(shards: DataFrame, folder: str, n_shards: int, min_count: int,
                     n_words: int) -> DataFrame:
    """key and n of all phrases of up to LONGEST words that occur ``min_count`` times."""
    spark = shards.sparkSession
    bits = min(max((n_words // 16).bit_length(), PLACE_BITS[0]), PLACE_BITS[1])
    starts = np.full(1 << bits, _NEVER, np.uint8)
    carried, carried_at = None, None
    whole: DataFrame | None = None
    step = 0
    while step < n_shards or ((starts <= step) & (starts.astype(np.int16) > step - n_shards)).any():
        held = spark.sparkContext.broadcast(starts)
        parts = _counted(shards.where(F.col("shard") == step % n_shards), held, step, n_shards)
        if carried is not None:
            parts = parts.unionByName(carried.where(F.col("start") > step - n_shards))
        at = f"{folder}/step-{step}"
        now = staged(parts.groupBy("key").agg(F.sum("n").alias("n"), F.max("start").alias("start")),
                     at)
        held.unpersist()
        if carried_at:
            files.delete_tree(spark, carried_at)
        carried, carried_at = now, at
        often = now.where(F.col("n") >= min_count)
        ended = staged(often.where(F.col("start") == step - n_shards + 1).select("key", "n"),
                       f"{folder}/ended-{step}")
        whole = ended if whole is None else whole.unionByName(ended)
        step += 1
        new = marked(often.where(_words("key") < LONGEST), bits)
        starts = np.where(new & (starts == _NEVER), np.uint8(step), starts)
    return whole


def weakest_cuts(frequent: DataFrame) -> DataFrame:
    """key, a, l, r, score of every frequent phrase of two words or more."""
    n = frequent.select("key", "n")
    phrases = n.where(_words("key") >= 2).withColumnRenamed("n", "a")
    cuts = phrases.withColumn("k", F.explode(F.sequence(
        F.lit(1), (_words("key") - 1).cast("int"))))
    k, size = F.col("k"), _words("key").cast("int")
    cuts = cuts.select("key", "a", "k", _part("key", F.lit(0), k).alias("left"),
                       _part("key", k, size - k).alias("right"))
    parted = cuts.join(n.select(F.col("key").alias("left"), F.col("n").alias("l")), "left").join(
        n.select(F.col("key").alias("right"), F.col("n").alias("r")), "right")
    score = F.expr(f"cast(a as decimal(20,0)) * {SCALE} div "
                   "(cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    return parted.groupBy("key").agg(
        F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")
    ).select("key", "a", "c.score", "c.l", "c.r")


def without_parts(scored: DataFrame, subsumed: int) -> DataFrame:
    """Phrases that no longer one holds with ``subsumed`` percent of their count."""
    size = _words("key").cast("int")
    parts = scored.where(_words("key") >= 3).select(
        F.col("a").alias("other"), "key",
        F.explode(F.sequence(F.lit(2), size - 1)).alias("many")).select(
        "other", "key", "many", F.explode(F.sequence(F.lit(0), size - F.col("many"))).alias("at"))
    most = parts.select(_part("key", F.col("at"), F.col("many")).alias("key"), "other").groupBy(
        "key").agg(F.max("other").alias("other"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    return scored.join(most, "key", "left").where(
        F.col("other").isNull() | (wide("other") * 100 < wide("a") * subsumed)).drop("other")


def _word_table(documents: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """hash (bytes) and word of the words in the keys, looked up in the texts."""
    wanted = keys.select(F.explode(F.transform(
        F.sequence(F.lit(1), _words("key").cast("int")),
        lambda k: F.substring(F.col("key"), 1 + 8 * k, F.lit(8)))).alias("key")).distinct()
    held = documents.sparkSession.sparkContext.broadcast(marked(
        wanted.select(F.concat(F.lit(bytes(8)), "key").alias("key")), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = held.value
        seen: set[int] = set()
        for whole in batches:
            for batch in text_chunks(whole, "text", 1 << 20):
                raw, first, behind, kind = word_spans(batch.column("text").to_pylist())
                hashes = word_hashes(raw, first, behind, kind)
                at = np.flatnonzero(hit[places([np.zeros(len(hashes), np.uint64), hashes], bits)])
                if len(seen) > SLICE:
                    seen.clear()
                _, one = np.unique(hashes[at], return_index=True)
                at = [k for k in at[one].tolist() if hashes[k] not in seen]
                seen.update(hashes[at].tolist())
                text = raw.tobytes()
                words = [text[first[k]:behind[k]].lower().decode() for k in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashes[k].tobytes() for k in at], pa.binary()),
                     pa.array(words, pa.string())], ["hash", "word"])

    found = documents.select("text").mapInArrow(tidy(run), "hash binary, word string").distinct()
    return found.join(wanted.withColumnRenamed("key", "hash"), "hash")


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP,
            subsumed: int = SUBSUMED, shards: int = SHARDS, text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    documents = _documents(docs, text_col, lang_col)
    sharded = shard_table(documents, shards, f"{folder}/words")
    langs = staged(sharded.groupBy("lang_id", "lang").agg(F.sum("n_words").alias("n")))
    total = langs.agg(F.sum("n")).first()[0] or 0
    frequent = staged(frequent_phrases(sharded, folder, shards, min_count, total))
    files.delete_tree(spark, f"{folder}/words")
    scored = staged(weakest_cuts(frequent))
    lang = F.substring("key", 1, 8)
    kept = without_parts(scored, subsumed).withColumn("own", lang)
    # Ties stay until the words are known.  A language's phrases meet in 64 groups first.
    best = [F.col("score").desc(), F.col("a").desc()]
    first = Window.partitionBy("own", "deal").orderBy(*best)
    short = kept.withColumn("deal", F.pmod(F.xxhash64("key"), F.lit(64))).withColumn(
        "place", F.rank().over(first)).where(F.col("place") <= top)
    short = short.withColumn("place", F.rank().over(Window.partitionBy("own").orderBy(*best)))
    short = staged(short.where(F.col("place") <= top).drop("deal", "place"))
    bits = PLACE_BITS[0]
    each = short.select("key", F.posexplode(F.transform(
        F.sequence(F.lit(1), _words("key").cast("int")),
        lambda k: F.substring(F.col("key"), 1 + 8 * k, F.lit(8)))).alias("at", "hash"))
    words = each.join(_word_table(documents, short, bits), "hash")
    one = words.groupBy("key").agg(F.concat_ws(" ", F.transform(
        F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x.word)).alias("phrase"),
        F.count("*").alias("found"))
    named = short.join(one, "key")
    last = Window.partitionBy("own").orderBy(*best, F.col("phrase"))
    ranked = named.withColumn("rank", F.row_number().over(last).cast("long")).where(
        F.col("rank") <= top)
    # A language's number, as it stands in the keys: little-endian bytes.
    own = langs.withColumn("own", F.unhex(F.concat(*[
        F.lpad(F.hex(F.shiftrightunsigned("lang_id", 8 * k).bitwiseAND(F.lit(255))), 2, "0")
        for k in range(8)])))
    whole = F.when(F.col("found") == _words("key"), F.col("phrase")).otherwise(
        F.raise_error("two words with one hash"))
    return ranked.join(own, "own").select(
        "lang", "rank", whole.alias("phrase"), "a", "l", "r", "n", "score")


def op11_phrases(docs: DataFrame) -> DataFrame:
    """The best collocations of every language, over all documents."""
    return phrases(docs)
