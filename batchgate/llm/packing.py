"""Best-fit packing: a configuration LP over the length histogram.

Texts become token ids, longer ones are cut, and the pieces are packed into as few sequences
of ``capacity`` tokens as possible.  Packing sees only the histogram of piece lengths, at most
``capacity`` numbers for any corpus:

* *Patterns* say how many pieces of each length share a sequence.  The covering LP over all
  patterns is solved approximately by multiplicative weights.  In each of ``ROUNDS`` rounds a
  length weighs its share of a sequence times ``exp(-ETA * lead)``, where the lead is its
  coverage ahead of schedule; a knapsack DP over the capacity prices the best filling for
  every room, and each length behind schedule buys the pattern "itself plus the best filling".
* *Rounding*: whole multiples of the patterns as far as pieces remain; the rest, bounded by
  the number of patterns, goes best fit decreasing into the room that is left and new sequences.

The pieces are then dealt to the slots by their rank among pieces of the same length.  The rank
is the piece's number in its task plus an offset of the task, so no task sees all pieces of a
length.

Cases: a null text is an empty one and has one token, the separator; repeated rows are packed
each by itself; rows with a null id keep it; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import (
    CHUNK_BYTES,
    give_back,
    mixed,
    quoted,
    running_offsets,
    staged,
    tidy,
)

ROUNDS = 20
ETA = 24.0
# Text that is tokenised at once; its ids and their places take some ten times as much.
PART_BYTES = CHUNK_BYTES // 4
# Words whose ids a Python worker keeps; beyond it the memory starts anew.
CACHED_WORDS = 800_000
# Part of the fractional solution that is bought whole; the rest is rounded by best fit.
KEPT = 0.9
_BREAK = "<|startoftext|>"
# Words that the tokenizer's normal form only lower-cases, and how it parts them.
_PLAIN = re.compile("(?!.*<[|])[!-~À-ÖØ-öø-ÿ]+").fullmatch
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
# The tokenizer's characters for bytes: printable ones stand for themselves, others follow 255.
_BYTE_CHARS = dict(zip(
    (b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)),
    range(256, 512)))


class WordEncoder:
    """Token ids of whole texts, with the ids of words seen before kept in memory.

    The tokenizer never merges across white space, so a text's ids are those of its words.
    Each unknown word is encoded once: plain ones are parted here and merged by the tokenizer's
    model alone, others go through all of it, many at a time with a special token between them.
    Words are known by 128 bits of hash, which keeps a worker's memory small between its tasks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merged = self.tokenizer.model.tokenize
        self.stop = self.tokenizer.token_to_id(_BREAK)
        self.clear()

    def clear(self) -> None:
        # Known words by two hashes of their bytes, in the order of the first: 24 bytes a word.
        self.keys = np.zeros(1, np.uint64)
        self.checks = np.zeros(1, np.uint64)
        self.place = np.zeros(1, np.int32)
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(2, np.int64)  # the empty word is known and has no ids

    @staticmethod
    def _hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """128 bits a word; both are 0 for the empty one."""
        if not len(words):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        offsets = np.frombuffer(words.buffers()[1], np.int32).astype(np.int64)
        offsets = offsets[words.offset:words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        begin, size = offsets[:-1] - offsets[0], np.diff(offsets)
        if not len(raw):
            return np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
        at = np.arange(len(raw)) - np.repeat(begin, size)
        weights = mixed(np.arange(1, 2 * int(size.max()) + 1, dtype=np.uint64))
        letters = raw.astype(np.uint64) + np.uint64(1)
        first = np.minimum(begin, len(raw) - 1)
        return tuple(np.where(size > 0, mixed(np.add.reduceat(letters * w[at], first)), 0).astype(
            np.uint64) for w in (weights[::2], weights[1::2]))

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words, and which are known."""
        order = np.argsort(keys)
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(self.keys, keys[order])  # sorted, for the processor's cache
        at = np.minimum(at, len(self.keys) - 1)
        return self.place[at], (self.keys[at] == keys) & (self.checks[at] == checks)

    def _plain_ids(self, word: str) -> list[int]:
        word = word.lower()
        if word.isascii():
            parts = (word,) if word.isalpha() else _PARTS(word)
        else:
            parts = [part.encode().decode("latin-1").translate(_BYTE_CHARS)
                     for part in _PARTS(word)]
        return [token.id for part in parts for token in self.merged(part)]

    def _learn(self, words: list[str], keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Numbers of the new words."""
        plain, other, odd = [], [], []
        for k, word in enumerate(words):
            (plain if _PLAIN(word) else odd if "<|" in word else other).append(k)
        counts, parts = [], [self.flat]
        for at in range(0, len(plain), 4000):
            found = [self._plain_ids(words[k]) for k in plain[at:at + 4000]]
            counts.append(np.array([len(ids) for ids in found]))
            parts.append(np.fromiter(chain.from_iterable(found), np.int32))
        for at in range(0, len(other), 4000):
            ids = np.array(self.tokenizer.encode(
                f" {_BREAK} ".join([words[k] for k in other[at:at + 4000]]),
                add_special_tokens=False).ids, np.int32)
            ends = np.flatnonzero(np.append(ids, self.stop) == self.stop)
            counts.append(np.diff(ends, prepend=-1) - 1)
            parts.append(ids[ids != self.stop])
        for k in odd:
            ids = self.tokenizer.encode(words[k], add_special_tokens=False).ids
            counts.append(np.array([len(ids)]))
            parts.append(np.array(ids, np.int32))
        new = np.array(plain + other + odd)
        numbers = np.empty(len(new), np.int32)
        numbers[new] = len(self.starts) - 1 + np.arange(len(new))
        # The new words, sorted, go between the known ones.
        new = np.argsort(keys, kind="stable")
        place = numbers[new]
        at = np.searchsorted(self.keys, keys[new], "right")
        self.keys, self.checks, self.place = (
            np.insert(old, at, more) for old, more in (
                (self.keys, keys[new]), (self.checks, checks[new]), (self.place, place)))
        self.flat = np.concatenate(parts)
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts)))
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids end."""
        # The tokenizer ignores case and parts letters from stops; a special token keeps its case.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        texts = pc.replace_substring_regex(texts, r"([A-Za-z])([.,])", r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds -= bounds[0]
        keys, checks = self._hashes(coded.dictionary)
        at, known = self._find(keys, checks)
        if len(self.keys) + (~known).sum() > CACHED_WORDS:
            self.clear()
            at, known = self._find(keys, checks)
        if not known.all():
            at[~known] = self._learn(coded.dictionary.filter(pa.array(~known)).to_pylist(),
                                     keys[~known], checks[~known])
        begin = self.starts[at] if len(at) else np.zeros(0, np.int64)
        size = (self.starts[at + 1] - begin) if len(at) else begin
        codes = coded.indices.to_numpy()
        sizes = size[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(self.flat)) < 1 << 31 else np.int64
        place = np.repeat((begin[codes] - (ends - sizes)).astype(kind), sizes)
        place += np.arange(total, dtype=kind)
        return self.flat[place], np.append(0, ends)[bounds[1:]]


_ENCODERS: dict[str, WordEncoder] = {}


def text_chunks(batch: pa.RecordBatch, column: str,
                chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``chunk_bytes`` of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    if not len(sizes):
        return
    group = (np.cumsum(sizes, dtype=np.int64) - sizes) // chunk_bytes
    edges = np.flatnonzero(np.diff(group, prepend=-1)).tolist() + [len(sizes)]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, while their text is below PART_BYTES."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= PART_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece: its document's index, its number, its start; documents of the given lengths."""
    pieces = -(-lengths // capacity)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return owner, number, number * capacity


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise and cut: doc_id, piece, start, length, ids_crc32[, ids], and the place of the
    piece among those of its length in its task (task, place)."""
    source = docs.select(quoted(id_col).alias("doc_id"), F.coalesce(
        quoted(text_col).cast("string"), F.lit("")).alias("text"),
        F.spark_partition_id().alias("task"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def part_of(batch: pa.RecordBatch, encoder: WordEncoder, seen: np.ndarray) -> pa.RecordBatch:
        flat, ends = encoder.encode(batch.column("text"))
        # The separator closes each document.
        flat = np.insert(flat, ends, separator).astype("<u4", copy=False)
        ends = ends + np.arange(1, len(ends) + 1)
        lengths = np.diff(ends, prepend=0)
        owner, number, start = cut(lengths, capacity)
        begin = (ends - lengths)[owner] + start
        size = np.minimum(capacity, lengths[owner] - start)
        order = np.argsort(size, kind="stable")
        ordered = size[order]
        first = np.searchsorted(ordered, ordered)
        place = np.empty(len(size), np.int64)
        place[order] = np.arange(len(size)) - first + seen[ordered]
        seen += np.bincount(size, minlength=capacity + 1)
        view = memoryview(flat).cast("B")
        crc = [zlib.crc32(view[4 * a:4 * (a + n)]) for a, n in zip(begin, size)]
        columns = {
            "doc_id": batch.column("doc_id").take(pa.array(owner)),
            "piece": pa.array(number.astype(np.int32)), "start": pa.array(start),
            "length": pa.array(size), "ids_crc32": pa.array(crc, pa.int64()),
            "task": batch.column("task").take(pa.array(owner)), "place": pa.array(place),
        }
        if with_ids:
            columns["ids"] = pa.array(
                [flat[a:a + n].astype(np.int32) for a, n in zip(begin, size)],
                pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(
            tokenizer, WordEncoder(tokenizer))
        seen = np.zeros(capacity + 1, np.int64)
        for whole in gathered(batches, "text"):
            for batch in text_chunks(whole, "text", PART_BYTES):
                yield part_of(batch, encoder, seen)
                give_back()  # else what parts leave adds up

    return source.mapInArrow(
        tidy(run), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, task int, "
             "place long" + ", ids array<int>" * with_ids)


def _knapsack(lengths: np.ndarray, worth: np.ndarray, capacity: int):
    """Best worth for every room, and the length bought there last (-1: none)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.searchsorted(lengths, room, "right")
        best[room], last[room] = best[room - 1], -1
        if fits:
            value = best[room - lengths[:fits]] + worth[:fits]
            k = int(value.argmax())
            if value[k] > best[room]:
                best[room], last[room] = value[k], k
    return best, last


def _filling(last: np.ndarray, lengths: np.ndarray, room: int) -> list[int]:
    found = []
    while room > 0:
        k = last[room]
        if k < 0:
            room -= 1
        else:
            found.append(int(k))
            room -= int(lengths[k])
    return found


Packing = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, copies), ...), sequences


def solve(histogram: dict[int, int], capacity: int) -> Packing:
    """Patterns and how many sequences use each; together they hold exactly the histogram."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    need = np.array([histogram[n] for n in lengths.tolist()], float)
    covered = np.zeros(len(lengths))
    bought: dict[tuple[int, ...], float] = defaultdict(float)
    for step in range(1, ROUNDS + 1):
        goal = step / ROUNDS
        worth = lengths / capacity * np.exp(-ETA * np.clip(covered / need - goal, -0.5, 0.5))
        # What is covered to the end is worth nothing more.
        worth[covered >= need] = 0
        _, last = _knapsack(lengths, worth, capacity)
        for k in range(len(lengths) - 1, -1, -1):
            behind = goal * need[k] - covered[k]
            if behind <= 1e-9:
                continue
            fill = [k, *_filling(last, lengths, capacity - int(lengths[k]))]
            kinds, copies = np.unique(fill, return_counts=True)
            # Not more than what the rarest filling still lacks, but progress at least.
            times = behind / copies[kinds == k][0]
            lack = (need[kinds] - covered[kinds]) / copies
            spare = lack[kinds != k]
            if len(spare) and 0 < spare.min() < times:
                times = max(float(spare.min()), times / 4)
            covered[kinds] += times * copies
            bought[tuple(sorted(fill, reverse=True))] += times

    left = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    packing: Packing = []
    waste = {fill: capacity - int(lengths[list(fill)].sum()) for fill in bought}
    usual = sum(waste[f] * x for f, x in bought.items()) / sum(bought.values())
    for fill, amount in sorted(bought.items(), key=lambda x: (waste[x[0]], -x[1], x[0])):
        if waste[fill] > usual + 1e-9:
            break
        kinds, copies = np.unique(fill, return_counts=True)
        times = int(min(np.floor(KEPT * amount + 1e-9), (left[kinds] // copies).min()))
        if times > 0:
            left[kinds] -= times * copies
            packing.append((tuple((int(lengths[k]), int(c)) for k, c in zip(kinds, copies)),
                            times))
    packed = _best_fit(packing, dict(zip(lengths.tolist(), left.tolist())), capacity)
    # Where many lengths are few, rounding can cost more than the patterns save.
    plain = _best_fit([], histogram, capacity)
    return min(packed, plain, key=lambda p: sum(times for _, times in p))


def _best_fit(packing: Packing, left: dict[int, int], capacity: int) -> Packing:
    """Best fit decreasing of what is left, over groups of equal sequences."""
    rooms: dict[int, list[list]] = defaultdict(list)  # room: [contents, sequences]
    for contents, times in packing:
        rooms[capacity - sum(n * c for n, c in contents)].append([contents, times])
    open_rooms = np.zeros(capacity + 1, bool)
    for room in rooms:
        open_rooms[room] = True

    def put(contents, length, times, room):
        more = dict(contents)
        more[length] = more.get(length, 0) + 1
        rooms[room - length].append([tuple(more.items()), times])
        open_rooms[room - length] = True

    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            fits = np.flatnonzero(open_rooms[length:])
            if not len(fits):
                each = capacity // length
                full, rest = divmod(n, each)
                if full:
                    room = capacity - each * length
                    rooms[room].append([((length, each),), full])
                    open_rooms[room] = True
                if rest:
                    rooms[capacity - rest * length].append([((length, rest),), 1])
                    open_rooms[capacity - rest * length] = True
                break
            room = length + int(fits[0])
            contents, times = rooms[room].pop()
            if not rooms[room]:
                open_rooms[room] = False
            if times > n:
                rooms[room].append([contents, times - n])
                open_rooms[room] = True
            used = min(times, n)
            put(contents, length, used, room)
            n -= used
    return [(tuple(sorted(c, reverse=True)), t) for room in sorted(rooms) for c, t in rooms[room]]


def slots(packing: Packing) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, for each pattern that holds it: where its slots begin, copies, first sequence,
    place in the sequence."""
    found, first = defaultdict(list), 0
    for contents, times in packing:
        at = 0
        for length, copies in contents:
            found[length].append((times * copies, copies, first, at))
            at += length * copies
        first += times
    out = {}
    for length, rows in found.items():
        many, copies, base, at = (np.array(x, np.int64) for x in zip(*rows))
        out[length] = (np.cumsum(many) - many, copies, base, at)
    return out


def pack(cut_pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to ``pieces``."""
    histogram = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(
        F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = slots(solve(histogram, capacity))
    per_task = cut_pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    bases = running_offsets(per_task, "task", "n", ["length"]).select("length", "task", "base")
    ranked = cut_pieces.join(bases, ["length", "task"]).withColumn(
        "place", F.col("place") + F.col("base")).drop("base", "task")
    columns = [c for c in cut_pieces.columns if c not in ("task", "place")]
    schema = ", ".join(f"{c} {cut_pieces.schema[c].dataType.simpleString()}" for c in columns)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            place = batch.column("place").to_numpy()
            sequence, offset = np.empty_like(place), np.empty_like(place)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1)).tolist() + [len(order)]
            for a, b in zip(edges, edges[1:]):
                mine = order[a:b]
                n = int(length[mine[0]])
                begin, copies, base, at = plan[n]
                j = np.searchsorted(begin, place[mine], "right") - 1
                nth, copy = np.divmod(place[mine] - begin[j], copies[j])
                sequence[mine] = base[j] + nth
                offset[mine] = at[j] + copy * n
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in columns}
                | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return ranked.select(*columns, "place").mapInArrow(
        tidy(deal), f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """The packed sequences themselves, from pieces made ``with_ids``: sequence_id, input_ids and
    the doc_ids in order; a group holds at most ``capacity`` tokens."""
    part = F.struct("offset", "doc_id", "piece", "ids")
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("input_ids"), F.col("p.doc_id").alias("doc_ids"))


def op1_best_fit_packing(docs: DataFrame, tokenizer: str | None = None,
                         capacity: int = 2048) -> DataFrame:
    """All documents packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(staged(pieces(docs, tokenizer, capacity)), capacity)
