"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

A document's set holds 64-bit hashes of its distinct word 5-grams.  Two sets link when
``100 * intersection >= percent * union``.  Equal sets are one *class*, so exact copies cost one
comparison; all below is about classes.

1. **Frequencies.**  Each task counts n-grams into a fixed array of counters; the sum over tasks,
   as a logarithm in one byte a counter, orders all n-grams: rare first, ties by hash.
2. **Prefixes.**  Two sets that link share an n-gram among the first ``n - ceil(percent n) + 1``
   of each.  Tasks send prefix n-grams in packed blocks to buckets by hash; a bucket is sorted and
   keeps the n-grams that more than one class has.  An n-gram with many entries is dealt to
   several groups of its bucket.
3. **First round: stars.**  In each group of an n-gram, every class is paired with the group's
   smallest.  Links found connect large groups of near copies with few pairs.
4. **Second round: the rest.**  All pairs that share a prefix n-gram and are not connected yet;
   the members of an n-gram's largest component are not paired with each other.  N-grams with up
   to PAIRED entries give pairs of rows, linear in the entries.  The classes of more frequent ones
   meet as blocks of sets: those outside the largest component against all, block against block,
   and a task gives back no more links than connect what it saw.  So no group of near copies is
   expanded into pairs, and after this round no link between different components is missing.

Pairs pass a *length* filter, a *positional* filter (what can still be shared behind the n-gram's
place in both orders) and a *suffix* filter (both sets cut into ranges of hash values, the sum of
smaller range counts bounds the intersection) before the sets meet and are compared, once.

Sets are built anew from the texts where they are needed; a fixed-size bit array of the ids in
question spares most documents that work, and lets more pass when it fills, never fewer.

Cases: null and empty texts have no n-grams and are their own component; a text of fewer than
five words has its whole sequence as one n-gram; repeated rows get the same result each; a null
id keeps its row and is no candidate for the smallest id; an empty table gives an empty result;
other columns are ignored.  Hashes of different n-grams or sets are taken to differ (64 bits).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import mixed, quoted, staged, tidy
from batchgate.llm.components import components
from batchgate.llm.membership import bit_array, may_hold, spot
from batchgate.llm.packing import text_chunks

NGRAM = 5
PERCENT = 75
# N-grams a counter stands for on average, while the array is within its bounds.
COUNTER_LOAD = 64
COUNTER_BITS = (14, 24)
# Prefix n-grams that meet in one group of a bucket, on average; above it one n-gram is divided.
GROUP_TOKENS = 500_000
# Prefix n-grams that a task holds before it sends them off.
FLUSH_TOKENS = 250_000
RANGES = 64
# Entries of an n-gram that are paired row by row, and sets in a block otherwise.
PAIRED, BLOCK_SETS = 32, 256

_U = np.uint64
_WEIGHTS = np.random.default_rng(20240917).integers(1, 1 << 63, 16, dtype=np.uint64) * _U(2) + _U(1)


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64) + _U(1)
_LOWER[65:91] += _U(32)
_PLACE = mixed(np.arange(1, 1 << 12, dtype=np.uint64))


def ngram_sets(texts: list[str | None], n: int = NGRAM) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    # A space behind each text keeps words of neighbours apart.
    parts = [(t or "").encode() for t in texts]
    raw = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1, append=1))
    first, behind = edge[::2], edge[1::2]
    if not len(first):
        return [np.zeros(0, np.uint64) for _ in texts]
    # A word's hash: its bytes, each times a random number for its place in the word.
    length = behind - first
    letters = _LOWER[raw[~space]]
    begin = np.cumsum(length) - length
    place = (np.arange(len(letters)) - np.repeat(begin, length)).astype(np.int32)
    weight = _PLACE
    if length.max() > len(weight):
        weight = mixed(np.arange(1, int(length.max()) + 1, dtype=np.uint64))
    words = mixed(np.add.reduceat(letters * weight[place], begin))
    owner_end = np.searchsorted(first, ends)  # words of each text end there
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        grams += words[k:k + len(grams)] * _WEIGHTS[k]
    grams = mixed(grams)
    out, a = [], 0
    for b in owner_end.tolist():
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            some = (words[a:b] * _WEIGHTS[8:8 + b - a]).sum(dtype=np.uint64) + _U(b - a)
            out.append(mixed(np.array([some], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        a = b
    return out


def class_of(grams: np.ndarray) -> int:
    """One number for equal sets."""
    return int(mixed(grams ^ _U(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).astype(np.int64))


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for k, grams in enumerate(ngram_sets(batch.column("text").to_pylist(), n)):
        yield k, grams


def small_chunks(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about 1 MB, as n-gram arrays are several times as large as the text."""
    return text_chunks(whole, "text", 1 << 20)


def _prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _needed(a, b, percent: int):
    """Least intersection of sets of a and b n-grams that link."""
    return -(-percent * (a + b) // (100 + percent))


def summaries(rows: DataFrame, bits: int, n: int) -> DataFrame:
    """Two kinds of rows: doc_id, n_grams, class of each document (part is null), and per task
    the counters in parts of 2**12."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint32)
        seen: set[int] = set()
        id_type = None
        schema = None
        for whole in batches:
            id_type = whole.schema.field("doc_id").type
            schema = pa.schema([("doc_id", id_type), ("n_grams", pa.int64()),
                                ("class", pa.int64()), ("part", pa.int32()),
                                ("counters", pa.binary())])
            for batch in small_chunks(whole):
                sizes, classes, new = [], [], []
                for _, grams in _sets(batch, n):
                    sizes.append(len(grams))
                    own = class_of(grams) if len(grams) else None
                    classes.append(own)
                    if own is not None and own not in seen:
                        seen.add(own)
                        new.append(grams)
                if new:
                    at = (np.concatenate(new) >> _U(64 - bits)).astype(np.int64)
                    np.add.at(counters, at, np.uint32(1))
                rows_here = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                     pa.array(classes, pa.int64()), pa.nulls(rows_here, pa.int32()),
                     pa.nulls(rows_here, pa.binary())], schema=schema)
        if seen:
            small = counters.astype(np.uint16 if counters.max() < 1 << 16 else np.uint32)
            parts = small.reshape(-1, min(len(small), 1 << 12))
            none = lambda kind: pa.nulls(len(parts), kind)
            yield pa.RecordBatch.from_arrays(
                [none(id_type), none(pa.int64()), none(pa.int64()),
                 pa.array(range(len(parts)), pa.int32()),
                 pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema)

    return rows.mapInArrow(
        tidy(run), f"doc_id {kind}, n_grams long, class long, part int, counters binary")


def levels(parts: DataFrame, bits: int) -> np.ndarray:
    """Frequencies of hashed n-grams over all documents, as 4 log2 in one byte: fixed size."""
    width = min(1 << bits, 1 << 12)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, None

        def out():
            level = np.round(4 * np.log2(total + 1)).astype(np.uint8)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()),
                 "level": pa.array([level.tobytes()], pa.binary())})

        for batch in batches:
            for k, raw in zip(batch.column("part").to_pylist(),
                              batch.column("counters").to_pylist()):
                if k != part:
                    if part is not None:
                        yield out()
                    part, total = k, np.zeros(width, np.float64)
                total += np.frombuffer(raw, np.uint16 if len(raw) == 2 * width else np.uint32)
        if part is not None:
            yield out()

    summed = (parts.repartition("part").sortWithinPartitions("part")
              .mapInArrow(tidy(add), "part int, level binary"))
    out = np.zeros(1 << bits, np.uint8)
    for row in summed.toLocalIterator():
        out[row.part * width:(row.part + 1) * width] = np.frombuffer(row.level, np.uint8)
    return out


_BLOCK = "bucket int, portion int, tokens binary, classes binary, sizes binary, places binary"


def prefix_blocks(rows: DataFrame, level, bits: int, buckets: int, n: int, percent: int,
                  group_tokens: int) -> DataFrame:
    """Prefix n-grams of each class a task meets, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = level.value
        many = _U(buckets)
        usual = np.exp2(np.median(rank) / 4)
        seen: set[int] = set()
        held: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            tokens, classes, sizes, places = (np.concatenate(x) for x in zip(*held))
            bucket = (tokens % many).astype(np.int64)
            count = np.exp2(rank[(tokens >> _U(64 - bits)).astype(np.int64)] / 4)
            # Portion 0 holds whole n-grams; one that is frequent by far is dealt to others.
            share = np.maximum(1, np.round((count - usual) / group_tokens)).astype(np.uint64)
            portion = (mixed(classes.view(np.uint64)) % share).astype(np.int64) + (share > 1)
            order = np.lexsort((classes, portion, bucket))
            bucket, portion = bucket[order], portion[order]
            cut = np.flatnonzero(np.append(True, (np.diff(bucket) != 0) | (np.diff(portion) != 0)))
            edges = [*cut.tolist(), len(order)]
            arrays = [((tokens // many) & _U(0xFFFFFFFF)).astype("<u4")[order],
                      classes[order].astype("<i8"), sizes[order].astype("<u4"),
                      places[order].astype("<u4")]
            pack = lambda x: pa.array(
                [x[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut], pa.int32()), pa.array(portion[cut], pa.int32()),
                 *map(pack, arrays)],
                ["bucket", "portion", "tokens", "classes", "sizes", "places"])

        for whole in batches:
            for batch in small_chunks(whole):
                for _, grams in _sets(batch, n):
                    size = len(grams)
                    own = class_of(grams) if size else None
                    if own is None or own in seen:
                        continue
                    seen.add(own)
                    keep = _prefix(size, percent)
                    order = np.argsort(
                        rank[(grams >> _U(64 - bits)).astype(np.int64)], kind="stable")[:keep]
                    held.append((grams[order], np.full(keep, own, np.int64),
                                 np.full(keep, size, np.int64), np.arange(keep)))
                    total += keep
                    if total >= FLUSH_TOKENS:
                        yield flush()
                        held, total = [], 0
        if held:
            yield flush()

    return rows.mapInArrow(tidy(run), _BLOCK)


def shared_tokens(blocks: DataFrame, buckets: int) -> DataFrame:
    """Prefix n-grams that several classes have: token, class, n, place and the smallest class
    of the group with its own n and place.  Single entries of a divided n-gram are kept too."""
    names = ["token", "class", "n", "place", "star", "star_n", "star_place"]

    def run(key, table):
        bucket, divided = key[0].as_py(), key[1].as_py() > 0
        join = lambda c, t: np.frombuffer(
            b"".join(table.column(c).to_pylist()), t)
        tokens, classes = join("tokens", "<u4"), join("classes", "<i8")
        sizes, places = join("sizes", "<u4"), join("places", "<u4")
        order = np.lexsort((classes, tokens))
        tokens, classes = tokens[order], classes[order]
        sizes, places = sizes[order], places[order]
        # A class that several tasks met counts once.
        new = np.append(True, (np.diff(tokens) != 0) | (np.diff(classes) != 0))
        tokens, classes, sizes, places = (x[new] for x in (tokens, classes, sizes, places))
        first = np.flatnonzero(np.append(True, np.diff(tokens) != 0))
        run_length = np.diff(np.append(first, len(tokens)))
        star = np.repeat(first, run_length)
        keep = np.repeat((run_length > 1) | divided, run_length)
        token = tokens.astype(np.int64) * buckets + bucket
        columns = [token, classes, sizes.astype(np.int64), places.astype(np.int64),
                   classes[star], sizes[star].astype(np.int64), places[star].astype(np.int64)]
        return pa.table({c: x[keep] for c, x in zip(names, columns)})

    return blocks.groupBy("bucket", "portion").applyInArrow(
        run, ", ".join(f"{c} long" for c in names))


def _passes(a_n, a_place, b_n, b_place, percent: int):
    """Length and positional filter, exact at the first n-gram that both prefixes share."""
    need = F.ceil(percent * (a_n + b_n) / (100 + percent))
    rest = F.least(a_n - a_place, b_n - b_place)
    return (100 * F.least(a_n, b_n) >= percent * F.greatest(a_n, b_n)) & (rest >= need)


def class_sets(rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """class, n, range counts and set of documents with one of the wanted ids (column doc_id),
    and of some others."""
    held = rows.sparkSession.sparkContext.broadcast(bit_array(wanted, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, seen = held.value, set()
        for whole in batches:
            hit = may_hold(bitmap, whole.column("p").to_numpy())
            chosen = whole.filter(pa.array(hit))
            for batch in small_chunks(chosen) if chosen.num_rows else ():
                found = []
                for _, grams in _sets(batch, n):
                    own = class_of(grams) if len(grams) else None
                    if own is not None and own not in seen:
                        seen.add(own)
                        ranges = np.bincount((grams >> _U(58)).astype(np.int64), minlength=RANGES)
                        found.append((own, len(grams), ranges.astype("<u4").tobytes(),
                                      grams.astype("<u8").tobytes()))
                if found:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*found), kinds)],
                        ["class", "n", "ranges", "grams"])

    keyed = rows.select("doc_id", "text", spot("doc_id").alias("p"))
    return keyed.mapInArrow(tidy(run), "class long, n long, ranges binary, grams binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""

    def both(columns: list[str], found: DataFrame) -> DataFrame:
        side = lambda x: sets.select(
            F.col("class").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in columns])
        return found.join(side("a"), "a").join(side("b"), "b")

    def suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = lambda c: np.frombuffer(
                    b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, RANGES)
                bound = np.minimum(matrix("a_ranges"), matrix("b_ranges")).sum(1, np.int64)
                need = _needed(batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy(),
                               percent)
                kept = batch.filter(pa.array(bound >= need))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("a"), kept.column("b")], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column("a_grams"), batch.column("b_grams")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                links.append(common >= _needed(len(x), len(y), percent))
            kept = batch.filter(pa.array(links, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    close = staged(both(["n", "ranges"], pairs).select("a", "b", "a_n", "b_n", "a_ranges",
                                                       "b_ranges")
                   .mapInArrow(tidy(suffix), "a long, b long").distinct())
    return staged(both(["grams"], close).select("a", "b", "a_grams", "b_grams")
                  .mapInArrow(tidy(compare), "a long, b long").distinct())


def _common(grams: np.ndarray, tokens: np.ndarray, owners: np.ndarray, many: int) -> np.ndarray:
    """How many n-grams a set shares with each of many sets, given as sorted tokens and owners."""
    first, behind = np.searchsorted(tokens, grams), np.searchsorted(tokens, grams, "right")
    length = behind - first
    ends = np.cumsum(length)
    at = np.arange(ends[-1]) + np.repeat(first - (ends - length), length)
    return np.bincount(owners[at], minlength=many)


def block_links(entries: DataFrame, sets: DataFrame, percent: int,
                block_sets: int = BLOCK_SETS) -> DataFrame:
    """Links (a, b) between classes of different roots in the same group (column main).

    ``entries`` has main, class and root.  Blocks hold either members of the main component or
    others; others are compared with all.
    """
    inside = F.col("root") == F.col("main")
    counts = staged(entries.groupBy("main").agg(
        F.ceil(F.count(F.when(inside, 1)) / block_sets).alias("own"),
        F.ceil(F.count(F.when(~inside, 1)) / block_sets).alias("others")))
    part = F.when(inside, -1 - F.pmod(F.xxhash64("class"), F.col("own"))).otherwise(
        F.pmod(F.xxhash64("class"), F.col("others")))
    placed = entries.join(counts, "main").select("main", "class", "root", part.alias("part"))
    blocks = staged(placed.join(sets.select("class", "grams"), "class").groupBy(
        "main", "part").agg(F.collect_list(F.struct("class", "root", "grams")).alias("sets")))
    # The numbers of the blocks that meet: others with others once, and with the component's.
    x = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("x")
    numbers = counts.where("others > 0").select("main", "own", "others", x)
    y = F.explode(F.sequence(-F.col("own"), F.col("others") - 1)).alias("y")
    meet = numbers.select("main", "x", y).where("y < 0 or y >= x")
    side = lambda n: blocks.select(
        "main", F.col("part").alias(n), F.col("sets").alias(f"{n}_sets"))
    both = meet.join(side("x"), ["main", "x"]).join(side("y"), ["main", "y"])

    def unpack(column):
        grams = [np.frombuffer(v, "<u8") for v in column.field("grams").to_pylist()]
        return column.field("class").to_pylist(), column.field("root").to_pylist(), grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for left, right in zip(batch.column("x_sets"), batch.column("y_sets")):
                classes, roots, grams = unpack(left.values)
                others, other_roots, other_grams = unpack(right.values)
                sizes = np.array([len(g) for g in other_grams], np.int64)
                owners = np.repeat(np.arange(len(sizes)), sizes)
                tokens = np.concatenate(other_grams)
                order = np.argsort(tokens, kind="stable")
                tokens, owners = tokens[order], owners[order]
                joined: dict[int, int] = {}

                def top(node: int) -> int:
                    while node in joined:
                        node = joined[node]
                    return node

                for i, own in enumerate(grams):
                    shared = _common(own, tokens, owners, len(sizes))
                    linked = np.flatnonzero(shared >= _needed(len(own), sizes, percent))
                    for k in linked.tolist():
                        a, b = top(roots[i]), top(other_roots[k])
                        if a != b:
                            joined[a] = b
                            found.append((classes[i], others[k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return staged(both.select("x_sets", "y_sets").mapInArrow(
        tidy(run), "a long, b long").distinct())


def jaccard_links(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT,
                  id_col: str = "doc_id", text_col: str = "text",
                  group_tokens: int = GROUP_TOKENS,
                  paired: int = PAIRED) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_grams, class) and links (a, b) between classes.

    The links connect exactly what all links would connect; links inside a component that the
    first round found connected are not all listed.
    """
    spark = docs.sparkSession
    rows = docs.select(quoted(id_col).alias("doc_id"),
                       quoted(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tokens = size / 6 + 1
    low, high = COUNTER_BITS
    bits = max(low, min(high, math.ceil(math.log2(tokens / COUNTER_LOAD + 1))))
    buckets = max(64, math.ceil(tokens * (1 - percent / 100) / group_tokens))

    summed = staged(summaries(rows, bits, n))
    documents = summed.where("part is null").select("doc_id", "n_grams", "class")
    level = spark.sparkContext.broadcast(
        levels(summed.where("part is not null").select("part", "counters"), bits))
    shared = staged(shared_tokens(
        prefix_blocks(rows.select("text"), level, bits, buckets, n, percent, group_tokens),
        buckets))

    owners = documents.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"))

    def sets_of(classes: DataFrame) -> DataFrame:
        """Only the sets that are asked for are built."""
        return staged(class_sets(rows, owners.join(classes, "class", "left_semi"), n))

    def linked(pairs: DataFrame) -> DataFrame:
        classes = pairs.select(F.col("a").alias("class")).unionByName(
            pairs.select(F.col("b").alias("class"))).distinct()
        return verified(pairs, sets_of(classes), percent)

    ordered = [F.least("class", "star").alias("a"), F.greatest("class", "star").alias("b")]
    stars = staged(shared.where((F.col("class") != F.col("star")) & _passes(
        F.col("n"), F.col("place"), F.col("star_n"), F.col("star_place"), percent))
        .select(*ordered).distinct())
    near = linked(stars)

    roots = components(near)
    entries = staged(shared.select("token", "class", "n", "place").join(
        roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")))
    per_root = entries.groupBy("token", "root").agg(F.count("*").alias("c"))
    main = per_root.groupBy("token").agg(
        F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots"),
        F.sum("c").alias("entries")).where("roots > 1").select("token", "main", "entries")
    open_entries = staged(entries.join(main, "token"))

    few = open_entries.where(F.col("entries") <= paired)
    x, y = few.where("root <> main").alias("x"), few.alias("y")
    met = x.join(y, F.col("x.token") == F.col("y.token")).where(
        (F.col("x.root") != F.col("y.root")) & _passes(
            F.col("x.n"), F.col("x.place"), F.col("y.n"), F.col("y.place"), percent))
    rest = met.select(F.least("x.class", "y.class").alias("a"),
                      F.greatest("x.class", "y.class").alias("b")).distinct()
    rest = staged(rest.join(stars, ["a", "b"], "left_anti"))

    many = staged(open_entries.where(F.col("entries") > paired).select(
        "main", "class", "root").distinct())
    crowded = block_links(many, sets_of(many.select("class").distinct()), percent)
    return documents, near.unionByName(linked(rest)).unionByName(crowded)


def near_duplicate_groups(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT,
                          id_col: str = "doc_id", text_col: str = "text",
                          group_tokens: int = GROUP_TOKENS, paired: int = PAIRED) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links lead to."""
    documents, links = jaccard_links(
        docs, n, percent, id_col, text_col, group_tokens, paired)
    roots = components(links)
    placed = staged(documents.join(
        roots.withColumnRenamed("node", "class"), "class", "left").select(
        "doc_id", "n_grams", F.coalesce("root", "class").alias("root")))
    smallest = staged(placed.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("smallest")))
    return placed.join(smallest, "root", "left").select(
        "doc_id", F.col("n_grams").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(
            F.col("smallest")).alias("component_id"))


def op9_ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    """All documents with the size of their set and their component."""
    return near_duplicate_groups(docs)
