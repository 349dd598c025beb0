"""Approximate nearest neighbours by an adaptive dimension scan inside probed lists.

The index is fitted on a bounded sample (SAMPLE_ROWS, smallest id hashes): k-means centres, and a
random rotation that spreads every vector's length evenly over the dimensions.  All rows are
then assigned to their nearest centre's list, one list per LIST_ROWS rows up to MAX_LISTS, and
lists are packed in blocks of BLOCK_ROWS rows; a list of any length is only more blocks.

A query is sent to the blocks of its nearest lists, QUERY_ROWS queries of a list at a time.  How
many lists, the sample tells: as few as hold the share TARGET of the neighbours that sample rows
have in the sample.  Well clustered vectors need few, vectors without structure most of the lists.
In a block the rotated vectors are scanned by columns.  After each column block a
hypothesis test asks whether the whole distance can still be below the query's k-th best: the
partial distance over d of D dimensions estimates ``d/D`` of it with a relative error of about
``1/sqrt(d)``, and a candidate is abandoned once it lies CONFIDENCE such errors beyond.  The first
bound comes from the sample's own neighbours, which also count as found.  What survives is
measured exactly: Euclidean distance on the original vectors in double precision.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part,
nor do rows with a null id or vectors of another length than the most frequent one; rows of one
id count once, with the smallest vector; equal vectors tie and smaller ids come first; with no
more than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.llm.common import bounded_sample, quoted, staged, tidy

SAMPLE_ROWS = 32_768
SEED_ROWS = 4_096
LIST_ROWS = 1_024
MAX_LISTS = 1_024
BLOCK_ROWS = 4_096
QUERY_ROWS = 256
TARGET = 0.96
CALIBRATION_ROWS = 256
CONFIDENCE = 2.5
COLUMNS = 16
SEED = 20240917


def usable(vector: Column) -> Column:
    """Whether a vector can take part: finite, not null anywhere, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dimensions: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    gauss = np.random.default_rng(SEED).standard_normal((dimensions, dimensions))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def centres_of(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """K-means centres of a sample."""
    lists = min(lists, len(sample))
    start = np.random.default_rng(SEED).choice(len(sample), lists, replace=False)
    centres = sample[np.sort(start)].copy()
    for _ in range(rounds):
        own = nearest(sample, centres, 1)[:, 0]
        count = np.bincount(own, minlength=lists)
        order = np.argsort(own, kind="stable")
        full = count > 0
        begin = (np.cumsum(count) - count)[full]
        centres[full] = np.add.reduceat(sample[order], begin, axis=0) / count[full][:, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray, many: int) -> np.ndarray:
    """Numbers of the nearest centres of each row, nearest first."""
    many = min(many, len(centres))
    norm = (centres ** 2).sum(1)
    out = np.empty((len(rows), many), np.int64)
    for at in range(0, len(rows), 4096):
        far = norm - 2 * rows[at:at + 4096] @ centres.T
        some = np.argpartition(far, many - 1, axis=1)[:, :many]
        order = np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable")
        out[at:at + 4096] = np.take_along_axis(some, order, 1)
    return out


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int) -> int:
    """Nearest lists that hold the share TARGET of the k nearest sample rows of some of them."""
    asked = sample[:CALIBRATION_ROWS]
    order = nearest(asked, centres, len(centres))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centres))[None, :], 1)
    close = nearest(asked, sample, k + 1)  # itself among them, always in the first list or so
    own = nearest(sample, centres, 1)[:, 0]
    ranks = np.take_along_axis(rank, own[close[:, 1:]], 1).ravel()
    return int(np.quantile(ranks, TARGET, method="higher")) + 1 if len(ranks) else 1


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - query) ** 2).sum(axis=1))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest scores, ties to smaller ids, in that order."""
    if len(ids) > k:
        limit = np.partition(scores, k - 1)[k - 1]
        few = np.flatnonzero(scores <= limit)
    else:
        few = np.arange(len(ids))
    return few[np.lexsort((ids[few], scores[few]))][:k]


def scan(query: np.ndarray, turned: np.ndarray, block: np.ndarray, block_turned: np.ndarray,
         alive: np.ndarray, bound: float) -> np.ndarray:
    """Rows of a block, of those in ``alive``, that the tests do not abandon."""
    size = len(turned)
    partial = np.zeros(len(alive))
    # Equal vectors may be rotated differently in their last bits.
    reach = bound + 4 * size * np.finfo(np.float64).eps * (
        2 * np.sqrt((turned ** 2).sum()) + bound)
    for a in range(0, size, COLUMNS):
        b = min(size, a + COLUMNS)
        partial += ((block_turned[alive, a:b] - turned[a:b]) ** 2).sum(axis=1)
        if b < size and np.isfinite(bound):
            keep = partial <= reach ** 2 * (b / size) * (1 + CONFIDENCE / np.sqrt(b)) ** 2
            alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
    return alive


def _matrix(column) -> np.ndarray:
    """A list column of equally long vectors."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, probes: int | None = None,
           list_rows: int = LIST_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's nearest rows found; both frames have columns
    vec_id and vector, one row per id, and queries are no candidates of their own."""
    spark = vectors.sparkSession
    total = vectors.count()
    sample = bounded_sample(vectors, ["vec_id"], SAMPLE_ROWS).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    ids = np.array([r.vec_id for r in sample], np.int64)
    points = np.array([r.vector for r in sample], np.float64)
    lists = max(1, min(MAX_LISTS, round(total / list_rows)))
    centres = centres_of(points, lists)
    probes = probes or probes_needed(points, centres, k)
    held = spark.sparkContext.broadcast((centres, ids[:SEED_ROWS], points[:SEED_ROWS]))
    kind = vectors.schema["vector"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = held.value[0]
        for batch in batches:
            if batch.num_rows:
                own = nearest(_matrix(batch.column("vector")), centres, 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.astype(np.int32)), *batch.columns], ["list", "id", "vector"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, seed_ids, seeds = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, own = _matrix(batch.column("vector")), batch.column("vec_id").to_numpy()
            lists_of = nearest(rows, centres, probes)
            found = []
            for query, me in zip(rows, own):
                score = distances(seeds, query)
                score[seed_ids == me] = np.inf
                first = best(seed_ids, score, k)
                first = first[np.isfinite(score[first])]
                found.append([{"id": int(seed_ids[i]), "score": float(score[i])} for i in first])
            again = np.repeat(np.arange(len(rows)), lists_of.shape[1])
            bound = [f[-1]["score"] if len(f) == k else np.inf for f in found]
            # The sample's neighbours travel with the nearest list only.
            near = [f if j == 0 else [] for f in found for j in range(lists_of.shape[1])]
            seeds_type = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists_of.ravel().astype(np.int32)),
                 batch.column("vec_id").take(pa.array(again)),
                 batch.column("vector").take(pa.array(again)),
                 pa.array(np.array(bound)[again]), pa.array(near, seeds_type)],
                ["list", "id", "vector", "bound", "near"])

    rows = vectors.select("vec_id", "vector").mapInArrow(tidy(assign), f"list int, id long, vector {kind}")
    asked = queries.select("vec_id", "vector").mapInArrow(
        tidy(probe), f"list int, id long, vector {kind}, bound double, "
               "near array<struct<id: long, score: double>>")
    rows, asked = staged(rows), staged(asked)

    def packed(frame: DataFrame, size: int, name: str, *more: str) -> DataFrame:
        # A row per list: bounded by MAX_LISTS, so broadcast.
        parts = frame.groupBy("list").agg(F.ceil(F.count("*") / size).alias("parts"))
        part = F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")
        return (frame.join(F.broadcast(parts), "list").withColumn("part", part)
                .groupBy("list", "part").agg(
                    F.collect_list(F.struct("id", "vector", *more)).alias(name)))

    met = packed(rows, BLOCK_ROWS, "rows").drop("part").join(
        packed(asked, QUERY_ROWS, "asked", "bound").drop("part"), "list")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = None
        for batch in batches:
            for here, those in zip(batch.column("rows"), batch.column("asked")):
                here, those = here.values, those.values
                block, wanted = _matrix(here.field("vector")), _matrix(those.field("vector"))
                row_ids, query_ids = (x.field("id").to_numpy() for x in (here, those))
                if turn is None:
                    turn = rotation(block.shape[1])
                block_turned, turned = block @ turn, wanted @ turn
                out = []
                for query, spun, me, bound in zip(wanted, turned, query_ids,
                                                  those.field("bound").to_numpy()):
                    kept, scores = np.zeros(0, np.int64), np.zeros(0)
                    for at in range(0, len(block), 1024):
                        alive = np.arange(at, min(len(block), at + 1024))
                        alive = scan(query, spun, block, block_turned,
                                     alive[row_ids[alive] != me], bound)
                        kept = np.append(kept, alive)
                        scores = np.append(scores, distances(block[alive], query))
                        top = best(row_ids[kept], scores, k)
                        kept, scores = kept[top], scores[top]
                        if len(top) == k:
                            bound = min(bound, scores[-1])
                    out.append((np.full(len(kept), me), row_ids[kept], scores))
                columns = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    scanned = met.select("rows", "asked").mapInArrow(
        tidy(compare), "query_id long, vec_id long, score double")
    seeds = asked.select(F.col("id").alias("query_id"), F.explode("near").alias("s")).select(
        "query_id", F.col("s.id").alias("vec_id"), F.col("s.score").alias("score"))
    found = scanned.unionByName(seeds).groupBy("query_id", "vec_id").agg(
        F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def prepared(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part, one per id."""
    fine = table.select(quoted(id_col).cast("long").alias("vec_id"),
                        quoted(vector_col).alias("vector")).where(
        F.col("vec_id").isNotNull() & usable(F.col("vector")))
    once = staged(fine.groupBy("vec_id").agg(F.min("vector").alias("vector")))
    sizes = once.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("c"))
    usual = sizes.orderBy(F.desc("c"), "n").first()
    return once.where(F.size("vector") == (usual.n if usual else 0))


def op10_nearest_neighbours(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``, against all rows."""
    rows = prepared(embeddings)
    return search(rows, rows.where(F.col("vec_id") % every == 0), k)
