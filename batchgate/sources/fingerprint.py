"""Content digests of files from the digests of their lines: a sha256 tree over numbered lines.

A leaf digests LEAF neighbouring lines of a file by their numbers, a node LEAF neighbouring
nodes of the level below, so a root depends on content and order and not on how the file was
split.  It holds against forgery as sha256 does: no other lines give the same root.

Lines must be materialised, in the order of their scan.  A task walks its rows in that order,
digests the leaves that lie in it whole, and passes on the line digests of the others: no more
than two a split, of less than 32 KB each.  Lines are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

LEAF = 1024
_BYTES = 32


def line_digest(line: Column) -> Column:
    return F.unhex(F.sha2(line, 256))


def leaf_pieces(lines: DataFrame, splits: DataFrame, leaf: int = LEAF) -> DataFrame:
    """``first_mid`` of the split, ``leaf``, ``at`` (place in it), ``whole``, ``digests``.

    ``digests`` is the leaf's digest if the piece is a whole leaf, else those of its lines.  Every
    task gets the number of the first line of every split, 16 bytes each.
    """
    table = splits.select("first_mid", "offset").orderBy("first_mid").toArrow()
    starts, offsets = (table.column(c).to_numpy() for c in ("first_mid", "offset"))
    held = lines.sparkSession.sparkContext.broadcast((starts, offsets))

    # Workers get these functions by value: they need numpy and Arrow, not this package.
    def runs(mid: np.ndarray, split: np.ndarray, line: np.ndarray) -> np.ndarray:
        """Where runs of neighbouring lines of one split and leaf start, and the end."""
        new = (np.diff(mid) != 1) | (np.diff(split) != 0) | (np.diff(line // leaf) != 0)
        return np.concatenate([[0], np.flatnonzero(new) + 1, [len(mid)]])

    def rows(pieces: list) -> pa.RecordBatch:
        columns = list(zip(*pieces)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["first_mid", "leaf", "at", "whole", "digests"])

    def piece(first_mid: int, line: int, digests: bytearray) -> tuple:
        whole = len(digests) == leaf * _BYTES
        return (first_mid, line // leaf, line % leaf, whole,
                hashlib.sha256(digests).digest() if whole else bytes(digests))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, offsets = held.value
        first_mid = line = after = -1
        digests = bytearray()
        for batch in batches:
            if not batch.num_rows:
                continue
            column, mid = batch.column("line_digest"), batch.column("mid").to_numpy()
            begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if column.offset else 0
            data = memoryview(column.buffers()[2])[int(begin):]
            split = np.searchsorted(starts, mid, "right") - 1
            number = offsets[split] + mid - starts[split]
            done = []
            edges = runs(mid, split, number)
            for low, high in zip(edges[:-1], edges[1:]):
                goes_on = (mid[low] == after and starts[split[low]] == first_mid
                           and number[low] // leaf == line // leaf)
                if not goes_on:
                    if digests:
                        done.append(piece(first_mid, line, digests))
                    first_mid, line = int(starts[split[low]]), int(number[low])
                    digests = bytearray()
                digests += data[low * _BYTES:high * _BYTES]
                after = int(mid[high - 1]) + 1
            if done:
                yield rows(done)
        if digests:
            yield rows([piece(first_mid, line, digests)])

    return lines.select("mid", "line_digest").mapInArrow(
        run, "first_mid long, leaf long, at int, whole boolean, digests binary")


def _joined(order: str, digests: str) -> Column:
    """The digests of a group's rows one behind the other, in order."""
    rows = F.array_sort(F.collect_list(F.struct(order, digests)))
    return F.aggregate(rows, F.lit(b"").cast("binary"), lambda a, r: F.concat(a, r[digests]))


def file_roots(lines: DataFrame, splits: DataFrame, most_lines: int,
               leaf: int = LEAF) -> DataFrame:
    """``hospital, file, root`` (hex) of all files that hold lines.

    ``lines`` has ``mid`` and ``line_digest``, ``splits`` a row per split of a file with its
    ``first_mid`` and ``offset`` (lines before it); no file has more than ``most_lines``.
    """
    keys = ["hospital", "file"]
    pieces = leaf_pieces(lines, splits, leaf).join(splits.select(*keys, "first_mid"), "first_mid")
    # A group is a leaf: 32 KB of digests at most.
    nodes = pieces.groupBy(*keys, F.col("leaf").alias("number")).agg(
        F.bool_or("whole").alias("whole"), _joined("at", "digests").alias("digests")).select(
        *keys, "number", F.when(F.col("whole"), F.col("digests")).otherwise(
            F.unhex(F.sha2("digests", 256))).alias("digest"))
    span = leaf
    while span < most_lines:
        span *= leaf
        nodes = nodes.groupBy(*keys, F.floor(F.col("number") / leaf).alias("up")).agg(
            _joined("number", "digest").alias("digests")).select(
            *keys, F.col("up").alias("number"), F.unhex(F.sha2("digests", 256)).alias("digest"))
    return nodes.select(*keys, F.lower(F.hex("digest")).alias("root"))
