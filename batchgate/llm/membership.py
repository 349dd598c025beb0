"""A fixed-size bit array of numbers, to skip most rows before an exact join."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 8 MB for any table; a full array lets more rows pass, never fewer.
BITS = 1 << 26
# Partitions in which the array comes to the driver.
MAP_PARTS = 8


def spot(column: Column | str) -> Column:
    """A number's place in the array, from 1."""
    return F.pmod(F.xxhash64(column), F.lit(BITS)) + 1


def own_spot(column: Column | str) -> Column:
    """The place of a number that is a hash already; ``number % BITS + 1`` in Python."""
    return F.pmod(column, F.lit(BITS)) + 1


def bit_array(rows: DataFrame, column: str, place: Callable = spot) -> np.ndarray:
    """The array of a column's values, built by grouped aggregation."""
    places = rows.select(place(column).alias("p")).select(
        F.bitmap_bucket_number("p").alias("k"), F.bitmap_bit_position("p").alias("bit"))
    bits = np.zeros(BITS // 8, np.uint8)
    maps = places.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("m"))
    # The driver runs a job for each partition it iterates over.
    for row in maps.coalesce(MAP_PARTS).toLocalIterator():
        own = np.frombuffer(row.m, np.uint8)
        bits[(row.k - 1) * 4096:(row.k - 1) * 4096 + len(own)] = own
    return bits


def may_hold(bits: np.ndarray, spots: np.ndarray) -> np.ndarray:
    at = spots - 1
    return (bits[at // 8] >> (at % 8).astype(np.uint8)) & 1 > 0
