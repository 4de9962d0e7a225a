"""Bitmaps of 64-bit hashes, bounded in size, by which tasks skip rows that can't matter; and XXH64 of longs as Spark computes it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import U

#: Least and most bits of a bitmap, as powers of two, and the bits that one task puts together.
LEAST_BITS, MOST_BITS, SEGMENT = 20, 28, 1 << 20


def _hash_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of 8 bytes."""
    turned = lambda v, n: v << U(n) | v >> U(64 - n)
    h = seed + U(2870177450012600261 + 8) ^ turned(x * U(14029467366897019727), 31) * U(11400714785074694791)
    h = turned(h, 27) * U(11400714785074694791) + U(9650029242287828579)
    h = (h ^ h >> U(33)) * U(14029467366897019727)
    h = (h ^ h >> U(29)) * U(1609587929392839161)
    return h ^ h >> U(32)


def hashed(x: np.ndarray) -> np.ndarray:
    """The same as F.xxhash64(x) of a long."""
    return _hash_long(x, np.array([42], U))


def chained(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same as F.xxhash64(x, y) of two longs."""
    return _hash_long(y, hashed(x))


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash has its bit set; so it is for all hashes that the bitmap was made of, and by chance for few others."""
    bits = U(len(bitmap).bit_length() + 2)
    at = hashes >> U(64) - bits
    return bitmap[at >> U(3)] >> (at & U(7)).astype(np.uint8) & 1 == 1


def _segment(bits: int):
    """For applyInArrow over the marks of one segment of a bitmap: the segment's bytes."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        there = np.zeros(min(SEGMENT, 1 << bits), np.uint8)
        there[rows.column("at").to_numpy() % SEGMENT] = 1
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bytes": pa.array([np.packbits(there, bitorder="little").tobytes()], pa.binary())})

    return run


def bitmap_of(hashes: DataFrame, column: str):
    """A broadcast bitmap of a column of hashes, of about 32 bits for each row and 2 ** MOST_BITS bits at most: 32 MB. Beyond that more
    hashes pass by chance, never less."""
    spark = hashes.sparkSession
    bits = min(MOST_BITS, max(LEAST_BITS, (32 * hashes.count()).bit_length()))
    places = hashes.select(F.shiftrightunsigned(column, 64 - bits).alias("at")).distinct().withColumn("segment", F.floor(F.col("at") / SEGMENT))
    out = np.zeros(1 << bits - 3, np.uint8)
    for row in places.groupBy("segment").applyInArrow(_segment(bits), "segment long, bytes binary").collect():
        lo = row.segment * SEGMENT // 8
        out[lo : lo + len(row.bytes)] = np.frombuffer(row.bytes, np.uint8)
    return spark.sparkContext.broadcast(out.tobytes())
