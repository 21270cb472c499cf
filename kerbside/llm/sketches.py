"""Bitmaps that Spark builds in segments and tasks read whole: Bloom filters and saturated counters.

A bitmap grows with what it stands for, ``bits_for`` rows, up to ``MOST_BITS`` (64 MB): what tasks are given has a proven bound.
Beyond that it fills up and lets more rows through; whoever asks it decides exactly afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_BITS = 1 << 29
SEGMENT_BITS = 16  # log2 of the bits in a segment
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@contextmanager
def batches_of(spark: SparkSession, rows: int, size: str | None = None) -> Iterator[None]:
    """Python tasks planned meanwhile get at most so many rows, and ``size`` bytes, at a time; the session's own settings come back."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    if size:
        names["spark.sql.execution.arrow.maxBytesPerBatch"] = size
    before = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def bits_for(rows: int, each: int = 16, most: int = MOST_BITS) -> int:
    """A power of two of at least ``each`` bits a row, at most ``most``, at least one segment."""
    wanted = max(1 << SEGMENT_BITS, rows * each)
    return min(most, 1 << (wanted - 1).bit_length())


def places(hashes: np.ndarray, bits: int, k: int = 2) -> list[np.ndarray]:
    """``k`` places below ``bits`` for each 64-bit hash."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    values = hashes.view(np.uint64) if hashes.dtype != np.uint64 else hashes
    with np.errstate(over="ignore"):
        return [((values ^ (values >> np.uint64(29))) * np.uint64(odd)) >> shift for odd in _ODD[:k]]


def inside(bitmap: np.ndarray, hashes: np.ndarray, k: int = 2) -> np.ndarray:
    """For each hash, whether all its places are set in ``bitmap`` (bytes)."""
    result = np.ones(len(hashes), bool)
    for p in places(hashes, len(bitmap) * 8, k):
        result &= (bitmap[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return result


def bitmap_of(cells: DataFrame, bits: int) -> np.ndarray:
    """The bytes of a bitmap in which the distinct ``cells`` (one BIGINT column below ``bits``) are set.

    A task sets the bits of some segments; the driver puts at most ``bits`` / 2^16 of them side by side.
    """
    column = cells.columns[0]

    def segment(rows: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(1 << SEGMENT_BITS, np.uint8)
        own[rows["bit"].to_numpy()] = 1
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "bytes": [np.packbits(own, bitorder="little").tobytes()]})

    parts = (
        cells.select(F.shiftright(column, SEGMENT_BITS).cast("int").alias("segment"),
                     F.col(column).bitwiseAND((1 << SEGMENT_BITS) - 1).cast("int").alias("bit"))
        .groupBy("segment").applyInPandas(segment, "segment int, bytes binary")
    )
    out = np.zeros(bits >> 3, np.uint8)
    width = 1 << SEGMENT_BITS - 3
    for r in parts.collect():  # at most MOST_BITS
        out[r.segment * width:(r.segment + 1) * width] = np.frombuffer(r.bytes, np.uint8)
    return out


def cells_of(hashes: DataFrame, bits: int, k: int = 2) -> DataFrame:
    """(cell): the places of each row's hash (one BIGINT column), ``k`` rows per row."""
    column = hashes.columns[0]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"cell": np.concatenate(places(batch[column].to_numpy(np.int64), bits, k)).view(np.int64)})

    return hashes.mapInPandas(rows, "cell long")


def bloom_of(hashes: DataFrame, rows: int, k: int = 2, by_driver: int = 1 << 20) -> np.ndarray:
    """A Bloom filter of ``rows`` distinct hashes (one BIGINT column). Up to ``by_driver`` of them (8 MB) the driver sets the bits itself."""
    bits = bits_for(rows)
    if rows > by_driver:
        return bitmap_of(cells_of(hashes, bits, k), bits)
    own = np.zeros(bits, np.uint8)
    for p in places(hashes.toPandas().iloc[:, 0].to_numpy(np.int64), bits, k):
        own[p] = 1
    return np.packbits(own, bitorder="little")


def asked(bitmap: np.ndarray, k: int = 2):
    """A column function: whether a hash (BIGINT) may be in ``bitmap``."""
    @F.pandas_udf("boolean")
    def may(values: pd.Series) -> pd.Series:
        return pd.Series(inside(bitmap, values.to_numpy(np.int64), k))

    return may
