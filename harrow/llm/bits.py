"""Row filters of a fixed size: a bit per hash of a row's key."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 23  # bits of a filter: one megabyte, whatever the size of the data


def bit_of(key: Column | str, size: int = FILTER_BITS) -> Column:
    """The bit that stands for a key."""
    return F.pmod(F.xxhash64(key), F.lit(size)).cast("long")


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """The packed bits of all keys.  A key that is not among them may still have its bit set."""
    return packed_bits(keys.select(bit_of(key).alias("bit")))


def packed_bits(rows: DataFrame, size: int = FILTER_BITS) -> np.ndarray:
    """The bits in the column ``bit``, put together by Spark in parts of a few kilobytes.

    All parts come in one job, as they are no more than the filter.
    """
    # Bits are numbered from 1 here, as Spark's first bucket starts there.
    bits = rows.select((F.col("bit") + 1).alias("bit"))
    parts = (bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).toArrow())
    found = np.zeros(size // 8, np.uint8)
    for bucket, part in zip(*(column.to_pylist() for column in parts.columns), strict=True):
        found[(bucket - 1) * len(part):bucket * len(part)] = np.frombuffer(part, np.uint8)
    return found


def is_set(packed: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each of the bits is set."""
    bits = bits.astype(np.int64)
    return (packed[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)
