"""Hashes with the same value in every engine and on every layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits: exact as a bigint and as a double


def stable_hash(seed: int, *columns: Column | str) -> Column:
    """A 52-bit non-negative integer from the MD5 of ``seed:col:col...``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def unit_interval(seed: int, *columns: Column | str) -> Column:
    """A number in [0, 1) fixed by the seed and the columns."""
    return stable_hash(seed, *columns) / F.lit(float(16 ** _HEX_DIGITS))
