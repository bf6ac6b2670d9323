"""A many-to-many join whose hot keys are spread over many tasks, with whole results.

Joins with at most one row per key on one side are ordinary joins: Spark broadcasts a
small side, and adaptive execution splits the rows of a hot key over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2_000   # rows of one key, per side, that a single task may pair up


def blocks(count: Column | str, size: int = BLOCK_ROWS) -> Column:
    """How many blocks of ``size`` rows hold ``count`` rows; at least one."""
    count = F.col(count) if isinstance(count, str) else count
    return F.greatest(F.lit(1), F.ceil(count / F.lit(float(size)))).cast("int")


def slot_of(ids: Sequence[str], n: Column) -> Column:
    """The slot, of ``n``, that a row with these ids goes to."""
    return F.pmod(F.xxhash64(*ids), n).cast("int")


def every_slot(n: Column) -> Column:
    """A copy of the row for each of ``n`` slots."""
    return F.explode(F.sequence(F.lit(0), n - 1))


def join_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str],
               left_ids: Sequence[str], right_ids: Sequence[str],
               n_left: Column | str, n_right: Column | str,
               size: int = BLOCK_ROWS) -> DataFrame:
    """Inner many-to-many join with each key's product cut into blocks.

    ``n_left`` and ``n_right`` are (upper bounds of) the rows of the key on each
    side; both expressions must give the same value on both inputs.  A key is
    cut into a grid: a row goes to its own line of the grid and is copied
    along the other direction, so every pair meets exactly once and no task
    sees more than about ``size`` x ``size`` pairs of one key.  The join always
    shuffles: the size Spark expects of either side leaves out the copies.
    """
    keys = list(keys)
    lines, columns = blocks(n_left, size), blocks(n_right, size)
    left = (left.withColumn("_line", slot_of(left_ids, lines))
            .withColumn("_column", every_slot(columns)))
    right = (right.withColumn("_column", slot_of(right_ids, columns))
             .withColumn("_line", every_slot(lines)))
    return (left.join(right.hint("merge"), [*keys, "_line", "_column"])
            .drop("_line", "_column"))
