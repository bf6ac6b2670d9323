"""Splits and samples fixed by a seed and the data, not by the layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.functions.hashing import stable_hash, unit_interval
from harrow.session import materialize

GROUP_ROWS = 100_000   # rows per hash group
BLOCK_GROUPS = 1_000   # groups whose starts are summed together
RUN_ROWS = 10_000      # copies of one row kept together
STRETCH_ROWS = 1_000   # positions a draw has to look through


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float],
               seed: int = 0, name: str = "split") -> DataFrame:
    """Add a split number: 0 with the share of the first weight, and so on.

    Depends on the seed and the keys only, so it needs no shuffle, and rows with
    equal keys stay together.
    """
    total = float(sum(weights))
    point = unit_interval(seed, *keys)
    split = F.lit(len(weights) - 1)
    upper = total
    for i in range(len(weights) - 1, 0, -1):
        upper -= weights[i]
        split = F.when(point < upper / total, i - 1).otherwise(split)
    return df.withColumn(name, split)


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """Spark's own random split; the outcome changes with the partitioning."""
    return df.randomSplit([float(w) for w in weights], seed)


def sample_with_replacement(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows drawn evenly with replacement, numbered by ``draw``.

    Rows are dealt into hash groups, equal rows into the same one, and the groups laid
    end to end; each draw is a position on that line.  Only the groups' sizes are needed
    to find the groups that draws fall into, and only these groups' rows are counted and
    sorted.  The outcome depends on the seed and the rows only, so a task that is run
    again repeats it.
    """
    columns = df.columns
    n_rows = df.count()
    size, n_groups = F.lit(n_rows or None).cast("bigint"), max(1, -(-n_rows // GROUP_ROWS))
    rows = df.withColumn("_group", stable_hash(0, *columns, F.lit(0)) % F.lit(n_groups).cast("bigint"))

    # Where each group starts: sums within blocks of groups, then over the few blocks.
    sizes = rows.groupBy("_group").agg(F.count("*").alias("_n")).withColumn(
        "_block", F.floor(F.col("_group") / BLOCK_GROUPS))
    blocks = sizes.groupBy("_block").agg(F.sum("_n").alias("_n")).select(
        "_block", _sum_before("_n", Window.orderBy("_block")).alias("_before"))
    starts = sizes.withColumn("_first", _sum_before(
        "_n", Window.partitionBy("_block").orderBy("_group"))).join(blocks, "_block").select(
        "_group", (F.col("_before") + F.col("_first")).alias("_start"),
        (F.col("_before") + F.col("_first") + F.col("_n")).alias("_end"))
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"), (stable_hash(seed, "id") % size).alias("_position"))
    drawn = materialize(_meet(starts, draws, GROUP_ROWS).select(
        "draw", "_group", (F.col("_position") - F.col("_start")).alias("_position")), "drawn")

    # Copies are counted and cut into runs, so a row with many copies is no hot spot.
    counted = (rows.join(drawn.select("_group").distinct(), "_group", "left_semi")
               .groupBy("_group", *columns).agg(F.count("*").alias("_n")))
    order = Window.partitionBy("_group").orderBy(*columns)
    runs = (counted.withColumn("_before", _sum_before("_n", order))
            .withColumn("_run", F.explode(F.sequence(
                F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / RUN_ROWS))))
            .withColumn("_start", F.col("_before") + F.col("_run") * RUN_ROWS)
            .withColumn("_end", F.least(F.col("_start") + RUN_ROWS, F.col("_before") + F.col("_n"))))
    return _meet(runs, drawn, STRETCH_ROWS, "_group").select("draw", *columns)


def _meet(spans: DataFrame, points: DataFrame, stretch: int, *keys: str) -> DataFrame:
    """Each point (_position) with the span (_start to _end) it falls into, by stretches."""
    cut = spans.withColumn("_stretch", F.explode(F.sequence(
        F.floor(F.col("_start") / stretch), F.floor((F.col("_end") - 1) / stretch))))
    placed = points.withColumn("_stretch", F.floor(F.col("_position") / stretch))
    return cut.join(placed, [*keys, "_stretch"]).filter(
        (F.col("_start") <= F.col("_position")) & (F.col("_position") < F.col("_end")))


def _sum_before(column: str, window) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))
