"""Packing of documents into sequences as a cutting-stock problem.

A document is cut into full sequences and a rest.  The rests, by length class, are the
items of a cutting-stock problem: a linear program over patterns (how many items of
each class a sequence holds) is solved by column generation, in which a knapsack
dynamic program prices new patterns, until the prices prove it solved.  Whole numbers of
each pattern are kept, what is left is filled greedily, and the documents, ranked within
their class, take the patterns' places in order.  Only the histogram of classes reaches
the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harrow.llm.tokens import tokenizer
from harrow.session import materialize

CAPACITY = 4096   # tokens of a sequence
END = 2           # the id after every document
CLASS = 8         # tokens by which length classes differ, at most
GAP = 1e-4        # the program ends within this share of the bound that its prices prove
GAIN = 1e-7       # by which a pattern must be worth more than a sequence
REFINE = 200      # steps of the simplex method after which its inverse is refined
POOL = 40         # patterns remembered, times the number of classes


def knapsack(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, last size) for every space: the most valuable multiset of sizes that fits."""
    value = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for space in range(1, room + 1):
        value[space] = value[space - 1]
        fits = np.searchsorted(sizes, space, "right")
        if fits:
            worth = value[space - sizes[:fits]] + prices[:fits]
            k = int(worth.argmax())
            if worth[k] > value[space] + 1e-12:
                value[space], choice[space] = worth[k], k
    return value, choice


def _filled(sizes: np.ndarray, choice: np.ndarray, space: int) -> np.ndarray:
    pattern = np.zeros(len(sizes), np.int64)
    while space > 0:
        if choice[space] < 0:
            space -= 1
        else:
            pattern[choice[space]] += 1
            space -= sizes[choice[space]]
    return pattern


def best_pattern(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, by dynamic programming."""
    value, choice = knapsack(sizes, prices, room)
    return float(value[room]), _filled(sizes, choice, room)


def first_fit(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """(items of each size, copies): the largest first, as often as each pattern can be had."""
    left, plan = demand.astype(np.int64), []
    while left.any():
        pattern, space = np.zeros(len(sizes), np.int64), room
        for k in range(len(sizes) - 1, -1, -1):
            pattern[k] = min(left[k], space // sizes[k])
            space -= pattern[k] * sizes[k]
        used = pattern > 0
        copies = int((left[used] // pattern[used]).min())
        plan.append((pattern, copies))
        left = left - copies * pattern
    return plan


def solve_patterns(sizes: np.ndarray, demand: np.ndarray,
                   room: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(patterns, copies, bound): fractional numbers of patterns that cover the demand.

    The linear program starts from first-fit's patterns.  The revised simplex method brings
    in known patterns until none gains any more; then one run of the knapsack program on the
    prices gives, for every size, the most valuable pattern with it, and those that gain
    join the others.  It ends when no pattern gains, or when the total lies within GAP of
    ``bound``, the least number of sequences that the prices prove.
    """
    n = len(sizes)
    # Slightly uneven demands keep the steps of the simplex method from standing still.
    demand = demand + 1e-5 * np.random.default_rng(20240229).random(n)
    columns = np.diag(room // sizes).astype(float)
    costs = np.ones(n)
    inverse = np.diag(1.0 / np.diag(columns))
    pool = np.array([p for p, _ in first_fit(sizes, demand, room)], float).T.reshape(n, -1)
    bound, steps = 0.0, 0
    while True:
        amounts = inverse @ demand
        while True:  # the simplex method on the patterns known, and on surplus of a size
            prices = costs @ inverse
            gains = prices @ pool - 1
            entering, cost, gain = None, 1.0, GAIN
            if len(gains) and gains.max() > gain:
                entering, gain = pool[:, gains.argmax()], gains.max()
            if -prices.min() > gain:
                entering, cost = np.zeros(n), 0.0
                entering[prices.argmin()] = -1
            if entering is None:
                break
            change = inverse @ entering
            falling = change > 1e-7
            if not falling.any():
                break
            ratio = np.where(falling, amounts / np.where(falling, change, 1), np.inf)
            out = int(ratio.argmin())
            step = ratio[out]
            amounts = np.maximum(amounts - step * change, 0)
            amounts[out] = step
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
            columns[:, out], costs[out] = entering, cost
            steps += 1
            if steps % REFINE == 0:
                # One step of Newton's iteration squares the error that has come together.
                inverse = inverse @ (2 * np.eye(n) - columns @ inverse)
                amounts = np.maximum(inverse @ demand, 0)
        prices = np.maximum(prices, 0)
        value, choice = knapsack(sizes, prices, room)
        total = float(prices @ demand)
        bound = max(bound, total / max(1.0, float(value[room])))
        with_size = prices + value[room - sizes]
        good = np.flatnonzero(with_size > 1 + GAIN)
        if total <= (1 + GAP) * bound or not len(good):
            break
        known = {column.tobytes() for column in pool.T.astype(np.int64)}
        fresh = []
        for k in good:
            pattern = _filled(sizes, choice, room - sizes[k])
            pattern[k] += 1
            if pattern.tobytes() not in known:
                known.add(pattern.tobytes())
                fresh.append(pattern)
        if not fresh:  # what seems to gain is known, and gains by rounding alone
            break
        pool = np.column_stack([pool, np.array(fresh, float).T])
        if pool.shape[1] > POOL * n:  # patterns far from gaining are found again if need be
            pool = pool[:, np.argsort(-(prices @ pool), kind="stable")[:POOL * n // 2]]
    real = costs > 0
    return columns[:, real].T.astype(np.int64), amounts[real], bound


def plan_patterns(sizes: np.ndarray, demand: np.ndarray,
                  room: int) -> list[tuple[np.ndarray, int]]:
    """(items of each size, copies) of whole patterns that hold the demand.

    Whole copies of the program's patterns, then first fit for what is left; never more
    sequences than first fit alone.
    """
    if not len(sizes):
        return []
    left = demand.astype(np.int64)
    plan = []
    patterns, amounts, _ = solve_patterns(sizes, demand.astype(float), room)
    for pattern, copies in zip(patterns, np.floor(amounts + 1e-4).astype(np.int64), strict=True):
        used = pattern > 0
        copies = min(int(copies), int((left[used] // pattern[used]).min())) if used.any() else 0
        if copies:
            plan.append((pattern, copies))
            left = left - copies * pattern
    plan += first_fit(sizes, left, room)
    greedy = first_fit(sizes, demand, room)
    return min(plan, greedy, key=lambda p: sum(copies for _, copies in p))


def _pieces(path: str, capacity: int, end: int) -> Callable[[Iterator[pa.RecordBatch]],
                                                            Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, text) to the pieces that documents are cut into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last, size = tokenizer(path).encode, end.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            places, starts, lengths, sums, totals = [], [], [], [], []
            for place, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + last
                for at in range(0, len(ids), size):
                    piece = ids[at:at + size]
                    places.append(place)
                    starts.append(at // 4)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(ids) // 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places, pa.int64())),
                 *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def _places(sizes: np.ndarray, plan: list[tuple[np.ndarray, int]]) -> dict[int, np.ndarray]:
    """For each size, rows of (first rank, items per sequence, first sequence) in rank order."""
    places: dict[int, list] = {int(s): [] for s in sizes}
    used = np.zeros(len(sizes), np.int64)
    sequence = 0
    for pattern, copies in plan:
        for k in np.flatnonzero(pattern):
            places[int(sizes[k])].append((used[k], pattern[k], sequence))
            used[k] += pattern[k] * copies
        sequence += copies
    return {size: np.array(rows, np.int64) for size, rows in places.items()}


def _assign(places: dict[int, np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]],
                                                       Iterator[pa.RecordBatch]]:
    """Batches with class and rank (the last two columns) to ones with sequence and slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = (batch.column(i).to_numpy() for i in (-2, -1))
            sequence, slot = np.zeros((2, len(sizes)), np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                rows = places[int(size)]
                at = np.searchsorted(rows[:, 0], ranks[own], "right") - 1
                copy, slot[own] = np.divmod(ranks[own] - rows[at, 0], rows[at, 1])
                sequence[own] = rows[at, 2] + copy
            n = batch.num_columns - 2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], batch.column(n), pa.array(sequence), pa.array(slot)],
                names=[*batch.schema.names[:n], "size", "sequence_id", "slot"])

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         end: int = END) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their place in a sequence.

    Gives doc_id, start (ids of the document before the piece), length, ids_crc32,
    doc_tokens, sequence_id and offset.  A document's ids are its text's, then ``end``; a
    null or empty text has only that one.  Every row is a document of its own, so ids may
    be null or repeated.  No sequence holds more than ``capacity`` ids, and offsets leave
    no gap.  ``path`` is the file of the public tokenizer.
    """
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = materialize(docs.mapInArrow(_pieces(path, capacity, end), schema), "pieces")
    wide = max(d for d in range(1, CLASS + 1) if capacity % d == 0)
    size = F.ceil(F.col("length") / float(wide)).cast("long")
    histogram = sorted(pieces.groupBy(size.alias("size")).count().collect())
    sizes = np.array([r[0] for r in histogram], np.int64)
    demand = np.array([r[1] for r in histogram], np.int64)
    plan = plan_patterns(sizes, demand, capacity // wide)

    # Ranks within a class: a class is dealt into as many parts as keep both the parts
    # and their number small, and a part starts where the ones before it end.
    parts = max(1, int(np.ceil(np.sqrt(demand.sum()))))
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()),
                  F.lit(parts))
    dealt = materialize(pieces.withColumn("size", size).withColumn("part", part), "dealt")
    counts = dealt.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("size", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = (dealt.withColumn("place", F.row_number().over(own) - 1).join(starts, ["size", "part"])
              .select(*pieces.columns, "size", (F.col("first") + F.col("place")).alias("rank")))
    placed = ranked.mapInArrow(_assign(_places(sizes, plan)),
                               f"{schema}, size long, sequence_id long, slot long")
    within = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "slot")
    behind = F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(behind, F.lit(0))).select(
        *pieces.columns, "sequence_id", "offset")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op7_packing": op7_packing}
ORACLE = {}
