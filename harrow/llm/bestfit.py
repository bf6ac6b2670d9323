"""Packing of documents into few sequences by bulk-synchronous best fit.

Documents longer than a sequence are cut into full ones, which need no packing, and a rest.
Everything else is packed in rounds.  Each sorts documents and the gaps of open sequences
together by size, over ranges.  A sweep through a range, from the largest size down, gives
every document the smallest gap that is still free and large enough, its successor; where
several want the same gap, the one that ranks first, the larger, gets it.  Gaps that no
document of their own range takes are passed down to the next ones: only the two counts left
in each range are needed for that.  A gap takes one document a round, shrinks, and takes part
in the next one.

Before the first round as many sequences are opened as the documents would fill, and later as
many as those documents would fill that are larger than every gap.  The last rounds have few
rows, as they fill up the few sequences of many short documents.  Once no more than LAST_ROWS
are left, and a quarter of all at most, one task goes through these rounds by itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.byte_tokens import byte_tokenizer
from harrow.session import materialize

CAPACITY = 2048      # tokens of a sequence
END = 0              # the id after every document
BUNDLES = 32         # documents shorter than so many to a sequence go as bundles of that size
RANGE_ROWS = 1 << 16 # documents and gaps that one task sweeps, about
LAST_ROWS = 1 << 14  # rows, at most, whose rounds one task ends by itself

_Batches = Iterator[pa.RecordBatch]
_OPEN = "item long, size long, sequence long, gap long"


def _pieces(path: str, capacity: int, end: int) -> Callable[[_Batches], _Batches]:
    """Batches of (doc_id, text) to pieces and the items that they belong to.

    Short pieces of a batch share an item, a bundle; ``inner`` is a piece's place in it and
    ``size`` stands with its first piece.  A full piece has no item.
    """
    small = capacity // BUNDLES

    def run(batches: _Batches) -> _Batches:
        encode, last = byte_tokenizer(path).encode, end.to_bytes(4, "little")
        item = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, sizes = [], {}
            bundle, filled = -1, small
            for place, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + last
                first = len(ids) // 4 % capacity or capacity
                cuts = [0, *range(4 * first, len(ids) + 1, 4 * capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    n, inner, own = (b - a) // 4, 0, None
                    if n < capacity:
                        if n >= small or filled + n > small or bundle < 0:
                            item, own = item + 1, item
                            sizes[own] = 0
                            if n < small:
                                bundle, filled = own, 0
                        else:
                            own, inner = bundle, filled
                        filled += n if n < small else 0
                        sizes[own] += n
                    rows.append((place, piece, a // 4, n, zlib.crc32(ids[a:b]), own, inner))
            columns = list(zip(*rows)) or [[]] * 7
            known = [sizes[own] if own is not None and not inner else None
                     for *_, own, inner in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(columns[0], pa.int64())),
                 pa.array(columns[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in (*columns[2:], known))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "item", "inner", "size"])

    return run


def sweep(sizes: np.ndarray, is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents, their gaps, gaps left) as indexes into sizes sorted from the largest down.

    A gap stands before the documents of its size.  The gaps passed lie on a stack, so the
    smallest is on top; a document that finds none stays without.
    """
    stack: list[int] = []
    taken, gaps = [], []
    for i, gap in enumerate(is_gap.tolist()):
        if gap:
            stack.append(i)
        elif stack:
            taken.append(i)
            gaps.append(stack.pop())
    return (np.array(x, np.int64) for x in (taken, gaps, stack))


def _sweep_range(batches: _Batches) -> _Batches:
    """One range of documents (item, size) and gaps (sequence, gap), matched as far as it goes.

    A row that stays alone gets its ``place`` among the documents or gaps left in the range.
    """
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    item, size, sequence, gap = table.columns
    is_gap = sequence.is_valid().to_numpy()
    sizes = np.where(is_gap, gap.fill_null(0).to_numpy(), size.fill_null(0).to_numpy())
    names = np.where(is_gap, sequence.fill_null(0).to_numpy(), item.fill_null(0).to_numpy())
    order = np.lexsort((names, ~is_gap, -sizes))
    documents, gaps, free = sweep(sizes[order], is_gap[order])
    alone = np.ones(len(order), bool)
    alone[documents] = alone[gaps] = alone[free] = False
    waiting = np.flatnonzero(alone)

    def rows(documents: np.ndarray | None, gaps: np.ndarray | None, n: int, placed: bool) -> list:
        some = pa.nulls(n, pa.int64())
        left = [some, some] if documents is None else [
            pa.array(x[order[documents]]) for x in (names, sizes)]
        right = [some, some] if gaps is None else [pa.array(x[order[gaps]]) for x in (names, sizes)]
        return [*left, *right, pa.array([TaskContext.get().partitionId()] * n, pa.int64()),
                some if placed else pa.array(np.arange(n))]

    for kind in ((documents, gaps, len(gaps), True), (waiting, None, len(waiting), False),
                 (None, free, len(free), False)):
        yield pa.RecordBatch.from_arrays(rows(*kind), names=[
            "item", "size", "sequence", "gap", "range", "place"])


def carry(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(range, first, n, range of the gaps, first gap) for documents served from above.

    ``counts`` has (range, documents left, gaps left) in order of falling size.  The n
    documents from place ``first`` take the gaps from place ``first gap`` downwards, which
    are the smallest that the ranges above have left.
    """
    stack: list[list[int]] = []
    served = []
    for own, documents, gaps in counts:
        first = 0
        while documents and stack:
            above, left = stack[-1]
            n = min(documents, left)
            served.append((own, first, n, above, left - 1))
            first, documents, stack[-1][1] = first + n, documents - n, left - n
            if left == n:
                stack.pop()
        if gaps:
            stack.append([own, gaps])
    return served


def _round(waiting: DataFrame, rows: int) -> DataFrame:
    """``waiting`` with documents put into gaps; a row without either side stays for later."""
    spark = waiting.sparkSession
    ranges = max(1, -(-rows // RANGE_ROWS))
    swept = materialize(waiting.repartitionByRange(
        ranges, F.coalesce("gap", "size").desc(), F.col("sequence").isNull(),
        F.coalesce("sequence", "item")).mapInArrow(_sweep_range, f"{_OPEN}, range long, place long"),
        "swept")
    left = swept.filter(F.col("place").isNotNull()).groupBy("range").agg(
        F.count("item"), F.count("sequence")).collect()
    served = carry(sorted(tuple(r) for r in left))
    columns = ["item", "size", "sequence", "gap"]
    if not served:
        return swept.select(*columns)
    # At most two rows for each range are broadcast.
    told = F.broadcast(spark.createDataFrame(
        served, "range long, first long, n long, above long, top long"))
    alone = swept.filter(F.col("place").isNotNull())
    documents = alone.filter(F.col("item").isNotNull()).alias("d").join(told.alias("t"), (
        F.col("d.range") == F.col("t.range")) & (F.col("place") >= F.col("first")) & (
        F.col("place") < F.col("first") + F.col("n")), "left")
    documents = documents.select("item", "size", F.col("above").alias("range"), (
        F.col("top") - F.col("place") + F.col("first")).alias("place"))
    gaps = alone.filter(F.col("sequence").isNotNull()).select("sequence", "gap", "range", "place")
    met = gaps.join(documents.filter(F.col("range").isNotNull()), ["range", "place"], "left")
    unserved = documents.filter(F.col("range").isNull()).select(
        "item", "size", *(F.lit(None).cast("long").alias(c) for c in columns[2:]))
    placed = swept.filter(F.col("place").isNull()).select(*columns)
    return materialize(met.select(*columns).unionByName(unserved).unionByName(placed), "met")


def _last_rounds(opened: int, capacity: int) -> Callable[[_Batches], _Batches]:
    """All rows (item, size, sequence, gap) to the places of their documents, round by round.

    The rounds are those of ``best_fit``: ``opened`` is the number of the next sequence.
    """
    def run(batches: _Batches) -> _Batches:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        item, size, sequence, gap = (table.column(i) for i in range(4))
        items, sizes = (c.filter(item.is_valid()).to_numpy() for c in (item, size))
        sequences, gaps = (c.filter(sequence.is_valid()).to_numpy() for c in (sequence, gap))
        number = opened
        while len(items):
            large = sizes[sizes > gaps.max(initial=0)]
            fresh = -(-int(large.sum()) // capacity)
            wide = gaps >= sizes.min()
            sequences = np.concatenate([sequences[wide], np.arange(number, number + fresh)])
            gaps = np.concatenate([gaps[wide], np.full(fresh, capacity, np.int64)])
            number += fresh
            # Indexes below len(items) are documents, those from there on gaps.
            is_gap = np.arange(len(items) + len(gaps)) >= len(items)
            both = np.concatenate([sizes, gaps])
            order = np.lexsort((np.concatenate([items, sequences]), ~is_gap, -both))
            taken, served, _ = sweep(both[order], is_gap[order])
            taken, served = order[taken], order[served] - len(items)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items[taken]), pa.array(sequences[served]), pa.array(capacity - gaps[served])],
                names=["item", "sequence", "offset"])
            gaps[served] -= sizes[taken]
            waiting = np.ones(len(items), bool)
            waiting[taken] = False
            items, sizes = items[waiting], sizes[waiting]

    return run


def best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """(item, sequence, offset) of all ``items`` (item, size), sizes 1 to ``capacity``."""
    spark = items.sparkSession
    none = F.lit(None).cast("long")
    waiting = items.select("item", "size", none.alias("sequence"), none.alias("gap"))
    opened, placed, most = 0, [], 0
    while True:
        # At most a row per size: what is left, and what it needs.
        sizes = {r[0]: (r[1], r[2]) for r in waiting.groupBy(
            F.coalesce("gap", "size").alias("of")).agg(F.count("item"), F.count("sequence")).collect()}
        documents = {s: d for s, (d, _) in sizes.items() if d}
        if not documents:
            break
        largest = max((s for s, (_, g) in sizes.items() if g), default=0)
        needed = -(-sum(s * d for s, d in documents.items() if s > largest) // capacity)
        smallest = min(documents)
        left = sum(d + g for d, g in sizes.values())
        most = max(most, left)
        if left <= min(LAST_ROWS, most // 4):
            placed.append(waiting.repartition(1).mapInArrow(
                _last_rounds(opened, capacity), "item long, sequence long, offset long"))
            break
        waiting = waiting.filter(F.col("sequence").isNull() | (F.col("gap") >= smallest))
        rows = needed + sum(d + (g if s >= smallest else 0) for s, (d, g) in sizes.items())
        if needed:
            fresh = spark.range(opened, opened + needed).select(
                none.alias("item"), none.alias("size"), F.col("id").alias("sequence"),
                F.lit(capacity).cast("long").alias("gap"))
            waiting = waiting.unionByName(fresh)
            opened += needed
        met = _round(waiting, rows)
        both = F.col("item").isNotNull() & F.col("sequence").isNotNull()
        placed.append(met.filter(both).select("item", "sequence",
                                              (capacity - F.col("gap")).alias("offset")))
        waiting = met.select(
            F.when(~both, F.col("item")).alias("item"), F.when(~both, F.col("size")).alias("size"),
            "sequence", (F.col("gap") - F.when(both, F.col("size")).otherwise(0)).alias("gap")
        ).filter("item is not null or gap > 0")
    if not placed:
        return spark.createDataFrame([], "item long, sequence long, offset long")
    return reduce(DataFrame.unionByName, placed)


def pack_best_fit(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                  end: int = END) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their place in one of few sequences.

    Gives doc_id, piece (from 0), start (ids of the document before the piece), length,
    ids_crc32, sequence_id and offset.  A document's ids are its text's, then ``end``; a null
    or empty text has only that one.  Documents of at most ``capacity`` ids are never cut,
    longer ones into pieces of that many, the first of which may be shorter.  Every row is a
    document of its own, so ids may be null or repeated; other columns are left alone.  An
    empty table gives no rows.  ``path`` is the file of the public tokenizer.
    """
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialize(docs.mapInArrow(_pieces(path, capacity, end), (
        "doc_id long, piece int, start long, length long, ids_crc32 long, item long, inner long, "
        "size long")), "pieces")
    items = pieces.filter(F.col("size").isNotNull()).select("item", "size")
    placed = best_fit(items, capacity)
    shown = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # Full pieces have sequences of their own, numbered from -1 downwards.
    full = pieces.filter(F.col("item").isNull()).select(
        *shown, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest = pieces.join(placed, "item").select(
        *shown, F.col("sequence").alias("sequence_id"),
        (F.col("offset") + F.col("inner")).alias("offset"))
    return rest.unionByName(full)


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into few sequences of at most 2048 tokens."""
    return pack_best_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op11_best_fit": op11_best_fit}
ORACLE = {}
