"""Exact top-k inner products by a uniform threshold in three phases.

The dimensions are dealt to NODES nodes, each scoring its own part of a vector.  Phase
one gathers the best entries of every node's list, scored in full; the k-th best of them
is a lower bound on the k-th best of all.  A vector that reaches the bound has at least
one node at or above bound / NODES, so phase two collects the entries that reach this
cutoff at some node, and phase three scores just these exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harrow.session import materialize

NODES = 4              # groups of dimensions
QUERY_BLOCK = 2_048    # queries that one pass over the vectors answers
VECTOR_BLOCK = 2_048   # vectors scored at a time inside a task
EXACT = 1 << 53        # below this, sums of products are exact as doubles


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, longer ones are cut at ``width``.

    Cutting is safe where the other factor has zeros from ``width`` on.
    """
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == lengths[0]).all():
        table = values.reshape(len(lengths), lengths[0])[:, :width]
        return np.pad(table, ((0, 0), (0, width - table.shape[1])))
    table = np.zeros((len(lengths), width), np.int64)
    ends = np.cumsum(lengths)
    for i, (end, length) in enumerate(zip(ends, lengths, strict=True)):
        own = values[end - length:end][:width]
        table[i, :len(own)] = own
    return table


def _number_type(a: np.ndarray, b: np.ndarray) -> type:
    """A type in which the inner products of rows of a and b are exact."""
    def largest(x: np.ndarray) -> int:
        return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0

    return np.float64 if largest(a) * largest(b) * max(a.shape[1], 1) < EXACT else object


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best entries of every row: highest score, then smallest id."""
    order = np.lexsort((ids, -scores, rows))
    sorted_rows = rows[order]
    first = np.searchsorted(sorted_rows, sorted_rows, "left")
    return order[np.arange(len(order)) - first < k]


def _scan(queries: np.ndarray, query_ids: np.ndarray, cutoffs: np.ndarray | None, k: int,
          nodes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pass over vectors: phase one without cutoffs, phases two and three with them."""
    parts = [p for p in np.array_split(np.arange(queries.shape[1]), nodes) if len(p)]

    def entries(numbers: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        kind = _number_type(queries, numbers)
        left, right = queries.astype(kind), numbers.astype(kind)
        own = query_ids[:, None] == ids[None, :]
        picked = np.zeros(own.shape, bool)
        for part in parts:
            scores = left[:, part] @ right[:, part].T
            if cutoffs is not None:
                picked |= scores * len(parts) >= cutoffs[:, None]
            else:
                scores[own] = -EXACT if kind is np.float64 else -(1 << 200)
                best = np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]
                np.put_along_axis(picked, best, True, axis=1)
        if not parts:
            picked[:] = True
        rows, columns = np.nonzero(picked & ~own)
        totals = np.empty(len(rows), kind)
        for at in range(0, len(rows), 1 << 18):
            step = slice(at, at + (1 << 18))
            totals[step] = (left[rows[step]] * right[columns[step]]).sum(axis=1)
        if kind is object and any(abs(int(x)) >= 1 << 63 for x in totals):
            raise OverflowError("an inner product leaves 64 bits")
        totals = totals.astype(np.int64)
        if cutoffs is not None:
            enough = totals >= cutoffs[rows]
            rows, columns, totals = rows[enough], columns[enough], totals[enough]
        best = _best(rows, totals, ids[columns], k)
        return rows[best], totals[best], ids[columns[best]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            for at in range(0, batch.num_rows, VECTOR_BLOCK):
                block = batch.slice(at, VECTOR_BLOCK)
                found = entries(_matrix(block.column(1), queries.shape[1]),
                                block.column(0).to_numpy())
                held = [np.concatenate(x) for x in zip(held, found, strict=True)]
                best = _best(*held, k)
                held = [x[best] for x in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in held], names=["query", "score", "id"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, nodes: int = NODES,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k vectors with the highest inner products.

    ``vectors`` has (id long, vector array<long>); rows with a null id, a null vector or
    a null component take no part.  Candidates are all rows whose id is not the query's;
    ties go to the smaller id.  A repeated row is a candidate each time, a repeated query
    is answered once.  A shorter vector counts as ending in zeros.  A query without
    candidates has no rows, one with fewer than k has them all.

    Queries are answered in blocks of about ``query_block``, each in two passes over the
    vectors; what is broadcast are one block's vectors and one cutoff for each.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("id").cast("long").alias("id"),
                             F.col("vector").cast("array<long>").alias("vector"))
    vectors = vectors.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()
                             & ~F.exists("vector", lambda x: x.isNull()))
    queries = vectors.filter(is_query).distinct()
    n_blocks = max(1, -(-queries.count() // query_block))
    block_of = F.pmod(F.xxhash64("id", "vector"), F.lit(n_blocks))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    results = []
    for block in range(n_blocks):
        asked = queries.filter(block_of == block).toArrow().combine_chunks()
        ids = asked.column(0).to_numpy()
        lists = asked.column(1).combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        width = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
        numbers = _matrix(lists, width)
        schema = "query long, score long, id long"
        local = vectors.mapInArrow(_scan(numbers, ids, None, k, nodes), schema)
        bounds = (local.withColumn("place", F.row_number().over(order))
                  .filter(F.col("place") == k).select("query", "score").toArrow())
        cutoffs = np.full(len(ids), -(1 << 63), np.float64)
        cutoffs[bounds.column(0).to_numpy()] = bounds.column(1).to_numpy()
        enough = vectors.mapInArrow(_scan(numbers, ids, cutoffs, k, nodes), schema)
        names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)],
                                      "query long, query_id long")
        found = (enough.withColumn("rank", F.row_number().over(order))
                 .filter(F.col("rank") <= k).join(F.broadcast(names), "query")
                 .select("query_id", "rank", "id", "score"))
        results.append(materialize(found, "top") if n_blocks > 1 else found)
    result = results[0]
    for more in results[1:]:
        result = result.unionByName(more)
    return result


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth, over all embeddings."""
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x) < float("inf")))
    vectors = raw.filter(F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(
            F.lit(256.0) * x.cast("double"))).alias("vector"))
    found = top_k(vectors, F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n
  FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 5
"""

QUERIES = {"op5_top_k": op5_top_k}
ORACLE = {"op5_top_k": ORACLE_TOP_K}
