"""Benchmark decontamination by a distributed positional inverted index.

The index is split by documents: each shard of a few megabytes of text stores, for every
test term, the positions where it stands.  A window of test words is found by
intersecting the lists of its terms, each moved back by the term's offset, from the
rarest term of the corpus on.  What is left are exact phrases; allowing the lists some
slack gives proximity matches.  No list of a term is ever gathered over all shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.batches import Hashes, chunks, folded_symbols, words
from harrow.session import materialize

WINDOW = 13                  # words of a window
SHARD_BYTES = 2 << 20        # text per shard, unless one document is longer
BENCHMARK_BYTES = 32 << 20   # benchmark text searched for in one pass over the index
NEAR_TERMS = 5               # rarest terms of a window that a proximity match needs
SLACK = 4                    # words that each of them may be off its place
SHARE = 20                   # a document is contaminated if a SHARE-th of its words is hit

# Letters A-Z count as a-z; all ASCII characters but letters and digits separate words.
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def text_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit term of every word, text of every word), in order."""
    starts, ends, texts = words(_SEPARATOR, data, offsets)
    return Hashes(data, folded_symbols())(starts, ends), texts


@dataclass
class Windows:
    """Distinct windows of a benchmark: term numbers, and the items that hold them."""

    terms: np.ndarray             # sorted 64-bit terms of the benchmark
    windows: list[np.ndarray]     # numbers into ``terms``
    items: list[list[str | None]]


def benchmark_windows(items: list[tuple[str | None, str]], window: int = WINDOW) -> Windows:
    """Every run of ``window`` words of the (id, text) items; a shorter item is one run."""
    listed, found = [], {}
    for _, data, offsets in chunks(pa.array([text for _, text in items], pa.large_string()), 1 << 40):
        listed, texts = text_terms(data, offsets)
        cuts = np.searchsorted(texts, np.arange(len(items) + 1))
    if not len(listed):
        return Windows(np.zeros(0, np.uint64), [], [])
    terms, numbers = np.unique(listed, return_inverse=True)
    for (item, _), a, b in zip(items, cuts[:-1], cuts[1:], strict=True):
        for start in range(a, max(b - window, a) + 1) if b > a else ():
            found.setdefault(tuple(numbers[start:min(start + window, b)]), {})[item] = None
    return Windows(terms, [np.array(w) for w in found], [list(x) for x in found.values()])


_POSTINGS = "shard long, term int, positions array<int>, rows array<long>, ids array<long>"


def _index(terms: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (_row, id, text) to postings; term -1 holds the words of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in chunks(batch.column(2), SHARD_BYTES):
                n = len(offsets) - 1
                found, texts = text_terms(data, offsets)
                place = np.minimum(np.searchsorted(terms, found), max(len(terms) - 1, 0))
                known = (np.flatnonzero(terms[place] == found) if len(terms)
                         else np.zeros(0, np.int64))
                number = place[known]
                order = np.argsort(number, kind="stable")
                used, begins = np.unique(number[order], return_index=True)
                lists = pa.ListArray.from_arrays(
                    pa.array([0, n, *(begins[1:] + n), n + len(known)] if len(used) else [0, n],
                             pa.int32()),
                    pa.array(np.concatenate([np.bincount(texts, minlength=n), known[order]]),
                             pa.int32()))
                rows, ids = batch.column(0).slice(first, n), batch.column(1).slice(first, n)
                size = len(used) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(size, rows[0].as_py()), pa.int64()),
                    pa.array(np.concatenate([[-1], used]), pa.int32()), lists,
                    pa.array([rows.to_pylist()] + [None] * (size - 1), pa.list_(pa.int64())),
                    pa.array([ids.to_pylist()] + [None] * (size - 1), pa.list_(pa.int64()))],
                    names=["shard", "term", "positions", "rows", "ids"])

    return run


_FOUND = ("row long, id long, n_words long, n_hit long, items array<string>, unnamed boolean, "
          "spans array<struct<start: int, length: int>>, near array<string>")


def _search(windows: Windows, counts: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """A search of one shard's postings for all windows, rarest terms first."""
    orders = [np.lexsort((w, counts[w])) for w in windows.windows]
    by_rarest: dict[int, list[int]] = {}
    for i, (window, order) in enumerate(zip(windows.windows, orders, strict=True)):
        by_rarest.setdefault(int(window[order[0]]), []).append(i)

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.combine_chunks()
        terms = shard.column("term").to_numpy()
        positions = shard.column("positions").combine_chunks()
        if isinstance(positions, pa.ChunkedArray):
            positions = positions.chunk(0)
        values = positions.values.to_numpy(zero_copy_only=False)
        cuts = positions.offsets.to_numpy()
        lists = {int(t): values[a:b] for t, a, b in zip(terms, cuts[:-1], cuts[1:], strict=True)}
        head = int(np.flatnonzero(terms == -1)[0])
        rows, ids = (shard.column(c)[head].values for c in ("rows", "ids"))
        n_words = lists.pop(-1).astype(np.int64)
        ends = np.cumsum(n_words)
        total = int(ends[-1]) if len(ends) else 0
        change = np.zeros(total + 1, np.int64)
        exact: list[set] = [set() for _ in n_words]
        near: list[set] = [set() for _ in n_words]
        for term in lists.keys() & by_rarest.keys():
            for i in by_rarest[term]:
                window, order = windows.windows[i], orders[i]
                lead = order[0]
                starts = lists[term].astype(np.int64) - lead
                text = np.searchsorted(ends, starts + lead, "right")
                close = starts
                inside = (starts >= ends[text] - n_words[text]) & (starts + len(window) <= ends[text])
                starts = starts[inside]
                for step, k in enumerate(order[1:], 1):
                    if not (len(starts) or (step < NEAR_TERMS and len(close))):
                        break
                    other = lists.get(int(window[k]))
                    if other is None:
                        starts = starts[:0]
                        if step < NEAR_TERMS:
                            close = starts
                        break
                    if len(starts):
                        at = np.minimum(np.searchsorted(other, starts + k), len(other) - 1)
                        starts = starts[other[at] == starts + k]
                    if step < NEAR_TERMS and len(close):
                        text = np.searchsorted(ends, close + lead, "right")
                        low = np.maximum(close + k - SLACK, ends[text] - n_words[text])
                        high = np.minimum(close + k + SLACK, ends[text] - 1)
                        close = close[np.searchsorted(other, low)
                                      < np.searchsorted(other, high, "right")]
                np.add.at(change, starts, 1)
                np.add.at(change, starts + len(window), -1)
                for kept, found in ((exact, starts + lead), (near, close + lead)):
                    for t in np.unique(np.searchsorted(ends, found, "right")):
                        kept[t].update(windows.items[i])
        hit = np.cumsum(change[:-1]) > 0
        sums = np.concatenate([[0], np.cumsum(hit)])
        first = ends - n_words
        fresh = hit.copy()
        fresh[1:] &= ~hit[:-1]
        edge = first[(n_words > 0)]
        fresh[edge] = hit[edge]
        run_starts = np.flatnonzero(fresh)
        over = hit.copy()
        over[:-1] &= ~hit[1:]
        last = ends[(n_words > 0)] - 1
        over[last] = hit[last]
        run_ends = np.flatnonzero(over) + 1
        spans: list[list] = [[] for _ in n_words]
        for a, b, t in zip(run_starts, run_ends, np.searchsorted(ends, run_starts, "right"),
                           strict=True):
            spans[t].append({"start": int(a - first[t]), "length": int(b - a)})
        return pa.Table.from_arrays([
            rows, ids, pa.array(n_words, pa.int64()), pa.array(sums[ends] - sums[first], pa.int64()),
            pa.array([sorted(x - {None}) for x in exact], pa.list_(pa.string())),
            pa.array([None in x for x in exact], pa.bool_()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
            pa.array([sorted(n - x - {None}) for n, x in zip(near, exact, strict=True)],
                     pa.list_(pa.string()))],
            names=["row", "id", "n_words", "n_hit", "items", "unnamed", "spans", "near"])

    return run


def _merge(spans: pa.Array) -> pa.Array:
    """Unions of word spans, per row."""
    merged = []
    for own in spans.to_pylist():
        out: list[dict] = []
        for span in sorted(own, key=lambda s: s["start"]):
            if out and span["start"] <= out[-1]["start"] + out[-1]["length"]:
                end = max(span["start"] + span["length"], out[-1]["start"] + out[-1]["length"])
                out[-1]["length"] = end - out[-1]["start"]
            else:
                out.append(dict(span))
        merged.append(out)
    return pa.array(merged, spans.type)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BENCHMARK_BYTES) -> DataFrame:
    """(id, n_words, n_hit, items, unnamed, spans, near, contaminated) of every row of ``docs``.

    ``docs`` has (id long, text), ``benchmark`` (item_id, text).  ``items`` are the ids, as
    sorted strings, of items with a window in the text; ``spans`` the runs of words inside
    such windows and ``n_hit`` their words; ``near`` are further items of which only the
    NEAR_TERMS rarest terms of a window are found, each within SLACK words of its place.
    ``contaminated`` says that n_hit > 0 and SHARE * n_hit >= n_words.

    A null or empty text has no words, and an item without words no window.  Ids may be
    null or repeated; every row is searched by itself.  An item whose id is null counts in
    ``n_hit``, ``spans`` and ``contaminated``, is in neither list, and ``unnamed`` says
    whether such an item has a window in the text.  A benchmark longer than
    ``block_bytes`` is searched for in several passes, so what is broadcast is bounded.
    """
    docs = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("id").cast("long").alias("id"), "text")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").dropna(subset=["text"])
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    if n_blocks > 1:
        docs = materialize(docs, "rows")
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    results = []
    for block in range(n_blocks):
        asked = items.filter(block_of == block).select("item_id", "text").collect()
        windows = benchmark_windows([tuple(r) for r in asked], window)
        postings = materialize(docs.mapInArrow(_index(windows.terms), _POSTINGS), "postings")
        counts = np.zeros(max(len(windows.terms), 1), np.int64)
        for term, n in (postings.filter("term >= 0").groupBy("term")
                        .agg(F.sum(F.size("positions"))).collect()):
            counts[term] = n
        results.append(postings.groupBy("shard").applyInArrow(_search(windows, counts), _FOUND))
    found = results[0]
    if n_blocks > 1:
        for more in results[1:]:
            found = found.unionByName(more)
        found = found.groupBy("row", "id").agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.bool_or("unnamed").alias("unnamed"),
            F.flatten(F.collect_list("spans")).alias("_spans"),
            F.array_distinct(F.flatten(F.collect_list("near"))).alias("_near"))
        merge = F.arrow_udf(_merge, "array<struct<start: int, length: int>>")
        found = found.withColumn("spans", merge("_spans")).select(
            "id", "n_words", F.aggregate("spans", F.lit(0).cast("long"),
                                         lambda n, s: n + s["length"]).alias("n_hit"),
            "items", "unnamed", "spans", F.array_sort(F.array_except("_near", "items")).alias("near"))
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))
    return found.select("id", "n_words", "n_hit", "items", "unnamed", "spans", "near",
                        bad.alias("contaminated"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands in the benchmark, and in which items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs.select(F.col("doc_id").alias("id"), "text"), benchmark)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit",
        (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_LISTED = r"""(SELECT {row} AS r, {id} AS id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM {table})"""
_RUNS = """(SELECT r, id, s, array_to_string(w[s:s + n - 1], ' ') AS words, n FROM
    (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM {listed}))"""
ORACLE_CONTAMINATION = f"""
WITH docs AS {_LISTED.format(row="row_number() OVER ()", id="doc_id", table="documents")},
items AS (SELECT *, least(len(w), {WINDOW}) AS n FROM
  {_LISTED.format(row="0", id="item_id", table="benchmark")} WHERE len(w) > 0),
asked AS (SELECT DISTINCT id AS item, words, n FROM {_RUNS.format(listed="items")}),
hits AS (SELECT r, s, found.n AS n, item FROM
  {_RUNS.format(listed="(SELECT r, id, w, n FROM docs, (SELECT DISTINCT n FROM items))")} found
  JOIN asked USING (words, n)),
covered AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM
  (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item::VARCHAR AS item FROM hits) GROUP BY r)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

QUERIES = {"op3_decontamination": op3_decontamination}
ORACLE = {"op3_decontamination": ORACLE_CONTAMINATION}
