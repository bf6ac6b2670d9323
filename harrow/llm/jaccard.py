"""N-gram Jaccard join by grouped prefixes.

Every text is the set of its word shingles.  Sets are ordered by one global order,
rarest shingles first, and two sets that are similar enough share a shingle within
their prefixes, which is a shorter one for the smaller set.  Equal sets are one node; nodes of equal size and prefix are one
group, and only groups meet on prefix shingles.  A meeting is filtered by size and
position, expanded to the members and verified on the whole sets.

Components need no list of all pairs of a dense group: each shingle's nodes are first
verified against one of them, and afterwards only pairs of nodes that are still in
different components are looked at.  No link between components can be missed, as
every pair that could have one is verified.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.batches import Hashes, chunks, folded_symbols, mix, small_batches, words
from harrow.llm.bits import bit_of, is_set, key_filter, packed_bits
from harrow.llm.components import components
from harrow.operators.skew import blocks, slot_of
from harrow.session import materialize, materialize_last

SHINGLE = 3               # words of a shingle
PERCENT = 90              # similarity from which two sets are linked
HOT_SHINGLES = 1 << 18    # commonest shingles whose counts set the order; broadcast
SKETCH = 64               # shingles of a set are counted in so many classes
MOST = 65_535             # count at which a class is full
CELL_ROWS = 2_000         # rows of one shingle that a task compares with as many others
SHINGLE_BITS = 1 << 27    # bits of the filter of shingles that stand twice; broadcast
BUCKET_BITS = 1 << 16     # bits of it that are put together at once
PLACES = 1 << 20          # shingles that a task sorts into buckets together
COUNTED = 4 << 20         # shingles that a task counts together, or one longer chunk of text
TEXT_BYTES = 1 << 19      # of texts cut into shingles at once, which take some 60 times that

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True


def shingle_sets(data: np.ndarray, offsets: np.ndarray,
                 size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, cuts): the sorted distinct 64-bit shingles of each text, one after another.

    A text with fewer words than ``size`` has its whole sequence as the only shingle.
    """
    starts, ends, texts = words(_SEPARATOR, data, offsets)
    word = Hashes(data, folded_symbols())(starts, ends)
    n = len(offsets) - 1
    edges = np.searchsorted(texts, np.arange(n + 1))
    rolled = word.copy()
    for i in range(1, size):
        rolled = mix(rolled[:-1] + np.uint64(0x9E3779B97F4A7C15)) + word[i:] if len(rolled) else rolled
    rolled = mix(rolled)
    sets, cuts = [], [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a >= size:
            own = np.unique(rolled[a:b - size + 1])
        elif b > a:
            # A number of its own for the length keeps short sequences apart.
            own = mix(word[a:a + 1] + np.uint64(b - a))
            for i in range(a + 1, b):
                own = mix(own + word[i:i + 1] * np.uint64(3))
        else:
            own = word[:0]
        sets.append(own)
        cuts.append(cuts[-1] + len(own))
    return np.concatenate([*sets, word[:0]]), np.array(cuts)


def _counted(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Shingles that several of the texts counted together hold, with the number of texts."""
    def several(found: np.ndarray) -> pa.RecordBatch:
        found.sort()
        # Only runs of equal shingles take room, as most stand alone.
        same = found[1:] == found[:-1]
        first = np.flatnonzero(same & ~np.concatenate([[False], same[:-1]])[:len(same)])
        last = np.flatnonzero(same & ~np.concatenate([same[1:], [False]])[:len(same)]) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(found[first].view(np.int64)), pa.array(last - first + 1)], names=["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = np.empty(COUNTED, np.uint64)  # filled and sorted in place, not put together anew
        held = 0
        for batch in batches:
            for _, data, offsets in chunks(batch.column(0), TEXT_BYTES):
                own = shingle_sets(data, offsets, size)[0]
                if held + len(own) > len(room):
                    yield several(room[:held])
                    held = 0
                if len(own) > len(room):
                    yield several(own)
                    continue
                room[held:held + len(own)] = own
                held += len(own)
        yield several(room[:held])

    return run


def _prefix_length(n: int, percent: int) -> int:
    """A linked set shares percent of the ``n`` shingles, so so many hold one that it has."""
    return n + (-n * percent // 100) + 1


def _short(n: str, percent: int) -> Column:
    """``_prefix_length`` where the linked set is no smaller and thus shares more of them."""
    n, whole = F.col(n), 100 + percent
    return n - F.floor((2 * percent * n + whole - 1) / whole) + 1


def _twice(bits: np.ndarray, chosen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]],
                                                             Iterator[pa.RecordBatch]]:
    """Batches of (row, n, prefix, bit of the row) to the postings of chosen rows.

    A posting is left out if the filter says that no other set has its shingle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(is_set(chosen, batch.column(3).to_numpy())))
            lists = batch.column(2)
            values = lists.flatten().to_numpy()
            lengths = np.diff(lists.offsets.to_numpy())
            place = np.repeat(np.arange(len(lengths)), lengths)
            i = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = is_set(bits, values.view(np.uint64) % np.uint64(8 * len(bits)))
            place = pa.array(place[kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(place), batch.column(1).take(place),
                 pa.array(i[kept].astype(np.int32)), pa.array(values[kept])],
                names=["node", "n", "i", "shingle"])

    return run


def _in_buckets(chosen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]],
                                                 Iterator[pa.RecordBatch]]:
    """Batches of (prefix, bit of the row) to (bucket, places): where in a bucket of the
    filter the shingles of chosen rows have their bits, in order and at most twice each."""
    def dealt(bits: np.ndarray) -> pa.RecordBatch:
        bits.sort()
        bits = bits[np.concatenate([np.ones(min(2, len(bits)), bool), bits[2:] != bits[:-2]])]
        cuts = np.searchsorted(bits, np.arange(0, SHINGLE_BITS + 1, BUCKET_BITS))
        places = (bits % np.uint32(BUCKET_BITS)).astype("<u2")
        used = np.flatnonzero(np.diff(cuts))
        offsets = (2 * np.append(cuts[used], len(bits))).astype(np.int32)
        lists = pa.Array.from_buffers(pa.binary(), len(used), [
            None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(places.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), lists], names=["bucket", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            batch = batch.filter(pa.array(is_set(chosen, batch.column(1).to_numpy())))
            values = batch.column(0).flatten().to_numpy()
            held.append((values % SHINGLE_BITS).astype(np.uint32))
            n += len(values)
            if n >= PLACES:
                yield dealt(np.concatenate(held))
                held, n = [], 0
        if n:
            yield dealt(np.concatenate(held))

    return run


def _met_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, places) sorted by bucket to the packed bits that stand at least twice."""
    bucket, once, twice = None, np.zeros(BUCKET_BITS, bool), np.zeros(BUCKET_BITS, bool)

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket]), pa.array([np.packbits(twice, bitorder="little").tobytes()])],
            names=["bucket", "bits"])

    for batch in batches:
        for own, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != bucket:
                if bucket is not None:
                    yield packed()
                bucket, once[:], twice[:] = own, False, False
            at = np.frombuffer(places, "<u2")
            twice[at[once[at]]] = True
            twice[at[1:][at[1:] == at[:-1]]] = True
            once[at] = True
    if bucket is not None:
        yield packed()


def _standing_twice(marked: DataFrame, chosen: np.ndarray) -> np.ndarray:
    """The packed bits of the shingles in ``marked`` (prefix, bit) that stand in two chosen rows.

    Shuffled are places of two bytes, not rows of one shingle each.
    """
    shared = marked.sparkSession.sparkContext.broadcast(chosen)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_buckets(shared.value)(batches)

    parts = (marked.select("prefix", "bit").mapInArrow(places, "bucket long, places binary")
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_met_twice, "bucket long, bits binary"))
    found = np.zeros((SHINGLE_BITS // BUCKET_BITS, BUCKET_BITS // 8), np.uint8)
    parts = parts.toArrow()  # of the filter's size, in one job and not in one for each task
    for bucket, bits in zip(*(column.to_pylist() for column in parts.columns), strict=True):
        found[bucket] = np.frombuffer(bits, np.uint8)
    return found.ravel()


def _prefixes(hot: np.ndarray, rank: np.ndarray, common: np.ndarray, percent: int,
              size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (row, id, text) to the size, fingerprint and ordered prefix of each set.

    ``hot`` shingles come last, by their ``rank``, and before them those that the filter
    ``common`` names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, prefixes, lengths, sketches = [], [], [], [0], []
            for _, data, offsets in chunks(batch.column(2), TEXT_BYTES):
                shingles, cuts = shingle_sets(data, offsets, size)
                order = is_set(common, shingles % np.uint64(8 * len(common))).astype(np.int32)
                seen = np.flatnonzero(order)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, shingles[seen]), len(hot) - 1)
                    order[seen] += np.where(hot[at] == shingles[seen], rank[at], 0)
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    own = shingles[a:b]
                    # The sum of mixed values does not depend on an order.
                    prints.append((int(mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)),
                                   int(mix(own + np.uint64(0x14057B7EF767814F)).sum().view(np.int64))))
                    sizes.append(b - a)
                    classes = np.bincount((own % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
                    sketches.append(_sketch(classes))
                    kept = _prefix_length(b - a, percent) if b > a else 0
                    hottest = order[a:b]
                    prefix = (own[np.argsort(hottest, kind="stable")[:kept]] if hottest.any()
                              else own[:kept])
                    prefixes.append(prefix)
                    lengths.append(lengths[-1] + len(prefix))
            lists = pa.ListArray.from_arrays(
                pa.array(lengths, pa.int32()),
                pa.array(np.concatenate([*prefixes, np.zeros(0, np.uint64)]).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array([p[0] for p in prints], pa.int64()),
                 pa.array([p[1] for p in prints], pa.int64()), lists,
                 pa.array(sketches, pa.binary())],
                names=["row", "id", "n", "print_a", "print_b", "prefix", "sketch"])

    return run


def _texts(bits: np.ndarray,
           again: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (row, text, bit) to the packed texts of the rows whose bit is set.

    ``again`` has the bits of rows that stand several times.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(is_set(bits, batch.column(2).to_numpy())))
            packed = [zlib.compress(b"" if x is None else x, 1)
                      for x in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()),
                 pa.array(is_set(again, batch.column(2).to_numpy()))], names=["row", "text", "again"])

    return run


def _linked(percent: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (a, b, text of a, text of b) to the pairs whose sets are similar enough."""
    def similar(texts: list[bytes], pairs: list[tuple[int, int]]) -> list[bool]:
        sets, keep = [], []
        for _, data, offsets in chunks(pa.array(texts, pa.large_binary()), TEXT_BYTES):
            shingles, cuts = shingle_sets(data, offsets, size)
            sets += [shingles[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for x, y in pairs:
            both = np.concatenate([sets[x], sets[y]])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= percent * (len(both) - common))
        return keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, texts, pairs, place, held = [], [], [], {}, 0
            for a, b, *both in zip(*(batch.column(i) for i in range(4)), strict=True):
                for row, text in zip((a.as_py(), b.as_py()), both, strict=True):
                    if row not in place:
                        place[row] = len(texts)
                        texts.append(zlib.decompress(text.as_buffer()))
                        held += len(texts[-1])
                pairs.append((place[a.as_py()], place[b.as_py()]))
                if held >= TEXT_BYTES:
                    keep += similar(texts, pairs)
                    texts, pairs, place, held = [], [], {}, 0
            keep += similar(texts, pairs)
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def _verified(docs: DataFrame, pairs: DataFrame, again: np.ndarray, percent: int,
              size: int) -> DataFrame:
    """The pairs (a, b) of rows whose whole sets are similar enough.

    Texts are shuffled, packed, and not their sets, which take three times as much.  Only
    those whose row passes a filter of fixed size are, and only rows that may stand several
    times, by the filter ``again``, are shuffled to leave one of each.
    """
    rows = pairs.select(F.explode(F.array("a", "b")).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast((key_filter(rows, "row"), again))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _texts(*shared.value)(batches)

    packed = materialize(docs.select("row", "text", bit_of("row").alias("bit")).mapInArrow(
        run, "row long, text binary, again boolean"), "texts")
    texts = packed.filter("not again").unionByName(packed.filter("again").dropDuplicates(["row"]))
    left = texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_linked(percent, size), "a long, b long")


def _sketch(classes: np.ndarray) -> bytes:
    """The counts in two bytes each: all lower ones, then all upper ones, which are mostly 0."""
    return np.minimum(classes, MOST).astype("<u2").view(np.uint8).reshape(SKETCH, 2).T.tobytes()


def _sketches(column: pa.Array) -> np.ndarray:
    counts = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 2, SKETCH)
    return counts[:, 0] + counts[:, 1].astype(np.uint16) * np.uint16(256)


def _can_link(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sets of two sketches can be linked: no class has more in common than
    the smaller of its two counts.  A count that is full may stand for more."""
    most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    sizes = x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64)
    full = (x == MOST).any(axis=1) | (y == MOST).any(axis=1)
    return full | ((100 + percent) * most >= percent * sizes)


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches can be linked."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = _can_link(_sketches(batch.column(2)), _sketches(batch.column(3)), percent)
            yield batch.filter(pa.array(good)).select([0, 1])

    left, right = (sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}"))
                   for c in ("a", "b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b")
            .mapInArrow(keep, "a long, b long"))


def _compare(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """Pairs of rows of the same cell that can be linked, by all that the rows tell."""
    keys, slot, root, node, n, i = (rows.column(k).to_numpy() for k in
                                    ("cell", "slot", "root", "node", "n", "i"))
    sketches = _sketches(rows.column("sketch").combine_chunks())
    whole = 100 + percent
    short = i < n - (2 * percent * n + whole - 1) // whole + 1
    one_slot = rows.column("line").to_numpy() == rows.column("column").to_numpy()
    found = []
    for step in range(1, len(keys)):
        x = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(x):
            break
        y = x + step
        small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
        most = np.minimum(i[x], i[y]) + np.minimum(n[x] - i[x], n[y] - i[y])
        good = ((root[x] != root[y]) & (100 * small >= percent * large)
                & (one_slot[x] | (slot[x] != slot[y]))
                & ((short[x] & (n[x] <= n[y])) | (short[y] & (n[y] <= n[x])))
                & (whole * most >= percent * (n[x] + n[y])))
        x, y = x[good], y[good]
        good = _can_link(sketches[x], sketches[y], percent)
        found.append(np.stack([node[x[good]], node[y[good]]]))
    pairs = np.sort(np.concatenate([*found, np.zeros((2, 0), np.int64)], axis=1), axis=0)
    pairs = np.unique(pairs, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _cells(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by cell to the likely pairs within cells; a cell may span batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            keys = rows.column("cell").to_numpy()
            last = int(np.searchsorted(keys == keys[-1], True)) if len(keys) else 0
            held = rows.slice(last)
            if last:
                yield _compare(rows.slice(0, last), percent)
        if held is not None:
            yield _compare(held, percent)

    return run


def similar_components(docs: DataFrame, percent: int = PERCENT,
                       size: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs`` (id long, text).

    Two rows are linked when 100 * intersection >= percent * union of their shingle sets;
    a component's id is the smallest of its rows' ids.  A null or wordless text has no
    shingles, is linked with nothing and has its own id.  Repeated rows are equal texts
    and so linked; null ids are ignored in the smallest id, and a component of null ids
    only has a null id.  ``percent`` lies in 1 to 100; a shingle has ``size`` words, 1 at
    least.
    """
    with small_batches(docs.sparkSession):
        return _components_of(docs, percent, size)


def _components_of(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """As ``similar_components``; all work on texts and sets is done when it returns."""
    spark = docs.sparkSession
    docs = docs.select(F.xxhash64("id", "text").alias("row"),
                       F.col("id").cast("long").alias("id"), "text")

    # The global order: shingles that no task counts twice, then the others, and of these
    # the commonest last, by rising count.
    counted = materialize(docs.select("text").mapInArrow(_counted(size), "shingle long, n long")
                          .groupBy("shingle").agg(F.sum("n").alias("n")), "counted")
    bit = F.pmod(F.col("shingle"), F.lit(SHINGLE_BITS)).cast("long")
    common = packed_bits(counted.select(bit.alias("bit")), SHINGLE_BITS)
    top = (counted.orderBy(F.desc("n"), "shingle").limit(HOT_SHINGLES).toArrow().combine_chunks())
    hot = top.column(0).to_numpy().view(np.uint64)
    rank = np.empty(len(hot), np.int32)
    rank[::-1] = np.arange(1, len(hot) + 1)
    order = np.argsort(hot)
    shared = spark.sparkContext.broadcast((hot[order], rank[order], common))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _prefixes(*shared.value, percent, size)(batches)

    rows = materialize(docs.mapInArrow(
        prefixes, "row long, id long, n long, print_a long, print_b long, prefix array<long>, sketch binary"),
        "prefixes")
    repeated = key_filter(rows.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1"), "row")
    key = ["print_a", "print_b", "n"]
    nodes = rows.filter("n > 0").groupBy(*key).agg(F.min("row").alias("node"),
                                                   F.min("id").alias("smallest"))
    nodes = materialize(nodes, "nodes")

    # The tables written on the way to the components are not needed after them.
    roots = materialize_last(lambda: _roots(docs, rows, nodes, repeated, percent, size), "roots")
    labelled = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    labelled = labelled.select(*key, "root").join(smallest, "root")
    found = rows.select("id", *key).join(labelled, key, "left")
    return found.select("id", F.col("n").alias("n_shingles"), F.when(
        F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _roots(docs: DataFrame, rows: DataFrame, nodes: DataFrame, repeated: np.ndarray, percent: int,
           size: int) -> DataFrame:
    """(node, root) of the nodes that are linked with others."""
    spark = docs.sparkSession
    # One row stands for equal sets.  It is picked by a filter of fixed size; a further
    # row that this lets through is one more node, equal to the first.
    chosen = spark.sparkContext.broadcast(key_filter(nodes, "node"))

    def standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(is_set(chosen.value, batch.column(3).to_numpy())))
            yield kept.select([0, 1, 2])

    marked = rows.filter("n > 0").select("row", "n", "prefix", bit_of("row").alias("bit"))
    head = F.struct(F.xxhash64("prefix").alias("x"), F.hash("prefix").alias("y"))
    own = (marked.select("row", "n", head.alias("head"), "bit")
           .mapInArrow(standing, "node long, n long, head struct<x: long, y: int>").distinct())

    # Groups: nodes of equal size and prefix; ``hub`` is the smallest node.
    hubs = own.groupBy("n", "head").agg(F.min("node").alias("hub"), F.count("*").alias("size"))
    members = materialize(own.join(hubs, ["n", "head"]).select("node", "n", "hub", "size"), "members")

    # Postings of the groups, without shingles of which a filter says that they stand once.
    maybe = spark.sparkContext.broadcast(_standing_twice(marked, chosen.value))

    def postings_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _twice(maybe.value, chosen.value)(batches)

    leads = members.filter("node = hub").select("hub", "size")
    # Joined first: what is dealt by hub need not be dealt again to be grouped.
    postings = (marked.mapInArrow(postings_of, "hub long, n long, i int, shingle long")
                .join(leads, "hub").groupBy("hub", "shingle")
                .agg(F.min("n").alias("n"), F.min("i").alias("i"), F.max("size").alias("size")))
    postings = materialize(postings, "listed")
    met = postings.groupBy("shingle").agg(F.sum("size").alias("texts")).filter("texts > 1")
    postings = materialize(postings.join(met.select("shingle"), "shingle")
                           .select("shingle", "hub", "n", "i"), "postings")

    # First round: everyone against one node of about its size, within group and shingle,
    # the one with most prefix shingles in common with others: a text that others
    # were made from has the fewest of its own.
    scale = F.floor(F.log(F.col("n").cast("double")) / -np.log(percent / 101.0)).alias("scale")
    weight = postings.groupBy("hub").agg(F.count("*").alias("weight"))
    spread = postings.filter(F.col("i") < _short("n", percent)).join(weight, "hub").select(
        "shingle", "hub", "n", "weight", scale)
    centres = spread.groupBy("shingle", "scale").agg(
        F.max_by("hub", F.struct("weight", "hub")).alias("a"))
    shared = (spread.join(centres, ["shingle", "scale"]).filter("hub <> a")
              .groupBy("a", F.col("hub").alias("b")).agg(F.count("*").alias("shared")))
    stars = shared.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a"))
    inside = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    sketches = rows.select(F.col("row").alias("node"), "sketch").join(
        own.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sketches = materialize(sketches, "sketches")
    asked = materialize(_likely(inside.unionByName(stars), sketches, percent), "stars")
    first = materialize(_verified(docs, asked, repeated, percent, size), "links")
    roots = components(first)

    # Second round: pairs of members in different components, on every shingle that the
    # smaller set has in its short prefix and the larger one in its prefix.  The rows of
    # a shingle are compared in cells of a grid, and only likely pairs leave a cell.
    placed = (members.join(roots, "node", "left")
              .select("node", "hub", F.coalesce("root", "node").alias("root")))
    spread = postings.join(placed, "hub").select("shingle", "node", "n", "i", "root")
    split = (spread.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"),
                                           F.count("*").alias("rows"),
                                           F.bool_or(F.col("i") < _short("n", percent)).alias("some"))
             .filter("x <> y and some").select("shingle", "rows"))
    slots = blocks("rows", CELL_ROWS)
    cells = F.transform(F.sequence(F.lit(0), slots - 1), lambda t: F.struct(
        F.least("slot", t).alias("line"), F.greatest("slot", t).alias("column")))
    spread = (spread.join(split, "shingle").join(sketches, "node")
              .withColumn("slot", slot_of(["node"], slots)).withColumn("at", F.explode(cells))
              .select(F.xxhash64("shingle", "at").alias("cell"), "slot", "at.line", "at.column",
                      "node", "root", "n", "i", "sketch"))
    pairs = (spread.repartition("cell").sortWithinPartitions("cell")
             .mapInArrow(_cells(percent), "a long, b long").distinct())
    pairs = materialize(pairs, "pairs")
    links = materialize(first.unionByName(_verified(docs, pairs, repeated, percent, size)), "links")
    return components(links)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share nine tenths of their three-word shingles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = similar_components(docs.select(F.col("doc_id").alias("id"), "text"))
    return found.withColumnRenamed("id", "doc_id")


_ORACLE_SETS = r"""
WITH RECURSIVE docs AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
    THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM docs),
"""
ORACLE_COMPONENTS = _ORACLE_SETS + f"""
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS c
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= {PERCENT} * (n + m - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(v, r) AS (SELECT doc_id, doc_id FROM sets
  UNION SELECT ways.b, reached.r FROM reached JOIN ways ON ways.a = reached.v)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(r)::BIGINT AS component_id
FROM sets JOIN reached ON v = doc_id GROUP BY doc_id, len(s)
"""

QUERIES = {"op9_jaccard_join": op9_jaccard_join}
ORACLE = {"op9_jaccard_join": ORACLE_COMPONENTS}
