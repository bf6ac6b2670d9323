"""Removal of repeated strings by blockwise suffix sorting with a difference cover.

Suffixes are sampled at the positions of a difference cover: any two suffixes have some
shift, below the cover's period, at which both are sampled.  A string of LENGTH bytes
that stands twice therefore ties two samples, and samples without a tie rule out all
suffixes before them.  The ties are found first; only suffixes that they leave go on to
be sorted by their first LENGTH bytes.  Either sort works one suffix bucket at a time,
so that a task holds one bucket or one unit of text, whatever the size of the corpus.

Strings are compared by 64-bit fingerprints.  Only the equality of LENGTH bytes is
asked for, so the order of suffixes inside a bucket is that of their fingerprints.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.batches import Hashes
from harrow.llm.bits import bit_of, is_set, key_filter
from harrow.session import materialize, work_path

LENGTH = 200             # bytes of a string that may not stand twice
UNIT_BYTES = 4 << 20     # text that is worked on together, about
BUCKET_BYTES = 16 << 20  # corpus bytes for each suffix bucket

# Perfect difference covers, by period.  Every number is a difference of
# two entries modulo the period.
COVERS = {
    1: (0,),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
    133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
}


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """(period, cover) that leaves more than half of a string's bytes to its sample."""
    period = max(p for p in COVERS if 2 * p <= length or p == 1)
    return period, COVERS[period]


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed differences, byte by byte of all of them."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_sorted(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


@dataclass
class Unit:
    """The texts of a unit, end to end, and the fingerprints of any of their strings."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, packed: pa.ChunkedArray) -> Unit:
        unpack = zstandard.ZstdDecompressor().decompress
        texts = [unpack(x.as_py()) for x in packed]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        return cls(np.frombuffer(b"".join(texts), np.uint8), offsets)

    def __post_init__(self):
        sizes = np.diff(self.offsets)
        self.hashes = Hashes(self.data)
        self.place = np.arange(len(self.data)) - np.repeat(self.offsets[:-1], sizes)
        self.left = np.repeat(sizes, sizes) - self.place  # bytes up to the text's end

    def samples(self, length: int) -> np.ndarray:
        period, cover = cover_for(length)
        picked = np.zeros(period, bool)
        picked[list(cover)] = True
        return np.flatnonzero(picked[self.place % period] & (self.left > length - period))

    def keys(self, positions: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct sorted keys, key of each position, whether a key stands twice here)."""
        found = self.hashes(positions, positions + size) >> np.uint64(64 - bits)
        keys, inverse, n = np.unique(found, return_inverse=True, return_counts=True)
        return keys, inverse, n > 1


def bucket_edges(n_buckets: int, bits: int) -> np.ndarray:
    """The first key of every bucket and the end of the last but one, in order."""
    return np.array([-(-(i << bits) // n_buckets) for i in range(1, n_buckets)], np.uint64)


def _split(keys: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    for bucket in range(len(cuts) - 1):
        if cuts[bucket] < cuts[bucket + 1]:
            yield bucket, keys[cuts[bucket]:cuts[bucket + 1]]


def _sort_bucket(blocks: pa.Table) -> pa.Table:
    """Which keys of each unit stand in another unit as well, as bits in key order."""
    keys = [unpack_sorted(x.as_py()) for x in blocks.column("keys")]
    every = np.sort(np.concatenate(keys))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    bits = []
    for own in keys:
        place = np.minimum(np.searchsorted(shared, own), max(len(shared) - 1, 0))
        bits.append(np.packbits(shared[place] == own if len(shared) else np.zeros(len(own), bool))
                    .tobytes())
    return pa.table({"unit": blocks.column("unit"), "phase": blocks.column("phase"),
                     "bucket": blocks.column("bucket"), "n": pa.array(map(len, keys), pa.int32()),
                     "bits": pa.array(bits, pa.binary())})


_KEYS = "unit int, phase int, bucket int, keys binary"
_BITS = "unit int, phase int, bucket int, n int, bits binary"


def _emit(unit: int, phase: int, keys: np.ndarray, edges: np.ndarray) -> pa.Table:
    split = list(_split(keys, edges))
    n = len(split)
    return pa.table({
        "unit": pa.array([unit] * n, pa.int32()), "phase": pa.array([phase] * n, pa.int32()),
        "bucket": pa.array([b for b, _ in split], pa.int32()),
        "keys": pa.array([pack_sorted(own) for _, own in split], pa.binary())})


def _answer(replies: pa.Table, phase: int, n: int) -> np.ndarray:
    """The bits of all buckets of a phase, in key order."""
    rows = sorted((r["bucket"], r["n"], r["bits"]) for r in replies.to_pylist()
                  if r["phase"] == phase)
    parts = [np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)
             for _, size, bits in rows]
    found = np.concatenate([*parts, np.zeros(0, bool)])
    if len(found) != n:
        raise ValueError("a unit's keys and the answers to them differ")
    return found


def _suffixes(unit: Unit, length: int, bits: int, replies: pa.Table) -> np.ndarray:
    """Positions of the suffixes that the ties of the cover's samples leave."""
    period, _ = cover_for(length)
    positions = unit.samples(length)
    keys, inverse, twice = unit.keys(positions, length - period + 1, bits)
    tied = (twice | _answer(replies, 0, len(keys)))[inverse]
    marks = np.zeros(len(unit.data) + 1, np.int64)
    marks[positions[tied] + 1] = 1
    sums = np.cumsum(marks)
    starts = np.flatnonzero(unit.left >= length)
    return starts[sums[starts + period] > sums[starts]]


def _once(seen: set[int], batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows whose hash, the first column, is not among ``seen``; adds their hashes."""
    fresh = []
    for row in batch.column(0).to_pylist():
        fresh.append(row not in seen)
        seen.add(row)
    return batch.filter(pa.array(fresh, pa.bool_()))


def find_repeats(docs: DataFrame, length: int = LENGTH, unit_bytes: int = UNIT_BYTES,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept_sha256) of every row of ``docs`` (id long, text).

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in
    the same text or another, is removed; strings are judged on the input and never cross
    texts.  ``spans`` are the maximal removed runs as (start, end) in UTF-8 bytes, and
    ``kept_sha256`` is the digest of the bytes that stay.  A null or empty text has no
    bytes.  Rows are documents of their own even when repeated, so two equal texts of at
    least ``length`` bytes are removed whole; ids may be null.

    Equal texts take part once; which rows stand for them is broadcast as a filter of a
    fixed size, and a row that it lets through by chance changes nothing but the work.  Of
    rows that repeat id and text each task sends one on, and each unit keeps one.
    """
    spark = docs.sparkSession
    docs = docs.select(F.xxhash64("id", "text").alias("row"), F.col("id").cast("long").alias("id"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    prints = materialize(docs.select("row", "id", F.octet_length("text").cast("long").alias("n_bytes"),
                                     F.sha2("text", 256).alias("print")), "prints")
    copies = materialize(prints.groupBy("print").agg(F.count("*").alias("copies"),
                                                     F.min("row").alias("stands"),
                                                     F.max("n_bytes").alias("size")), "copies")
    long = copies.filter(F.col("size") >= length)
    total = long.agg(F.sum("size")).first()[0] or 0
    n_units = max(1, -(-total // unit_bytes))
    n_buckets = max(1, -(-total // bucket_bytes))
    # Bits of a sample's key: a false tie at every few thousandth sample at most.
    bits = min(64, max(32, int(total).bit_length() + 10))
    chosen = spark.sparkContext.broadcast(key_filter(long, "stands"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        seen: set[int] = set()
        for batch in batches:
            own = _once(seen, batch.filter(pa.array(is_set(chosen.value,
                                                           batch.column(2).to_numpy()))))
            texts = pa.array([pack(x.as_py()) for x in own.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([own.column(0), texts, own.column(3)],
                                             names=["row", "packed", "unit"])

    def keep_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            yield _once(seen, batch)

    unit = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_units)).cast("int")
    packed = (docs.filter(F.octet_length("text") >= length)
              .select("row", "text", bit_of("row").alias("bit"), unit.alias("unit"))
              .mapInArrow(choose, "row long, packed binary, unit int"))
    # Bucketed by unit, so that the texts are shuffled only here.
    name = f"harrow_texts_{uuid.uuid4().hex}"
    (packed.repartition(n_units, "unit").mapInArrow(keep_one, packed.schema).write.bucketBy(n_units, "unit").format("parquet")
     .option("path", work_path(spark, "texts")).saveAsTable(name))
    texts = spark.table(name)

    def first(group: pa.Table) -> pa.Table:
        own = Unit.of(group.column("packed"))
        period, _ = cover_for(length)
        keys, _, _ = own.keys(own.samples(length), length - period + 1, bits)
        return _emit(group.column("unit")[0].as_py(), 0, keys, bucket_edges(n_buckets, bits))

    def second(group: pa.Table, replies: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        if not group.num_rows:
            return _emit(0, 1, np.zeros(0, np.uint64), bucket_edges(1, 64))
        own = Unit.of(group.column("packed"))
        positions = _suffixes(own, length, bits, replies)
        keys, _, _ = own.keys(positions, length, 64)
        return _emit(group.column("unit")[0].as_py(), 1, keys, bucket_edges(n_buckets, 64))

    def third(group: pa.Table, replies: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        found: dict[str, list] = {"row": [], "spans": [], "kept_sha256": []}
        if group.num_rows:
            own = Unit.of(group.column("packed"))
            positions = _suffixes(own, length, bits, replies)
            keys, inverse, twice = own.keys(positions, length, 64)
            repeated = positions[(twice | _answer(replies, 1, len(keys)))[inverse]]
            change = np.zeros(len(own.data) + 1, np.int32)
            np.add.at(change, repeated, 1)
            np.add.at(change, repeated + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            rows = group.column("row")
            for i, (a, b) in enumerate(zip(own.offsets[:-1], own.offsets[1:], strict=True)):
                if gone[a:b].any():
                    edges = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0))
                    found["row"].append(rows[i].as_py())
                    found["spans"].append([{"start": int(s), "end": int(e)}
                                           for s, e in edges.reshape(-1, 2)])
                    found["kept_sha256"].append(
                        hashlib.sha256(own.data[a:b][~gone[a:b]].tobytes()).hexdigest())
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table({"row": pa.array(found["row"], pa.int64()),
                         "spans": pa.array(found["spans"], pa.list_(span)),
                         "kept_sha256": pa.array(found["kept_sha256"], pa.string())})

    ties = materialize(texts.groupBy("unit").applyInArrow(lambda g: first(g.sort_by("row")), _KEYS)
                       .groupBy("bucket").applyInArrow(_sort_bucket, _BITS), "ties")
    equal = (texts.groupBy("unit").cogroup(ties.groupBy("unit")).applyInArrow(second, _KEYS)
             .groupBy("bucket").applyInArrow(_sort_bucket, _BITS))
    replies = ties.unionByName(materialize(equal, "equal"))
    spans = "row long, spans array<struct<start: long, end: long>>, kept_sha256 string"
    removed = texts.groupBy("unit").cogroup(replies.groupBy("unit")).applyInArrow(third, spans)

    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    known = prints.join(copies.select("print", "copies"), "print")
    all_gone = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start: long, end: long>>")
    found = known.join(materialize(removed, "removed").dropDuplicates(["row"]), "row", "left").select(
        "id", "n_bytes", F.when(whole, all_gone).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "print"))
        .alias("kept_sha256"))
    spark.sql(f"DROP TABLE {name}")  # its files stay until the work folder is cleared
    return found.select("id", "n_bytes", F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        "spans", "kept_sha256")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses when 200-byte strings that stand twice are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_repeats(docs.select(F.col("doc_id").alias("id"), "text"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLE = {}
