"""Work on Arrow batches: texts as byte arrays, and columns added batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHUNK_BYTES = 2 << 20  # text that one numpy pass works on, unless a single text is longer
POWERS = 1 << 18       # powers that the tables of ``Hashes`` grow by
BATCH_BYTES = 2 << 20  # of an Arrow batch, unless a single row is longer
BATCH_ROWS = 1 << 10   # of Parquet rows that are decoded together


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of BATCH_BYTES for jobs run within: the JVM and Python hold copies of a batch."""
    sizes = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
             "spark.sql.parquet.columnarReaderBatchSize": BATCH_ROWS}
    before = {name: spark.conf.get(name) for name in sizes}
    for name, value in sizes.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def add_columns(df: DataFrame, work: Callable[[pa.RecordBatch], Sequence], fields: str,
                keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of ``df`` and the ``fields`` (DDL) that ``work`` gives per batch.

    ``work`` returns one list or array per field, as long as the batch.  There is no
    shuffle, and a lost task is simply run again.
    """
    added = StructType.fromDDL(fields)
    schema = StructType([df.schema[name] for name in keep] + added.fields)
    types = [to_arrow_schema(added).field(i).type for i in range(len(added))]
    keep, names = list(keep), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = [as_array(x, t) for x, t in zip(work(batch), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + columns,
                                                 names=names)

    return df.mapInArrow(run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind) if not isinstance(values, pa.Array) else values.cast(kind)


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts of about ``size`` bytes; null is empty.

    ``offsets`` has one entry more than the run has texts and starts at 0.
    """
    texts = texts.cast(pa.large_binary()) if pa.types.is_binary(texts.type) else (
        texts.cast(pa.large_string()))
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) else "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        own = offsets[first:last + 1]
        yield first, data[own[0]:own[-1]], own - own[0]
        first = last


_SYMBOLS = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        n = -(-n // POWERS) * POWERS + 1  # no more than the longest chunk needs
        _tables[:] = []
        for base in (_BASE, _INVERSE):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _tables.append(np.multiply.accumulate(table))
    return _tables[0], _tables[1]


class Hashes:
    """64-bit hashes of any spans of a byte array, alike wherever the span stands."""

    def __init__(self, data: np.ndarray, symbols: np.ndarray = _SYMBOLS):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(symbols[data] * power[:len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def folded_symbols() -> np.ndarray:
    """Symbols for ``Hashes`` that take A-Z for a-z."""
    folded = _SYMBOLS.copy()
    folded[65:91] = folded[97:123]
    return folded


def words(separator: np.ndarray, data: np.ndarray,
          offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text of each) of the words between separators, in order.

    ``separator`` says of each of the 256 bytes whether it separates; no word goes
    from one text into the next.
    """
    inside = ~separator[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:][inside] = True
    ends[:-1][inside] = False
    cuts = offsets[1:-1]  # where a text begins inside the array
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = cuts[inside[cuts] & inside[cuts - 1]]
    starts[joined] = True
    ends[joined] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1
