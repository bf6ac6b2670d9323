"""Whole-document JSON read by many tasks: one array cut into its elements.

A document is read as records that end at a character, so that Spark splits its file into
byte ranges like any text file.  Where a range starts inside the document, in a string or
at what depth of brackets, depends on all ranges before it; but what a range does to either
state can be told without knowing it.  A first pass brings that summary of every range, one
short row each, to the driver, which works out the states; a second pass cuts every range.
An element that crosses ranges comes in pieces, which are put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.session import ship_package

CHUNK = 4 << 20  # bytes cut at a time

_QUOTE, _BACKSLASH, _COMMA, _OPEN = b'"\\,['
_STEP = np.zeros(256, np.int8)
_STEP[[*b"[{"]], _STEP[[*b"]}"]] = 1, -1
_FAR = 1 << 40  # deeper than any comma


def quotes(data: np.ndarray) -> np.ndarray:
    """Whether each byte is a quote that starts or ends a string."""
    found = data == _QUOTE
    at = np.flatnonzero(found)
    behind = at[(at > 0) & (data[at - 1] == _BACKSLASH)]
    if len(behind):  # escaped by an odd run of backslashes
        other = np.flatnonzero(data != _BACKSLASH)
        last = np.searchsorted(other, behind) - 1
        run = behind - 1 - np.where(last >= 0, other[last], -1)
        found[behind[run % 2 == 1]] = False
    return found


@dataclass(frozen=True)
class RangeSummary:
    """What a byte range does, started outside of a string and started inside of one.

    ``first`` is its first byte that is no white space, or -1; ``odd`` says whether it has an
    odd number of quotes; per start, ``steps`` is how much deeper it ends and ``comma`` the
    least depth of a comma outside strings.
    """

    first: int
    odd: bool
    steps: tuple[int, int]
    comma: tuple[int, int]


def summarize(parts: Iterator[np.ndarray]) -> RangeSummary:
    """The summary of a range given in parts that end in the mark between records."""
    first, odd, steps, comma = -1, False, [0, 0], [_FAR, _FAR]
    for data in parts:
        text = data[:-1].tobytes().lstrip()  # behind the last record of a file the mark is ours
        first = text[0] if first < 0 and text else first
        inside = np.logical_xor.accumulate(quotes(data)) ^ odd
        for start in (0, 1):
            outside = inside == bool(start)
            depth = np.cumsum(np.where(outside, _STEP[data], 0), dtype=np.int64) + steps[start]
            commas = depth[(data == _COMMA) & outside]
            comma[start] = min(comma[start], int(commas.min()) if len(commas) else _FAR)
            steps[start] = int(depth[-1])
        odd = bool(inside[-1])
    return RangeSummary(first, odd, tuple(steps), tuple(comma))


@dataclass(frozen=True)
class RangeStart:
    """The state in which a range starts, and the range in which its first element starts.

    ``kind`` is the first byte of the document, -1 ahead of it; ``ended`` is set behind it.
    """

    in_string: bool
    depth: int
    origin: int
    kind: int
    ended: bool


def range_starts(summaries: list[tuple[int, RangeSummary]]) -> dict[int, RangeStart]:
    """The start of each range of one document, from (position, summary) in order."""
    starts = {}
    in_string, depth, origin, kind = False, 0, 0, -1
    for position, summary in summaries:
        starts[position] = RangeStart(in_string, depth, origin, kind,
                                      kind >= 0 and depth <= 0 and not in_string)
        if kind < 0 and summary.first >= 0:
            kind, origin = summary.first, position
        elif kind == _OPEN and depth + summary.comma[in_string] == 1:
            origin = position  # an element ends in this range, and another one starts
        depth += summary.steps[in_string]
        in_string ^= summary.odd
    return starts


def cut_elements(parts: Iterator[np.ndarray], start: RangeStart,
                 position: int) -> Iterator[tuple[int | None, bytes]]:
    """(range in which it starts, text) of the elements of a range.

    Whole elements have no range; the first and last may be pieces.  A document that is no
    array is one element.
    """
    in_string, depth, origin, kind = start.in_string, start.depth, start.origin, start.kind
    ended, whole, held = start.ended, kind < 0, b""
    for data in parts:
        if ended:
            continue
        inside = np.logical_xor.accumulate(quotes(data)) ^ in_string
        levels = np.cumsum(np.where(inside, 0, _STEP[data]), dtype=np.int64) + depth
        in_string, depth = bool(inside[-1]), int(levels[-1])
        text, first = data.tobytes(), 0
        if kind < 0:
            lead = text[:-1].lstrip()
            if not lead:
                depth = 0
                continue
            origin, kind = position, lead[0]
            first = len(text) - 1 - len(lead) + (kind == _OPEN)
            if kind not in b'[{"':  # a single number or word
                yield None, lead
                ended = True
                continue
        closed = ~inside & (data == _QUOTE if kind == _QUOTE else (levels == 0) & (_STEP[data] < 0))
        ends = closed | (~inside & (data == _COMMA) & (levels == 1)) if kind == _OPEN else closed
        for end in np.flatnonzero(ends).tolist():
            ended = bool(closed[end])
            yield None if whole else origin, held + text[first:end + (ended and kind != _OPEN)]
            whole, held, origin, first = True, b"", position, end + 1
            if ended:
                break
        if not ended:
            held += text[first:]
    if held and not ended:
        yield origin, held


def _parts(batches: Iterator[pa.RecordBatch], mark: bytes) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
    """((file, position), bytes) of the ranges' records in order, about CHUNK at a time."""
    key, held, size = None, [], 0
    for batch in batches:
        files, positions, values = batch.columns
        for file, position, value in zip(files.to_pylist(), positions.to_pylist(),
                                         values.cast(pa.binary()), strict=True):
            if (file, position) != key or size >= CHUNK:
                if held:
                    yield key, np.frombuffer(b"".join(held), np.uint8)
                key, held, size = (file, position), [], 0
            text = value.as_py()
            held += [text, mark]
            size += len(text) + 1
    if held:
        yield key, np.frombuffer(b"".join(held), np.uint8)


def _ranges(batches: Iterator[pa.RecordBatch], mark: bytes):
    """((file, position), parts) of one range after the other; the parts must be used up."""
    for key, group in groupby(_parts(batches, mark), key=lambda part: part[0]):
        yield key, (data for _, data in group)


def json_array_elements(spark: SparkSession, path: str, cut_at: str = "}") -> DataFrame:
    """(file, element): the text of every element of the JSON arrays at ``path``.

    Each file holds one document; one that is no array is a single element.  Records end at
    ``cut_at``, a comma or a closing bracket: ``}`` suits arrays of objects, ``,`` any other.
    A task holds about CHUNK bytes and one element.  Files of white space have no elements.
    """
    if cut_at not in ("}", "]", ","):
        raise ValueError("cut_at must be one of } ] ,")
    ship_package(spark)
    mark = cut_at.encode()
    lines = spark.read.option("lineSep", cut_at).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("position"), "value")

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(*key, found.first, found.odd, *found.steps, *found.comma)
                for key, parts in _ranges(batches, mark) for found in [summarize(parts)]]
        names = ["file", "position", "first", "odd", "steps_out", "steps_in", "comma_out", "comma_in"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    # One row for each byte range that Spark reads.
    found = lines.mapInArrow(summary, (
        "file string, position long, first long, odd boolean, steps_out long, steps_in long, "
        "comma_out long, comma_in long")).collect()
    files: dict[str, list] = {}
    for file, position, first, odd, *numbers in sorted(map(tuple, found)):
        files.setdefault(file, []).append(
            (position, RangeSummary(first, odd, tuple(numbers[:2]), tuple(numbers[2:]))))
    starts = spark.sparkContext.broadcast({f: range_starts(s) for f, s in files.items()})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, position), parts in _ranges(batches, mark):
            origins, texts, size = [], [], 0
            for origin, text in cut_elements(parts, starts.value[file][position], position):
                origins.append(origin)
                texts.append(text.strip() if origin is None else text)
                size += len(text)
                if size >= CHUNK:
                    yield _cut_batch(file, position, origins, texts)
                    origins, texts, size = [], [], 0
            yield _cut_batch(file, position, origins, texts)

    pieces = lines.mapInArrow(cut, "file string, position long, origin long, element string")
    whole = pieces.filter(F.col("origin").isNull()).select("file", "element")
    # At most two pieces for each range.
    crossing = pieces.filter(F.col("origin").isNotNull()).groupBy("file", "origin").agg(
        F.array_sort(F.collect_list(F.struct("position", "element"))).alias("parts"))
    joined = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["element"]), ""),
                              r"^\s+|\s+$", "")
    return whole.unionByName(crossing.select("file", joined.alias("element"))).filter(
        F.col("element") != "")


def _cut_batch(file, position, origins, texts) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * n, pa.string()), pa.array([position] * n, pa.int64()),
         pa.array(origins, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
        names=["file", "position", "origin", "element"])


def write_json_arrays(rows: DataFrame, path: str) -> None:
    """Write rows as JSON documents, one array of objects per task and file."""
    ship_package(rows.sparkSession)

    def bracket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            lines = batch.column(0).to_pylist()
            if lines:
                marks = [" [" if first else ",", *[","] * (len(lines) - 1)]
                first = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m + x for m, x in zip(marks, lines, strict=True)])], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])

    objects = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    objects.mapInArrow(bracket, "value string").write.text(path)
