"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is labelled good or bad from features of itself and of its neighbours.  The
marginals of the forward-backward algorithm, weighted by line length, make the quality
of the document.  A document's label stands for all its lines in training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.batches import Hashes, add_columns, chunks, words

TRAINING_DOCS = 2_000   # labelled documents that train, about; a bounded sample
TRAINING_LINES = 200    # lines of a chain that trains; a longer document is several chains
STEPS = 250             # of gradient descent
RATE = 0.1
PENALTY = 1e-3

_CLASSES = {
    "upper": list(range(65, 91)),
    "lower": list(range(97, 123)),
    "digit": list(range(48, 58)),
    "wide": list(range(128, 256)),
    "stop": [ord(c) for c in ".,;:?'\""],
    "mark": [ord(c) for c in "!"],
    "bar": [ord(c) for c in "|<>{}[]\\/_~^`"],
    "sign": [ord(c) for c in "#$%&*@+=-()"],
}
N_OWN = len(_CLASSES) + 6
N_FEATURES = 3 * N_OWN + 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def line_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text of each) of all non-empty lines, in order."""
    newline = np.zeros(256, bool)
    newline[10] = True
    return words(newline, data, offsets)


def line_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                  texts: np.ndarray) -> np.ndarray:
    """A row of N_FEATURES per line: its own, the line's before and after, and a constant."""
    length = np.maximum(ends - starts, 1).astype(float)
    own = np.zeros((len(starts), N_OWN))
    for i, members in enumerate(_CLASSES.values()):
        table = np.zeros(256, np.uint8)
        table[members] = 1
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        own[:, i] = (sums[ends] - sums[starts]) / length
    cuts = np.stack([starts, ends], 1).ravel()  # words end where their line does
    word_starts, word_ends, place = words(_SPACE, data, np.concatenate([[0], cuts, [len(data)]]))
    line = (place - 1) // 2
    inside = (place % 2 == 1) & (line < len(starts))
    word_starts, word_ends, line = word_starts[inside], word_ends[inside], line[inside]
    count = np.bincount(line, minlength=len(starts)).astype(float)
    hashes = Hashes(data)(word_starts, word_ends)
    same = np.zeros(len(line))
    if len(line) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    some = np.maximum(count, 1)
    at = len(_CLASSES)
    own[:, at] = np.bincount(line, same, len(starts)) / some
    own[:, at + 1] = np.minimum(length / some, 40) / 20
    own[:, at + 2] = np.log1p(count) / 5
    last = data[np.maximum(ends - 1, 0)]
    own[:, at + 3] = np.isin(last, [46, 33, 63])
    own[:, at + 4] = (data[starts] >= 65) & (data[starts] < 91) if len(starts) else 0
    line_hash = Hashes(data)(starts, ends)
    again = np.zeros(len(starts))
    if len(starts):
        order = np.lexsort((line_hash, texts))
        twin = (line_hash[order][1:] == line_hash[order][:-1]) & (texts[order][1:] == texts[order][:-1])
        again[order[1:]] += twin
        again[order[:-1]] += twin
    own[:, at + 5] = again > 0
    features = np.zeros((len(starts), N_FEATURES))
    features[:, :N_OWN] = own
    joined = texts[1:] == texts[:-1]
    features[1:, N_OWN:2 * N_OWN] = own[:-1] * joined[:, None]
    features[:-1, 2 * N_OWN:3 * N_OWN] = own[1:] * joined[:, None]
    features[:, -1] = 1
    return features


@dataclass
class LineField:
    """The field: weights of a good line, of moving between states, and the calibration.

    ``moves`` is [state before, state after] with 0 for bad and 1 for good; ``scale`` and
    ``shift`` turn the length-weighted share of good lines into a probability, and
    ``empty`` is the score of a text without lines.
    """

    weights: np.ndarray
    moves: np.ndarray
    scale: float
    shift: float
    empty: float

    def marginals(self, features: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """The probability that each line is good, given all lines of its text."""
        return _chain(features @ self.weights, self.moves, texts)[0]

    def score(self, shares: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * _logit(shares) + self.shift)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _chain(emit: np.ndarray, moves: np.ndarray,
           texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over the lines of all texts side by side.

    Gives the probability of good per line, and the expected number of moves of each
    kind per text, summed.  Lines of a text are consecutive.
    """
    n = len(emit)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    own = np.stack([np.zeros(n), emit], 1)
    first = np.concatenate([[True], texts[1:] != texts[:-1]])
    begins = np.flatnonzero(first)
    sizes = np.diff(np.append(begins, n))
    longest = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[longest], sizes[longest]
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")  # texts with a line i
    alpha, beta = np.empty((n, 2)), np.zeros((n, 2))
    alpha[begins] = own[begins]
    for i in range(1, sizes[0]):
        at = begins[:alive[i]] + i
        alpha[at] = own[at] + _log_sum(alpha[at - 1][:, :, None] + moves, 1)
    expected = np.zeros((2, 2))
    for i in range(sizes[0] - 1, 0, -1):
        at = begins[:alive[i]] + i
        ahead = moves + (own[at] + beta[at])[:, None, :]
        beta[at - 1] = _log_sum(ahead, 2)
        joint = alpha[at - 1][:, :, None] + ahead
        joint -= _log_sum(joint.reshape(len(at), 4), 1)[:, None, None]
        expected += np.exp(joint).sum(axis=0)
    total = alpha + beta
    return 1 / (1 + np.exp(total[:, 0] - total[:, 1])), expected


def train(features: np.ndarray, texts: np.ndarray, lengths: np.ndarray,
          good: np.ndarray) -> LineField:
    """Fit the field by gradient ascent on the likelihood; ``good`` holds 0 or 1 per line."""
    weights, moves = np.zeros(features.shape[1]), np.zeros((2, 2))
    joined = texts[1:] == texts[:-1]
    states = good.astype(int)
    observed = np.zeros((2, 2))
    np.add.at(observed, (states[:-1][joined], states[1:][joined]), 1)
    n = max(len(good), 1)
    m1, m2 = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for step in range(1, STEPS + 1):
        p, expected = _chain(features @ weights, moves, texts)
        slope = np.concatenate([features.T @ (good - p) / n - PENALTY * weights,
                                ((observed - expected) / n - PENALTY * moves).ravel()])
        m1, m2 = 0.9 * m1 + 0.1 * slope, 0.99 * m2 + 0.01 * slope * slope
        move = RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
        weights, moves = weights + move[:-4], moves + move[-4:].reshape(2, 2)
    field = LineField(weights, moves, 1.0, 0.0, 0.5)
    shares, labels = _shares(field.marginals(features, texts), texts, lengths, good)
    x = np.stack([_logit(shares), np.ones(len(shares))], 1)
    line = np.array([1.0, 0.0])
    for _ in range(30):  # the calibration of the documents' shares: Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + PENALTY * np.eye(2)
        line = line + np.clip(np.linalg.solve(curve, x.T @ (labels - p) - PENALTY * line), -1, 1)
    scale, shift = max(float(line[0]), 0.1), float(line[1])
    return LineField(weights, moves, scale, shift, float(labels.mean()) if len(labels) else 0.5)


def _shares(p: np.ndarray, texts: np.ndarray, lengths: np.ndarray,
            good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The length-weighted share of good lines and the label of each text."""
    _, first, place = np.unique(texts, return_index=True, return_inverse=True)
    share = np.bincount(place, p * lengths) / np.bincount(place, lengths)
    return share, good[first].astype(float)


def learn_quality(docs: DataFrame, labels: DataFrame) -> LineField:
    """A field learned from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    Rows with a null are left out.  About TRAINING_DOCS labels are picked by a hash of the
    id, at most twice as many, so they are broadcast; equal texts of a label train once.
    Documents are cut into chains of up to TRAINING_LINES lines, and at most four times
    TRAINING_DOCS chains train, those with the smallest hashes.  Without any, all texts
    score 0.5.
    """
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000.0
    picked = (labels.filter(place < TRAINING_DOCS / max(labels.count(), 1)).distinct()
              .orderBy(place, "doc_id", "quality").limit(2 * TRAINING_DOCS))
    sample = (docs.select("doc_id", "text").dropna().join(F.broadcast(picked), "doc_id")
              .select("text", "quality").distinct())

    def work(batch: pa.RecordBatch) -> list[list]:
        found: list[list] = []
        for _, data, offsets in chunks(batch.column("text")):
            starts, ends, texts = line_table(data, offsets)
            features = line_features(data, starts, ends, texts)
            cuts = np.searchsorted(texts, np.arange(len(offsets)))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                edges = [*range(a, b, TRAINING_LINES), b]
                found.append([{"features": features[x:y].tobytes(),
                               "lengths": (ends[x:y] - starts[x:y]).astype(np.int64).tobytes()}
                              for x, y in zip(edges, edges[1:])])
        return [found]

    found = add_columns(sample, work, "chains array<struct<features: binary, lengths: binary>>",
                        ["quality"])
    found = found.select("quality", F.explode("chains").alias("chain")).select("quality", "chain.*")
    rows = (found.orderBy(F.xxhash64("features", "lengths"), "quality")
            .limit(4 * TRAINING_DOCS).collect())
    if not rows:  # nothing to learn: every text is as good as bad
        return LineField(np.zeros(N_FEATURES), np.zeros((2, 2)), 1.0, 0.0, 0.5)
    features = np.concatenate([np.frombuffer(r["features"]).reshape(-1, N_FEATURES) for r in rows])
    own = [np.frombuffer(r["lengths"], np.int64) for r in rows]
    sizes = [len(x) for x in own]
    good = np.repeat([float(r["quality"] == 1) for r in rows], sizes)
    return train(features, np.repeat(np.arange(len(rows)), sizes), np.concatenate(own), good)


def score_quality(docs: DataFrame, field: LineField, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; columns of these names are replaced.

    Needs a column ``text``.  ``score`` in 0 to 1 is higher for better text; ``predicted``
    is 1 from 0.5 up.  A text that is null or holds no line gets the training share of
    good documents.  Repeated rows get equal results.  ``keep`` names the columns to keep.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def work(batch: pa.RecordBatch) -> list[np.ndarray]:
        field = shared.value
        scores = np.full(batch.num_rows, field.empty)
        for first, data, offsets in chunks(batch.column("text")):
            starts, ends, texts = line_table(data, offsets)
            p = field.marginals(line_features(data, starts, ends, texts), texts)
            weight = (ends - starts).astype(float)
            total = np.bincount(texts, weight, len(offsets) - 1)
            share = np.bincount(texts, p * weight, len(offsets) - 1) / np.maximum(total, 1)
            some = np.flatnonzero(total)
            scores[first + some] = field.score(share[some])
        return [scores, (scores >= 0.5).astype(np.int32)]

    return add_columns(docs, work, "score double, predicted int", keep or docs.columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels of two thirds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1,
                          F.lit(False))
    known = labels.filter(F.col("doc_id").isNotNull() & ~held_out)
    field = learn_quality(docs, known)
    return score_quality(docs, field, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES = {"op6_quality": op6_quality}
ORACLE = {}
