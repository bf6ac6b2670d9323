"""Language identification by unigrams of pieces, summed over all segmentations.

The vocabulary is that of a public tokenizer and stays as it is; only the probability
of each piece in each language is learned, by expectation-maximisation over all ways
of cutting training words into pieces.  A text is scored by the forward algorithm,
which sums over all segmentations.  No piece crosses the end of a word, so the score
of a text is the sum of its words', and a word is worked out once per task.  Long words
are gone through in windows, and the sums are scaled on the way, so that none vanishes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.batches import add_columns, small_batches
from harrow.session import materialize

DOCS_PER_LANGUAGE = 1_000  # training texts per language, about; a bounded sample
ROUNDS = 3                 # of expectation-maximisation
USE_UNITS = 1 << 20        # expected uses are summed in whole units of 1 / USE_UNITS
CELLS = 1 << 20            # pieces, times languages, whose probabilities are held at once
WINDOW = 1 << 11           # positions of a word gone through at once
SCALE_EVERY = 16           # positions after which sums are scaled
UNKNOWN = 1e-7             # probability of a character that is no piece
SMOOTHING = 0.5            # expected uses added to every piece
CACHED_BYTES = 24 << 20    # of words and their scores that a worker remembers, about
TEXT_CHARS = 1 << 20       # of texts scored together, or one longer text
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of the public vocabulary in lower case, with ``▁`` for the start of a word."""
    import sentencepiece

    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return sorted(p for p in pieces if p)


def _runs(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    if not text or not any(map(str.isalpha, text)):  # numbers like a raised 2 are no letters
        return []
    return _WORD.findall(text.lower())


def text_words(text: str | None) -> list[str]:
    """Runs of letters in lower case, marked as starts of a word."""
    return ["▁" + w for w in _runs(text)]


@dataclass
class LanguageModel:
    """Piece probabilities, one row per piece and one column per language."""

    languages: list[str]
    pieces: list[str]
    probabilities: np.ndarray

    def __post_init__(self):
        self._ready = False
        self._known: dict[str, int] = {}    # the words remembered and their rows in _table
        self._table = np.zeros((0, len(self.languages)))

    def __getstate__(self):
        return self.languages, self.pieces, self.probabilities

    def __setstate__(self, state):
        self.__init__(*state)

    def _prepare(self) -> None:
        """What the pieces are looked up by: a number for each of their beginnings.

        ``_steps`` has, sorted, beginning * _ends + character for each beginning that goes on
        with the character, ``_next`` the beginning that this gives, and ``_piece`` the id of
        the piece that a beginning is, or 0.  The number 0 is the empty beginning.
        """
        if self._ready:
            return
        self._ends = 1 + max((ord(c) for p in self.pieces for c in p), default=0)
        ids = {p: i + 1 for i, p in enumerate(self.pieces)}
        starts = {"": 0}
        for p in self.pieces:
            for size in range(1, len(p) + 1):
                starts.setdefault(p[:size], len(starts))
        steps = np.array([starts[p[:-1]] * self._ends + ord(p[-1]) for p in starts if p], np.int64)
        order = np.argsort(steps)
        self._steps, self._next = steps[order], order + 1
        self._piece = np.array([ids.get(p, 0) for p in starts], np.int32)
        self._longest = max(map(len, self.pieces), default=1)
        self._padded = np.vstack([np.zeros(len(self.languages)), self.probabilities])
        self._ready = True

    def _lattice(self, words: list[str], first: int, last: int) -> np.ndarray:
        """Piece ids [word, end, length - 1] of words of one length; 0 where there is none.

        The ends run from ``first`` to ``last``, counted from 1.
        """
        self._prepare()
        longest = min(self._longest, len(words[0]))
        before = max(0, first - longest)  # characters before it lie in no piece of these ends
        text = np.array([w[before:last] for w in words]).view(np.uint32)
        text = text.reshape(len(words), last - before).astype(np.int64)
        found = np.zeros((len(words), last + 1 - first, longest), np.int32)
        # From every place of every word as far as a piece goes on, one character at a time.
        word, place = (x.ravel() for x in np.indices(text.shape))
        begun = np.zeros(len(word), np.int64)
        for size in range(1, longest + 1 if len(self._steps) else 1):
            letter = text[word, place + size - 1]
            step = begun * self._ends + letter
            at = np.minimum(np.searchsorted(self._steps, step), len(self._steps) - 1)
            on = (letter < self._ends) & (self._steps[at] == step)
            word, place, begun = word[on], place[on], self._next[at[on]]
            end = place + before + size
            inside = end >= first
            found[word[inside], end[inside] - first, size - 1] = self._piece[begun[inside]]
            on = end < last
            word, place, begun = word[on], place[on], begun[on]
        return found

    def _parts(self, words: list[str], columns: int) -> Iterator[tuple[np.ndarray, list, int]]:
        """(indexes, windows as (first end, last end), longest piece) of words of one length."""
        self._prepare()
        for index in _by_length(words):
            n = len(words[index[0]])
            longest = min(self._longest, n)
            together = max(1, CELLS // (min(n, WINDOW) * longest * columns))
            windows = [(a, min(a + WINDOW - 1, n)) for a in range(1, n + 1, WINDOW)]
            for at in range(0, len(index), together):
                yield index[at:at + together], windows, longest

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Logarithm of each word's probability per language, over all segmentations."""
        scores = np.empty((len(words), len(self.languages)))
        for index, windows, longest in self._parts(words, len(self.languages)):
            own = [words[i] for i in index]
            ring, log = _start(len(own), longest, len(self.languages))
            for first, last in windows:
                ids = self._lattice(own, first, last)
                steps = self._padded[ids]
                steps[:, :, 0][ids[:, :, 0] == 0] = UNKNOWN
                ring, log, _ = _forward(steps, ring, log)
            scores[index] = np.log(ring[:, -1]) + log
        return scores

    def _rows(self, words: list[str]) -> list[int]:
        """Where the scores of the words, not marked, stand in the table."""
        most = CACHED_BYTES // (120 + 8 * len(self.languages))
        fresh = [w for w in dict.fromkeys(words) if w not in self._known]
        if len(self._known) + len(fresh) > most and self._known:
            self._known.clear()
            fresh = list(dict.fromkeys(words))
        n = len(self._known)
        if n + len(fresh) > len(self._table) or len(self._table) > max(most, n + len(fresh)):
            table = np.empty((max(n + len(fresh), min(2 * n, most)), len(self.languages)))
            table[:n] = self._table[:n]
            self._table = table
        if fresh:
            self._table[n:n + len(fresh)] = self.word_scores(["▁" + w for w in fresh])
            self._known.update(zip(fresh, range(n, n + len(fresh)), strict=True))
        return list(map(self._known.__getitem__, words))

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its probability."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        names: list[str] = []
        shares: list[float] = []
        at = 0
        while at < len(texts):
            size, own = 0, []
            while at < len(texts) and (not own or size + len(texts[at] or "") <= TEXT_CHARS):
                size += len(texts[at] or "")
                own.append(_runs(texts[at]))
                at += 1
            lengths = np.array([len(words) for words in own])
            rows = np.array(self._rows([w for words in own for w in words]), np.int64)
            totals = np.zeros((len(own), len(self.languages)))
            some = np.flatnonzero(lengths)
            if len(some):  # one sum per text, whatever texts stand beside it
                starts = (np.cumsum(lengths) - lengths)[some]
                totals[some] = np.add.reduceat(self._table[rows], starts, axis=0)
            share = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
            names += [self.languages[b] if n else UNDETERMINED
                      for b, n in zip(totals.argmax(axis=1), lengths, strict=True)]
            shares += [float(s) if n else 0.0 for s, n in zip(share, lengths, strict=True)]
        return names, shares


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    if len(order):
        yield from np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1)


def _start(words: int, longest: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums at the last ``longest`` ends before the first, and their scale's logarithm."""
    ring = np.zeros((words, longest, columns))
    ring[:, -1] = 1
    return ring, np.zeros((words, columns))


def _forward(steps: np.ndarray, ring: np.ndarray, log: np.ndarray,
             keep: bool = False) -> tuple[np.ndarray, np.ndarray, list]:
    """The forward sums behind a window, their scale, and with ``keep`` how they came about.

    ``steps`` has the probability of [word, end, length - 1, column].  What is kept is, for
    every end, each piece's part of its sum and the scale that it has.
    """
    words, n, longest, columns = steps.shape
    sums = np.empty((words, longest + n, columns))
    sums[:, :longest] = ring
    kept = []
    for end in range(n):
        flow = sums[:, end:end + longest][:, ::-1] * steps[:, end]
        if keep:
            kept.append((flow, log))
        sums[:, end + longest] = flow.sum(axis=1)
        if (end + 1) % SCALE_EVERY == 0 or end + 1 == n:
            last = sums[:, end + 1:end + longest + 1]
            top = last.max(axis=1)
            last /= top[:, None]
            log = log + np.log(top)
    return sums[:, n:], log, kept


def expected_uses(model: LanguageModel, words: list[str], columns: np.ndarray,
                  counts: np.ndarray) -> np.ndarray:
    """How often each piece is used in each language, over all segmentations of the words.

    Word i stands ``counts[i]`` times in the language of column ``columns[i]``.  The forward
    sums are kept at the start of every window only, and worked out again on the way back.
    """
    n_languages = len(model.languages)
    uses = np.zeros((len(model.pieces) + 1) * n_languages)
    for index, windows, longest in model._parts(words, 1):
        own, column = [words[i] for i in index], columns[index]

        def steps_of(first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
            ids = model._lattice(own, first, last)
            steps = model._padded[ids, column[:, None, None]]
            steps[:, :, 0][ids[:, :, 0] == 0] = UNKNOWN
            return ids, steps[..., None]

        state = _start(len(own), longest, 1)
        states = []
        for window in windows:
            states.append(state)
            state = _forward(steps_of(*window)[1], *state)[:2]
        whole = (np.log(state[0][:, -1]) + state[1])[:, 0]
        # ``behind`` is the sum over all that follows an end; ``waiting`` those of the ends
        # before it, as far as they are known.
        behind, scale = np.ones(len(own)), np.zeros(len(own))
        waiting = np.zeros((len(own), longest))
        for window, state in zip(windows[::-1], states[::-1], strict=True):
            ids, steps = steps_of(*window)
            kept = _forward(steps, *state, keep=True)[2]
            expected = np.empty(ids.shape)
            for end in range(ids.shape[1] - 1, -1, -1):
                flow, log = kept[end]
                share = counts[index] * behind * np.exp(log[:, 0] + scale - whole)
                expected[:, end] = flow[..., 0] * share[:, None]
                waiting += behind[:, None] * steps[:, end, :, 0]
                behind = waiting[:, 0].copy()
                waiting[:, :-1] = waiting[:, 1:]
                waiting[:, -1] = 0
                if end % SCALE_EVERY == 0:
                    top = np.maximum(behind, waiting.max(axis=1))
                    top[top == 0] = 1
                    behind /= top
                    waiting /= top[:, None]
                    scale = scale + np.log(top)
            place = ids.astype(np.int64) * n_languages + column[:, None, None]
            uses += np.bincount(place.ravel(), expected.ravel(), len(uses))
    return uses.reshape(-1, n_languages)[1:]


def _even(languages: list[str], pieces: list[str]) -> LanguageModel:
    return LanguageModel(languages, pieces,
                         np.full((len(pieces), len(languages)), 1 / max(len(pieces), 1)))


def _next(model: LanguageModel, uses: np.ndarray) -> LanguageModel:
    uses = uses + SMOOTHING
    return LanguageModel(model.languages, model.pieces, uses / uses.sum(axis=0))


def train(counts: list[tuple[str, str, int]], pieces: list[str],
          rounds: int = ROUNDS) -> LanguageModel:
    """Piece probabilities by expectation-maximisation from (language, word, count)."""
    languages = sorted({language for language, _, _ in counts})
    columns = np.array([languages.index(language) for language, _, _ in counts], np.int64)
    words, weights = [w for _, w, _ in counts], np.array([n for _, _, n in counts], np.float64)
    model = _even(languages, pieces)
    for _ in range(rounds):
        model = _next(model, expected_uses(model, words, columns, weights))
    return model


def _train_on(counted: DataFrame, languages: list[str], pieces: list[str],
              rounds: int = ROUNDS) -> LanguageModel:
    """As ``train``, from a table (lang, word, n) that stays with the executors.

    Each round brings one number per piece and language to the driver.  The numbers are
    whole, so the order in which they are summed does not matter.
    """
    context, model = counted.sparkSession.sparkContext, _even(languages, pieces)
    for _ in range(rounds):
        shared = context.broadcast(model)

        def use(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model, total = shared.value, None
            column = {language: i for i, language in enumerate(model.languages)}
            for batch in batches:
                lang, word, n = batch.columns
                columns = np.array([column[x] for x in lang.to_pylist()], np.int64)
                uses = expected_uses(model, word.to_pylist(), columns,
                                     n.to_numpy().astype(np.float64))
                total = uses if total is None else total + uses
            if total is not None:
                units = np.rint(total * USE_UNITS).astype(np.int64).ravel()
                place = np.flatnonzero(units)
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(units[place])],
                                                 names=["place", "units"])

        summed = (counted.mapInArrow(use, "place long, units long")
                  .groupBy("place").agg(F.sum("units").alias("units")).toArrow())
        uses = np.zeros(len(pieces) * len(languages))
        uses[summed.column("place").to_numpy()] = summed.column("units").to_numpy()
        model = _next(model, uses.reshape(len(pieces), len(languages)) / USE_UNITS)
        shared.unpersist()
    return model


def learn_languages(docs: DataFrame, vocabulary_path: str | None = None) -> LanguageModel:
    """A model of the languages in ``lang``, from a bounded sample of ``text``.

    Rows with a null language or text are left out; without any row the model knows no
    language.  The sample takes about DOCS_PER_LANGUAGE different texts per language, picked
    by a hash of the text; every word of these texts trains, copies count once.
    """
    docs = docs.select("lang", "text").dropna()
    sizes = {r[0]: r[1] for r in docs.groupBy("lang").count().collect()}
    if not sizes:  # nothing to learn: every text is undetermined
        return LanguageModel([], [], np.zeros((0, 0)))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, min(1.0, DOCS_PER_LANGUAGE / n))])
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000.0
    sample = docs.filter(place < share[F.col("lang")]).dropDuplicates(["lang", "text"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.update((lang, w) for w in text_words(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()),
                 pa.array([k[1] for k in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    counted = (sample.mapInArrow(count, "lang string, word string, n long")
               .groupBy("lang", "word").agg(F.sum("n").alias("n"))
               .sortWithinPartitions("lang", "word"))
    # A language with letters in none of its texts keeps a column, with even probabilities.
    with small_batches(docs.sparkSession):
        return _train_on(materialize(counted, "words"), sorted(sizes), vocabulary(vocabulary_path))


def identify(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    Needs a column ``text``.  A text that is null or has no letter is ``und`` with score
    0; any other gets one of the model's languages and its posterior probability under
    equal priors.  Repeated rows get equal results.  ``keep`` names the columns to keep.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> tuple[list[str], list[float]]:
        return shared.value.score(batch.column("text").to_pylist())

    return add_columns(docs, work, "lang_pred string, score double", keep or docs.columns)


def held_out():
    """Whether a row takes no part in learning."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def corpus_model(docs: DataFrame) -> LanguageModel:
    """The model learned from the documents that are not held out."""
    return learn_languages(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    found = identify(docs.drop("lang"), corpus_model(docs), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op10_language_id": op10_language_id}
ORACLE = {}
