"""Collocations: phrases that stand more often than their parts would let one expect.

Suffix pointers, one per word, are sorted by multikey three-way quicksort to a depth of four
words.  Every partition of pointers that are equal down to some depth is a phrase, its
weight the number of occurrences; partitions with too few are abandoned at once.

Globally the pointers are routed by their leading words.  Words, then pairs of them, are
counted over the whole corpus first, so that a suffix whose leading words are too rare never
travels; filters sized by the number of frequent words and pairs tell, and what they let
through by mistake is abandoned later.  The suffixes left are added up per chunk of text and
dealt by ranges of their first four words, so that a leading word of any weight is spread over
as many tasks as it needs.  A phrase that crosses the edge of a range is added up afterwards.

Words travel as 64-bit hashes of language and word.  A table of all words shows that no two
have the same one (else another seed is taken), so counts are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harrow.llm.batches import chunks, mix, small_batches, words
from harrow.llm.bits import is_set, packed_bits
from harrow.session import materialize

DEPTH = 4                 # words of the longest phrase
LEAST = 30                # occurrences of a phrase
TOP = 2_000               # phrases listed per language
INSIDE = 80               # percent of its occurrences in a longer phrase that drop a phrase
CHUNK = 4 << 20           # bytes of text that one numpy pass works on, or one longer text
RANGE_ROWS = 1 << 20      # suffixes of a range, about
MOST_BITS = 1 << 30       # of a filter; it has 16 for each frequent key up to there
SLOTS = 64                # parts in which a language's phrases are ranked first

# What ends a piece, and what else ends a word.
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[0x20, 0x09]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

_KEY = [f"h{i}" for i in range(1, DEPTH + 1)]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """(language, its different words, word at each place, whether the next is in one piece)
    of chunks of the texts of one language each."""
    coded = batch.column(0).dictionary_encode()
    for code, lang in enumerate(coded.dictionary.to_pylist()):
        texts = batch.column(1).filter(pa.compute.equal(coded.indices, code))
        for _, data, offsets in chunks(texts, CHUNK):
            data = _FOLD[data]
            starts, ends, text = words(_SEPARATOR, data, offsets)
            if not len(starts):
                continue
            piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts]
            same = np.append((piece[1:] == piece[:-1]) & (text[1:] == text[:-1]), False)
            letters = data[~_SEPARATOR[data]]
            edges = np.concatenate([[0], np.cumsum(ends - starts)])
            found = pa.Array.from_buffers(pa.large_string(), len(starts), [
                None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(letters)])
            found = found.dictionary_encode()
            yield lang, found.dictionary, found.indices.to_numpy(), same


def _hashes(lang: str, vocabulary: pa.Array, seed: int) -> np.ndarray:
    """The hash of each word in its language; 0 is kept for no word."""
    digest, start = xxhash.xxh3_64_intdigest, f"{len(lang)}:{lang}".encode()
    found = [digest(start + w, seed) for w in vocabulary.cast(pa.large_binary()).to_pylist()]
    return np.maximum(np.array(found, np.uint64), np.uint64(1)).view(np.int64)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two words; pairs that share one are told apart later."""
    first, second = first.view(np.uint64), second.view(np.uint64)
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + mix(second.copy())).view(np.int64)


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return is_set(bits, keys.view(np.uint64) & np.uint64(8 * len(bits) - 1))


_Batches = Iterator[pa.RecordBatch]


def _count_words(seed: int) -> Callable[[_Batches], _Batches]:
    """Batches of (lang, text) to the words of each chunk, with their counts."""
    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            for lang, vocabulary, at, _ in _runs(batch):
                n = np.bincount(at, minlength=len(vocabulary))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_hashes(lang, vocabulary, seed)),
                     pa.array([lang] * len(n), pa.string()), vocabulary.cast(pa.string()),
                     pa.array(n)], names=["h", "lang", "word", "n"])

    return run


def _frequent(word_bits: np.ndarray, hashes: np.ndarray, at: np.ndarray,
              same: np.ndarray) -> np.ndarray:
    """Places at which two words that may be frequent follow each other in a piece."""
    good = _has(word_bits, hashes)[at]
    good[:-1] &= good[1:] & same[:-1]
    good[-1] = False
    return np.flatnonzero(good)


def _count_pairs(word_bits: np.ndarray, seed: int) -> Callable[[_Batches], _Batches]:
    """Batches of (lang, text) to the pairs of each chunk, with their counts."""
    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            for lang, vocabulary, at, same in _runs(batch):
                hashes = _hashes(lang, vocabulary, seed)
                place = _frequent(word_bits, hashes, at, same)
                pairs, n = np.unique(_pair(hashes[at[place]], hashes[at[place + 1]]),
                                     return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)],
                                                 names=["pair", "n"])

    return run


def _suffixes(word_bits: np.ndarray, pair_bits: np.ndarray,
              seed: int) -> Callable[[_Batches], _Batches]:
    """Batches of (lang, text) to the suffixes of each chunk, as their first words.

    A suffix ends before a word that makes no frequent pair with the one before it.
    """
    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            for lang, vocabulary, at, same in _runs(batch):
                hashes = _hashes(lang, vocabulary, seed)
                place = _frequent(word_bits, hashes, at, same)
                place = place[_has(pair_bits, _pair(hashes[at[place]], hashes[at[place + 1]]))]
                goes_on = np.zeros(len(at) + DEPTH, bool)
                goes_on[place] = True
                # Words are numbered from 1 here; 0 stands behind the end of a suffix.
                codes, going = [at[place] + 1], goes_on[place]
                for i in range(1, DEPTH):
                    word = np.zeros(len(place), at.dtype)
                    word[going] = at[place[going] + i] + 1
                    codes.append(word)
                    going = going & goes_on[place + i]
                order = np.lexsort(codes[::-1])
                codes = [c[order] for c in codes]
                first = np.ones(len(order), bool)
                first[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0)
                first = np.flatnonzero(first)
                n = np.diff(np.append(first, len(order)))
                known = np.append(0, hashes)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(known[c[first]]) for c in codes), pa.array(n)],
                    names=[*_KEY, "n"])

    return run


def equal_partitions(keys: np.ndarray, weights: np.ndarray,
                     least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(depth, pointer, weight) of the partitions equal to a depth, by three-way quicksort.

    ``keys`` has a row per depth and a column per pointer; 0 ends a key.  All partitions
    are split at once, each by a pivot of its own at its own depth: pointers below, at and
    above it.  Those at the pivot go one deeper.  A partition that weighs less than
    ``least`` is abandoned.  ``pointer`` is one of the partition's.
    """
    deepest, n = keys.shape
    active, sizes, depth = np.arange(n), np.array([n]), np.zeros(1, np.int64)
    found, choose = [], np.random.default_rng(20240229)
    while len(active):
        starts = np.cumsum(sizes) - sizes
        chosen = active[starts + (choose.random(len(sizes)) * sizes).astype(np.int64)]
        pivots = keys[depth, chosen]
        part = np.repeat(np.arange(len(sizes)), sizes)
        own, pivot = keys[depth[part], active], pivots[part]
        side = 3 * part + (own >= pivot) + (own > pivot)
        weight = np.bincount(side, weights[active], 3 * len(sizes)).astype(np.int64)
        kept = weight >= least
        kept[1::3] &= pivots != 0
        below = np.repeat(depth, 3)
        below[1::3] += 1
        equal = np.flatnonzero(kept[1::3])
        found.append((below[1::3][equal], chosen[equal], weight[1::3][equal]))
        kept &= below < deepest
        some = kept[side]
        active, side = active[some], side[some]
        active = active[np.argsort(side, kind="stable")]
        sizes = np.bincount(side, minlength=len(kept))[kept]
        depth = below[kept]
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64)
                 for i in range(3))


def _edges(keys: np.ndarray) -> list[np.ndarray]:
    """The smallest and the largest key."""
    out = []
    for end in (np.min, np.max):
        own = np.arange(keys.shape[1])
        for row in keys:
            own = own[row[own] == end(row[own])]
        out.append(keys[:, own[0]])
    return out


def _phrases(least: int) -> Callable[[_Batches], _Batches]:
    """A range of suffixes to its phrases; ones that may go on in the next range always."""
    def run(batches: _Batches) -> _Batches:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        keys = np.stack([table.column(k).to_numpy() for k in _KEY])
        weights = table.column("n").to_numpy()
        depth, pointer, n = equal_partitions(keys, weights, least)
        rows = np.where(np.arange(DEPTH)[:, None] < depth, keys[:, pointer], 0)
        rows, n = rows[:, depth > 1], n[depth > 1]
        at_edge = {}
        for edge in _edges(keys):
            for d in range(2, DEPTH + 1):
                if edge[d - 1]:
                    phrase = np.where(np.arange(DEPTH) < d, edge, 0)
                    same = (keys[:d] == edge[:d, None]).all(axis=0)
                    at_edge[tuple(phrase.tolist())] = int(weights[same].sum())
                    other = (rows != phrase[:, None]).any(axis=0)
                    rows, n = rows[:, other], n[other]
        if at_edge:
            rows = np.concatenate([rows, np.array(list(at_edge), np.int64).T], axis=1)
            n = np.append(n, list(at_edge.values()))
        yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(n)], names=[*_KEY, "n"])

    return run


def _filter_of(keys: DataFrame, key: str) -> np.ndarray:
    """The bits of all keys, 16 for each up to MOST_BITS; ``keys`` is a written table."""
    size = 1 << 16
    while size < min(16 * keys.count(), MOST_BITS):
        size *= 2
    return packed_bits(keys.select(F.pmod(key, F.lit(size)).alias("bit")), size)


def _part(*names: str) -> Column:
    """A phrase of the named words."""
    padded = [*names, *[""] * (DEPTH - len(names))]
    return F.struct(*((F.col(n) if n else F.lit(0).cast("long")).alias(k)
                      for n, k in zip(padded, _KEY, strict=True)))


def _as_key(part: str) -> list[Column]:
    return [F.col(f"{part}.{k}").alias(f"{part}{i}") for i, k in enumerate(_KEY, 1)]


def _scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """``phrases`` (key, a) with l, r and score of their lowest-scoring cut.

    ``known`` has the count f of every phrase and word with at least as many occurrences.
    """
    cuts = F.array(*(F.struct(F.lit(k).alias("k"), _part(*_KEY[:k]).alias("left"),
                              _part(*_KEY[k:]).alias("right")) for k in range(1, DEPTH)))
    cut = phrases.withColumn("cut", F.explode(F.filter(cuts, lambda c: c["right"]["h1"] != 0)))
    cut = cut.select(*_KEY, "a", "cut.k", F.col("cut.left").alias("l"),
                     F.col("cut.right").alias("r"))
    cut = cut.select(*_KEY, "a", "k", *_as_key("l"), *_as_key("r"))
    for side in ("l", "r"):
        own = [f"{side}{i}" for i in range(1, DEPTH + 1)]
        cut = cut.join(known.select(*(F.col(k).alias(o) for k, o in zip(_KEY, own, strict=True)),
                                    F.col("f").alias(side)), own).drop(*own)
    # A product of 19 + 7 digits: exact, where a long would overflow.
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)))"
                   " div cast(l + r as decimal(19, 0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cut.groupBy(*_KEY, "a").agg(lowest).select(*_KEY, "a", "cut.l", "cut.r", "cut.score")


def _standing(phrases: DataFrame, inside: int) -> DataFrame:
    """``phrases`` without those that mostly stand inside a longer one."""
    spans = [(i, j) for i in range(DEPTH) for j in range(i + 2, DEPTH + 1) if j - i < DEPTH]
    parts = F.array(*(F.when((F.col(_KEY[j - 1]) != 0) & (  # a part of itself is no part
        F.lit(i > 0) | (F.col(_KEY[j]) != 0 if j < DEPTH else F.lit(False))),
        _part(*_KEY[i:j])) for i, j in spans))
    longer = (phrases.filter("h3 <> 0")
              .select("a", F.explode(F.array_compact(parts)).alias("p"))
              .select("a", *_as_key("p")).groupBy(*(f"p{i}" for i in range(1, DEPTH + 1)))
              .agg(F.max("a").alias("longer")).withColumnsRenamed(
                  {f"p{i}": f"h{i}" for i in range(1, DEPTH + 1)}))
    kept = F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True))
    return phrases.join(longer, _KEY, "left").filter(kept).select(phrases.columns)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP,
                 inside: int = INSIDE) -> DataFrame:
    """The best ``top`` phrases of each language of ``docs`` (lang, text).

    Gives lang, rank, phrase, a (its occurrences), l and r (those of the two parts of its
    lowest-scoring cut), n (words of the language) and score, floor(2000000 a / (l + r)).
    Phrases have two to four words, ``least`` occurrences and no end of a piece inside; ones
    with ``inside`` percent of their occurrences in a longer one are dropped.  A null
    language is ``und``; null, empty and wordless texts have no words; repeated rows count
    each; other columns are left alone.  ``rank`` breaks ties by a, then by the phrase's
    bytes.  A language without phrases, and an empty table, give no rows.
    """
    with small_batches(docs.sparkSession):
        return _ranked(docs, least, top, inside)


def _ranked(docs: DataFrame, least: int, top: int, inside: int) -> DataFrame:
    """As ``collocations``; all work on texts is done when it returns."""
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").dropna()
    seed = 0
    while True:
        counted = materialize(
            docs.mapInArrow(_count_words(seed), "h long, lang string, word string, n long")
            .groupBy("h", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if counted.groupBy("h").count().filter("count > 1").isEmpty():
            break
        seed += 1  # two words share a hash: another one for all of them
    common = counted.filter(F.col("n") >= least)
    word_bits = context.broadcast(_filter_of(common, "h"))

    def pairs(batches: _Batches) -> _Batches:
        yield from _count_pairs(word_bits.value, seed)(batches)

    frequent = materialize(docs.mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= least).select("pair"), "pairs")
    pair_bits = context.broadcast(_filter_of(frequent, "pair"))

    def suffixes(batches: _Batches) -> _Batches:
        yield from _suffixes(word_bits.value, pair_bits.value, seed)(batches)

    schema = "".join(f"{k} long, " for k in _KEY) + "n long"
    pointers = materialize(docs.mapInArrow(suffixes, schema), "suffixes")
    word_bits.unpersist()
    pair_bits.unpersist()
    ranges = max(2 * context.defaultParallelism, -(-pointers.count() // RANGE_ROWS))
    phrases = materialize(
        pointers.repartitionByRange(ranges, *_KEY).mapInArrow(_phrases(least), schema)
        .groupBy(*_KEY).agg(F.sum("n").alias("a")).filter(F.col("a") >= least), "phrases")

    zero = F.lit(0).cast("long")
    known = phrases.withColumnRenamed("a", "f").unionByName(common.select(
        F.col("h").alias("h1"), *(zero.alias(k) for k in _KEY[1:]), F.col("n").alias("f")))
    spelled = common.select("h", "word")
    scored = _scored(_standing(phrases, inside), known).join(
        common.select(F.col("h").alias("h1"), "lang", F.col("word").alias("w1")), "h1")

    # Ranked first within slots, so that no task ranks a whole language's phrases.
    best = [F.desc("score"), F.desc("a")]
    slot = Window.partitionBy("lang", F.pmod(F.xxhash64(*_KEY), F.lit(SLOTS))).orderBy(*best)
    first = scored.withColumn("place", F.rank().over(slot)).filter(F.col("place") <= top)
    for i, key in enumerate(_KEY[1:], 2):
        first = first.join(spelled.select(F.col("h").alias(key), F.col("word").alias(f"w{i}")),
                           key, "left")
    phrase = F.concat_ws(" ", *(f"w{i}" for i in range(1, DEPTH + 1)))
    ranked = first.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*best, "phrase")).cast("long"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    return (ranked.filter(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of every language of the documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_PHRASES = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
runs AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'),
    lambda w: w <> '') AS w FROM pieces),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS p
  FROM runs CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, p, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE m > 1 AND a >= {LEAST}),
cuts AS (SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r,
    2000000::HUGEINT * c.a // (l.a + r.a) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:c.m]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, a, i, j, p[i:j] AS part FROM candidates,
    (SELECT x.i AS i, y.j AS j FROM (SELECT unnest([1, 2, 3]) AS i) x, (SELECT unnest([2, 3, 4]) AS j) y
     WHERE j > i) WHERE j <= m AND j - i + 1 < m),
longest AS (SELECT lang, part AS p, max(a) AS b FROM inner_parts GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN longest USING (lang, p)
  WHERE coalesce(100 * b < {INSIDE} * a, true)),
named AS (SELECT *, array_to_string(p, ' ') AS phrase FROM kept),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM named)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""

QUERIES = {"op12_collocations": op12_collocations}
ORACLE = {"op12_collocations": ORACLE_PHRASES}
