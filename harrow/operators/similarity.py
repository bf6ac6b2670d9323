"""Cosine similarity of two text collections by an inverted index.

Every record is a vector of TF-IDF weights (share of the word in the record
times records / records holding the word) over the joint collection.  Nothing
here lists all pairs of a collection:

* copies of a text are worked on once, as a representative with a count;
* pairs are listed from a similarity above zero upwards.  The largest weight that a word
  has on the other side bounds what it can add to any pair.  A record's most common words
  are left out of the index as long as their bounds cannot bring a pair to that
  similarity; a pair that falls short even with the bounds of what is left out is dropped
  as soon as it is summed up, and to the others the words left out are added, so the list
  is exact;
* totals over all pairs come from sums per word.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.operators.skew import blocks, join_pairs, slot_of
from harrow.operators.weights import term_counts, text_parts
from harrow.session import discard, materialize, materialize_last, small_parts, together

DIGITS = 6             # similarities are rounded to this many places
ROUNDING = 1e-6        # and the index is built for a bar this much lower
BITS = 32_768          # bits of one bitmap
BUCKET_RECORDS = BITS // 2
SINGLE_SLOTS = 1_024   # tasks that share the pairs of texts with one record
SLICES = 8             # of the records at most, indexed one after the other
SLICE_PARTS = 8        # parts of the texts in a slice at least
DENSE_RECORDS = 128    # records per bucket from which a word gets bitmaps


@dataclass(frozen=True)
class PairIndex:
    """Tables behind the pair operators; ``a`` and ``b`` are the two sides.

    ``records``: (side, id, text, copies), one row per record; ``text`` is the id
    of the record that stands for all ``copies`` of its text.
    ``words``: (side, text, copies, token, unit, indexed, rest, n_a, n_b), the words
    found on both sides; ``unit`` is the weight in the vector scaled to length
    one, ``indexed`` says whether the word can lead to a pair of at least
    ``min_similarity``, and ``rest`` bounds what the record's other words add to a pair.
    """

    records: DataFrame
    words: DataFrame
    min_similarity: float
    parts: int = 1   # of a few megabytes of text that the collection makes

    def side(self, side: str, *columns: str | Column) -> DataFrame:
        return self.words.filter(F.col("side") == side).select(*columns)


def build_index(left: DataFrame, right: DataFrame, stop_words: Sequence[str] = (),
                min_similarity: float = 0.01) -> PairIndex:
    """Index two tables of (id, text) with ids unique on each side."""
    if not 0 < min_similarity <= 1:
        raise ValueError("min_similarity must lie in (0, 1]")
    both = (left.select(F.lit("a").alias("side"), "id", "text")
            .unionByName(right.select(F.lit("b").alias("side"), "id", "text")))
    # Sorts, counts and shuffles of a task stay as small as its part of the texts.
    parts = text_parts(both)
    with small_parts(both.sparkSession, -(-parts // 2)):
        return _index_of(both, stop_words, min_similarity, parts)


def _index_of(both: DataFrame, stop_words: Sequence[str], min_similarity: float,
              parts: int) -> PairIndex:
    """The index of (side, id, text); all its tables are written when it returns."""
    keyed = materialize(both.select("side", "id", F.sha2("text", 256).alias("key")), "keyed")
    texts = materialize(keyed.groupBy("side", "key")
                        .agg(F.min("id").alias("text"), F.count("*").alias("copies")), "texts")
    records = materialize(keyed.join(texts, ["side", "key"]).drop("key"), "records")
    # All words of a record are in one slice.
    slices = max(1, min(SLICES, parts // SLICE_PARTS))
    slice_parts = -(-parts // slices)
    slice_of = F.pmod(F.xxhash64("side", "id"), F.lit(slices))

    standing = texts.select("side", F.col("text").alias("id"), "copies")

    def counted(k: int) -> DataFrame:
        # Keys in another order than below, where Spark would else deal the texts by these parts.
        distinct = both.filter(slice_of == k).join(standing.filter(slice_of == k), ["id", "side"])
        return term_counts(distinct, stop_words, keep=["copies"], key=["side", "id"],
                           sized=False, parts=slice_parts)

    counts = [materialize(counted(k), "counts") for k in range(slices)]
    discard(keyed, texts)

    def rows_of(side: str) -> Column:
        return F.count_if(F.col("side") == side)

    words = materialize_last(lambda: together(counts).groupBy("token").agg(
        F.sum("copies").alias("df"), rows_of("a").alias("n_a"), rows_of("b").alias("n_b")), "words")
    own = Window.partitionBy("id", "side")
    unit = F.col("weight") / F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(own))

    def scaled(counts: DataFrame) -> DataFrame:
        # The sizes of the record and of the collection cancel out of a unit vector.  The
        # words are held and the counts stream by; a merge would sort all counts.
        weighted = (counts.join(words.hint("shuffle_hash"), "token")
                    .withColumn("weight", F.col("n") / F.col("df")).drop("n")
                    .repartition(slice_parts, "id", "side"))
        return (weighted.withColumn("unit", unit).filter((F.col("n_a") > 0) & (F.col("n_b") > 0))
                .select("side", "id", "copies", "token", "unit", "df", "n_a", "n_b"))

    units = []
    for of_slice in counts:
        units.append(materialize(scaled(of_slice), "units"))
        discard(of_slice)
    discard(words)

    def heaviest(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("unit"))).alias(f"most_{side}")

    bounds = materialize_last(
        lambda: together(units).groupBy("token").agg(heaviest("a"), heaviest("b")), "bounds")
    most = F.when(F.col("side") == "a", F.col("most_b")).otherwise(F.col("most_a"))

    # What a record's commonest words add to a pair is at most their combined length, and at
    # most the sum of their weights times the heaviest on the other side.  Sorting is
    # fastest with the most telling column in front.
    ordered = own.orderBy(F.desc("df"), "token")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.sqrt(F.sum(F.col("unit") * F.col("unit")).over(so_far))
    bound = F.least(length, F.sum(F.col("unit") * most).over(so_far))
    left_out = F.col("bound") <= _left_out(min_similarity)
    record = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.coalesce(F.max(F.when(left_out, F.col("bound"))).over(record), F.lit(0.0))

    def bounded(units: DataFrame) -> DataFrame:
        rows = (units.join(bounds.hint("shuffle_hash"), "token")
                .repartition(slice_parts, "id", "side"))
        return rows.withColumn("bound", bound).select(
            "side", F.col("id").alias("text"), "copies", "token", "unit",
            (~left_out).alias("indexed"), rest.alias("rest"), "n_a", "n_b")

    index = []
    for of_slice in units:
        index.append(materialize(bounded(of_slice), "index"))
        discard(of_slice)
    discard(bounds)
    return PairIndex(records, together(index), min_similarity, parts)


def _left_out(min_similarity: float) -> float:
    """The most that a record's words left out of the index may add to a pair.

    A pair at the bar has at most half of it from the words either side left out, so
    some of it comes from words that both have in the index.
    """
    return 0.49 * (min_similarity - ROUNDING)


def _words(index: PairIndex, side: str) -> DataFrame:
    return index.side(side, F.col("text").alias(f"text_{side}"), "token",
                      F.col("unit").alias(f"unit_{side}"),
                      F.col("indexed").alias(f"indexed_{side}"))


def _shared_words(index: PairIndex, text_pairs: DataFrame) -> DataFrame:
    """The rows of ``text_pairs`` once per word that both texts have.

    Adds (token, unit_a, unit_b): the words of b, then their weights in a.
    """
    return (text_pairs.join(_words(index, "b"), "text_b")
            .join(_words(index, "a"), ["text_a", "token"]))


def _left_out_words(index: PairIndex, text_pairs: DataFrame) -> DataFrame:
    """``_shared_words`` of the words that are not in the index on both sides."""
    a, b = _words(index, "a"), _words(index, "b")
    of_a = text_pairs.join(a.filter("not indexed_a"), "text_a").join(b, ["text_b", "token"])
    of_b = (text_pairs.join(b.filter("not indexed_b"), "text_b")
            .join(a.filter("indexed_a"), ["text_a", "token"]))
    return of_a.unionByName(of_b)


def _cosine(digits: int | None = DIGITS) -> Column:
    dot = F.sum(F.col("unit_a") * F.col("unit_b"))
    return (dot if digits is None else F.round(dot, digits)).alias("similarity")


def _similar_texts(index: PairIndex) -> DataFrame:
    """(text_a, text_b, copies_a, copies_b, similarity) at or above the bar."""
    def indexed(side: str) -> DataFrame:
        return (index.side(side, "token", "n_a", "n_b", F.col("text").alias(f"text_{side}"),
                           F.col("copies").alias(f"copies_{side}"),
                           F.col("rest").alias(f"rest_{side}"),
                           F.col("unit").alias(f"unit_{side}"), "indexed")
                .filter("indexed").drop("indexed"))

    key = ["text_a", "text_b", "copies_a", "copies_b"]
    met = join_pairs(indexed("a"), indexed("b"), ["token", "n_a", "n_b"],
                     ["text_a"], ["text_b"], "n_a", "n_b")
    # What the index has seen of a pair is kept, unless all that can still come is too
    # little; only the words left out are added.
    parts = met.groupBy(*key, "rest_a", "rest_b").agg(
        F.sum(F.col("unit_a") * F.col("unit_b")).alias("part"))
    most = F.col("part") + F.col("rest_a") + F.col("rest_b")
    with small_parts(index.words.sparkSession, -(-index.parts // 2)):
        seen = materialize(parts.filter(most >= index.min_similarity - ROUNDING)
                           .select(*key, "part"), "seen")
    rest = _left_out_words(index, seen.select(*key)).select(
        *key, (F.col("unit_a") * F.col("unit_b")).alias("part"))
    scored = (seen.unionByName(rest).groupBy(*key)
              .agg(F.round(F.sum("part"), DIGITS).alias("similarity")))
    return scored.filter(F.col("similarity") >= index.min_similarity)


def _with_copies(pairs: DataFrame, index: PairIndex, side: str) -> DataFrame:
    """Replace the text of a side by each record that has it, as ``id_a`` or ``id_b``."""
    text, copies = f"text_{side}", f"copies_{side}"
    partner = next(c for c in pairs.columns if c in (
        ("text_b", "id_b") if side == "a" else ("text_a", "id_a")))
    members = index.records.filter((F.col("side") == side) & (F.col("copies") > 1)).select(
        F.col("text").alias("_text"), F.col("id").alias("_member"),
        slot_of(["id"], blocks("copies")).alias("_slot"))
    # A text with a single record meets nothing; negative slots spread its pairs.
    slots = F.when(F.col(copies) > 1, F.sequence(F.lit(0), blocks(copies) - 1)).otherwise(
        F.array(-1 - slot_of([partner], F.lit(SINGLE_SLOTS))))
    spread = pairs.withColumn("_slot", F.explode(slots))
    joined = spread.join(members, (F.col(text) == F.col("_text"))
                         & (spread["_slot"] == members["_slot"]), "left")
    # A slot may hold no member; the pair then comes from the other slots.
    joined = joined.filter((F.col(copies) == 1) | F.col("_member").isNotNull())
    keep = [F.col(c) for c in pairs.columns if c not in (text, copies)]
    return joined.select(F.coalesce("_member", text).alias(f"id_{side}"), *keep)


def similar_pairs(index: PairIndex) -> DataFrame:
    """(id_a, id_b, similarity) of every pair at or above ``min_similarity``."""
    pairs = _similar_texts(index)
    return (_with_copies(_with_copies(pairs, index, "a"), index, "b")
            .select("id_a", "id_b", "similarity"))


def similar_pair_bins(index: PairIndex) -> DataFrame:
    """(bin, n_pairs) of the pairs at or above the bar, copies counted."""
    return (_similar_texts(index).groupBy(similarity_bin().alias("bin"))
            .agg(F.sum(F.col("copies_a") * F.col("copies_b")).alias("n_pairs")))


def similarity_bin(similarity: Column | str = "similarity") -> Column:
    """Hundredths of the similarity, cut off."""
    similarity = F.col(similarity) if isinstance(similarity, str) else similarity
    return F.floor(similarity * F.lit(100.0)).cast("int")


def _per_pair(index: PairIndex, pairs: DataFrame, *results: Column) -> DataFrame:
    """Aggregate the shared words of each given pair; equal texts are worked on once."""
    pairs = pairs.select("id_a", "id_b")
    for side in ("a", "b"):
        texts = index.records.filter(F.col("side") == side).select(
            F.col("id").alias(f"id_{side}"), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(texts, f"id_{side}")
    pairs = materialize(pairs, "pairs")
    key = ["text_a", "text_b"]
    found = _shared_words(index, pairs.select(*key).distinct()).groupBy(*key).agg(*results)
    return pairs.join(found, key).drop(*key)


def pair_similarity(index: PairIndex, pairs: DataFrame,
                    digits: int | None = DIGITS) -> DataFrame:
    """Similarity of given pairs, whatever its size; pairs sharing no word are left out."""
    return _per_pair(index, pairs, _cosine(digits))


def common_tokens(index: PairIndex, pairs: DataFrame) -> DataFrame:
    """(id_a, id_b, n_common, tokens): the words each given pair shares, sorted."""
    return _per_pair(index, pairs, F.count("*").alias("n_common"),
                     F.sort_array(F.collect_list("token")).alias("tokens"))


def all_pairs_summary(index: PairIndex) -> DataFrame:
    """Count, total and mean similarity over every pair of the two sides.

    The total is a sum over words of (sum over a) x (sum over b), so no pair is
    formed.  Pairs without a common word count with similarity zero.
    """
    def total(side: str) -> Column:
        mine = F.when(F.col("side") == side, F.col("unit") * F.col("copies"))
        return F.coalesce(F.sum(mine), F.lit(0.0)).alias(side)

    per_word = index.words.groupBy("token").agg(total("a"), total("b"))
    similarity = F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0.0))
    sums = per_word.agg(similarity.alias("sum_similarity"))
    sides = index.records.agg(F.count_if(F.col("side") == "a").alias("n_a"),
                              F.count_if(F.col("side") == "b").alias("n_b"))
    n_pairs = sides.select(F.col("n_a") * F.col("n_b")).scalar()
    return sums.select(n_pairs.alias("n_pairs"), "sum_similarity",
                       F.try_divide("sum_similarity", n_pairs).alias("mean_similarity"))


def overlapping_pair_count(index: PairIndex) -> DataFrame:
    """(n_pairs): pairs of records with at least one word in common, exactly.

    The texts of side a are dealt into buckets of equal ``copies``, one bit per
    text.  A common word carries one bitmap per bucket, a rare word single bits;
    each text of side b takes the union of its words' bits in every bucket.
    """
    a_texts = index.side("a", "text", "copies").distinct()
    n_buckets = a_texts.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / BUCKET_RECORDS))).scalar()
    dealt = a_texts.withColumn("group", F.pmod(F.xxhash64("text"), n_buckets))
    place = F.row_number().over(Window.partitionBy("copies", "group").orderBy("text")) - 1
    bits = dealt.withColumn("place", place).select(
        "text", F.struct(F.col("copies").alias("copies"), "group",
                       F.floor(F.col("place") / BITS).alias("block")).alias("bucket"),
        (F.col("place") % BITS).cast("bigint").alias("bit"))
    a_words = index.side("a", "text", "token", "n_a", "n_b").join(bits, "text").drop("text")
    b_words = index.side("b", F.col("text").alias("text_b"), F.col("copies").alias("copies_b"),
                         "token", "n_a", "n_b")
    keys = ["token", "n_a", "n_b"]
    dense = F.col("n_a") >= n_buckets * DENSE_RECORDS

    bitmaps = (a_words.filter(dense).groupBy(*keys, "bucket")
               .agg(F.bitmap_construct_agg("bit").alias("bits")))
    # No word has more buckets than it has records.
    from_bitmaps = join_pairs(bitmaps, b_words.filter(dense), keys, ["bucket"], ["text_b"],
                              F.col("n_a") / DENSE_RECORDS, "n_b").select(
        "text_b", "copies_b", "bucket", "bits")
    from_bits = (join_pairs(a_words.filter(~dense), b_words.filter(~dense), keys,
                            ["bucket", "bit"], ["text_b"], "n_a", "n_b")
                 .groupBy("text_b", "copies_b", "bucket")
                 .agg(F.bitmap_construct_agg("bit").alias("bits")))
    unions = (from_bitmaps.unionByName(from_bits).groupBy("text_b", "copies_b", "bucket")
              .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")))
    return unions.agg(F.coalesce(
        F.sum(F.col("n") * F.col("bucket.copies") * F.col("copies_b")),
        F.lit(0)).alias("n_pairs"))
