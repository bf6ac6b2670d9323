"""The corpus pipeline: STAGES applied to documents one after the other.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the
result is written as Parquet and read again as the next one's docs.  All but the last
return the columns of ``documents``.  Null ids and texts, empty and repeated rows are
allowed in every stage; each says below what becomes of them.  Further columns may have
any name: they come out as they went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import language
from harrow.llm.batches import small_batches
from harrow.llm.decontaminate import find_contamination
from harrow.llm.jaccard import similar_components
from harrow.llm.packing import pack
from harrow.llm.secrets import scan_secrets
from harrow.session import materialize, materialize_last, ship_package

NEAR_SHINGLE, NEAR_PERCENT = 5, 80  # words of a shingle, and similarity of near copies


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all but the used columns under neutral names, and how to name them back."""
    names = [c if c in used else f"column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: a null text, or one without letters.

    The model is learned from the labelled documents that are not held out.
    """
    docs, back = _apart(docs, "doc_id", "text", "lang")
    model = language.corpus_model(docs)
    with small_batches(spark):  # whole rows go through Python, so the stage is worked off here
        found = language.identify(docs, model).filter(F.col("lang_pred") != language.UNDETERMINED)
        return materialize(found.select(*docs.columns), "identified").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of every group of near copies.

    Near copies share NEAR_PERCENT of their shingles of NEAR_SHINGLE words.  Rows are
    told apart by id and text, so of rows that repeat both one stays, and an id that
    stands with several texts is judged for each.  A null id counts as the largest.
    """
    docs, back = _apart(docs, "doc_id", "text")
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    texts = keyed.select(F.col("_key").alias("id"), "text")
    found = materialize_last(lambda: similar_components(texts, NEAR_PERCENT, NEAR_SHINGLE).filter(
        "n_shingles > 0").select(F.col("id").alias("_key"), F.col("component_id").alias("_group"))
        .distinct(), "groups")
    several = found.filter("_key <> _group").select("_group").distinct()
    members = found.join(several, "_group").join(
        keyed.select("_key", "doc_id").distinct(), "_key")
    first = members.groupBy("_group").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key"))["_key"].alias("_first"))
    copies = members.join(first, "_group").filter("_key <> _first").select("_key").distinct()
    kept = keyed.join(copies, "_key", "left_anti").dropDuplicates(["_key", "doc_id", "text"])
    return kept.select(*back)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth of the words stands in the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs, back = _apart(docs, "doc_id", "text")
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    with small_batches(spark):
        found = find_contamination(keyed.select(F.col("_key").alias("id"), "text"), benchmark)
        bad = materialize(found.filter("contaminated").select(F.col("id").alias("_key")).distinct(),
                          "contaminated")
    return keyed.join(bad, "_key", "left_anti").select(*back)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; all documents stay, with their new length."""
    docs, back = _apart(docs, "text", "n_chars")
    found = scan_secrets(docs)
    changed = F.size("secrets") > 0
    found = found.withColumn("n_chars", F.when(changed, F.length("redacted").cast("long"))
                             .otherwise(F.col("n_chars"))).withColumn(
        "text", F.when(changed, F.col("redacted")).otherwise(F.col("text")))
    with small_batches(spark):
        return materialize(found.select(*docs.columns), "scanned").select(*back)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences."""
    with small_batches(spark):
        return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None  # no SQL for these stages; each is tested against a plain version
QUERIES = {"pipeline": run}
ORACLE = {}
