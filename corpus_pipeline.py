"""The training-data pipeline: documents to sampled token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of ``documents``.  The order is
language identification, fuzzy line dedup, near-duplicate removal, benchmark
decontamination, and sampled SentencePiece segmentation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weatherlake.llm.contamination import find_contamination
from weatherlake.llm.language import UNKNOWN, fit_language_model, identify_language
from weatherlake.llm.lines import dedup_lines
from weatherlake.llm.near_dups import near_duplicates
from weatherlake.llm.pieces import sample_segmentations
from weatherlake.llm.shared import cut, fresh, modest_batches, stored, table

#: No stage but the near-duplicates has SQL; the tests check the stages against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the labelled ones among them show.

    Rejected are null texts, texts without a letter, and texts that have
    nothing in common with any learned language (every one is equally likely).
    """
    modest_batches(spark)
    model = fit_language_model(docs)
    even = 1.02 / max(len(model.languages), 1) if len(model.languages) > 1 else 0.0
    own = dict(zip(("lang_pred", "score"), fresh(docs, "lang_pred", "score"), strict=True))  # where docs has such columns
    told = identify_language(docs.withColumnsRenamed(own), model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= even))
    back = [F.col(own.get(c, c)).alias(c) for c in docs.columns]
    return told.select(*back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated lines.  A document that has lost lines and has no
    letter or digit left goes; ``n_chars`` is counted anew.

    Null and empty texts stay as they are.  A null id counts as the first.
    Rows that repeat id and text keep the same lines (the next stage leaves one of them).
    """
    modest_batches(spark)
    removed, = fresh(docs, "lines_removed")
    rest = dedup_lines(docs.withColumnRenamed("lines_removed", removed)).filter((F.col("lines_removed") == 0) | F.col("text").rlike(r"[\p{L}\p{N}]"))
    rest = rest.drop("lines_removed").withColumnRenamed(removed, "lines_removed")
    return rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a key of their own: rows are one document only if id and
    text are equal, so that neither a null id nor one that repeats decides
    over other rows."""
    key, = fresh(docs, "_row")
    return docs.withColumn(key, F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull())), key


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id (a null one first), of every group of near
    duplicates (shingles of five words, similarity 0.8).

    Of rows that repeat id and text one stays.  Rows that share an id but not
    the text are different documents.  Texts without words are nobody's duplicates.
    """
    modest_batches(spark)
    keyed, key = _keyed(docs)
    again = cut(keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key))
    if not again.isEmpty():
        once = keyed.join(again, key, "left_semi").dropDuplicates([key])
        keyed = keyed.join(again, key, "left_anti").unionByName(once)
    near = near_duplicates(keyed.select(key, "text"), id=key).select(F.col("doc_id").alias(key), F.col("component_id").alias("group")).distinct()
    groups = near.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("group")
    members = cut(near.join(groups, "group").join(keyed.select(key, "doc_id").distinct(), key))
    first = members.groupBy("group").agg(F.min(F.struct("doc_id", key)).alias("f")).select(F.col(f"f.{key}").alias(key))
    gone = members.select(key).join(first, key, "left_anti")
    return keyed.join(gone, key, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that share no passage with the benchmark.  Decided for
    each text by itself, whatever its id; null and empty texts share none."""
    modest_batches(spark)
    keyed, key = _keyed(docs)
    leaks = find_contamination(keyed.select(key, "text"), table(spark, sf_dir, "benchmark"), id=key).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(leaks, key, "left_anti").select(*docs.columns)


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document that is left; rows that
    repeat have one each, an empty text has an empty one, a null text a null list."""
    modest_batches(spark)
    return sample_segmentations(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", F.size("samples").alias("n_samples"), "samples", "round_trip")


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("segmentation", segmentation),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
