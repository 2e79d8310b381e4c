"""The corpus pipeline: five stages that turn documents into packed training sequences.

Each stage is a function of (spark, docs, sf_dir); docs is what the stage before kept, with the columns of `documents`. The last stage
returns the pieces of the sequences. A stage that changes a text brings n_chars up to date.

Defined results: rows whose text is null or has no word don't get past the first stage, nor past a stage that leaves them without a
word; rows without doc_id are judged by their text alone and are nobody's copy; of repeated rows one stays after the third stage; an
empty table stays empty; columns of any other name stay as they are up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm import jaccard, line_dedup, packing, quality, suffix_dedup
from tractlake.llm.common import shared_dir, small_batches, table

#: The first stage's verdicts come from a fitted model, which SQL can't express.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the line labelling go, null and empty texts among them."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit_on(docs, table(spark, sf_dir, "labels")))


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines and of long repeated lines go; documents stay, unless no word is left of them."""
    small_batches(spark)
    return _counted(line_dedup.remove_repeats(docs, min_words=line_dedup.MIN_WORDS)).where(F.col("text").rlike(line_dedup.A_WORD))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id, once; documents without words or doc_id stay too."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def byte_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that a repeated 50-byte string covers go; documents stay, unless no word is left of them."""
    small_batches(spark)
    return _counted(suffix_dedup.remove_repeats(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_repeats),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", byte_repeats),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each one's result written as Parquet in the shared folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
