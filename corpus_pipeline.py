"""Corpus pipeline: five stages over the documents, each on all that the one before kept.

1. toxicity        documents the factorization machine rejects go
2. exact           of equal texts (white space aside) the smallest id stays
3. near copies     of each linked group (five-word shingles, Jaccard 0.8) the smallest id stays
4. mix             sources are mixed to their target weights: a document leaves, stays or repeats
5. pieces          every text as vocabulary pieces

Stages 1 to 4 return the columns of ``documents``; the last returns one row per
row of the mix with its pieces. Each stage is written as Parquet and read again
before the next. Null and empty texts pass stage 1 (no term speaks against
them), are equal to each other in stage 2, link with nothing in stage 3, have
size 0 in stage 4 and no pieces in stage 5. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.block_naming import drop_exact_duplicates
from millrace.llm.common import read, written
from millrace.llm.mixing import take_mix
from millrace.llm.ngram_join import keep_one_per_group
from millrace.llm.pieces import encode
from millrace.llm.toxicity import THRESHOLD, fit_toxicity, score_toxicity, training_labels


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the rejection threshold."""
    model = fit_toxicity(docs, training_labels(read(spark, sf_dir, "labels")))
    return score_toxicity(docs, model, out="__toxicity").filter(F.col("__toxicity") < THRESHOLD).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_per_group(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document taken twice is there twice."""
    return take_mix(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_pieces`` and ``pieces`` (vocabulary ids) of every row of the mix."""
    return encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.col("ids").alias("pieces"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("SentencePiece encoding and decoding", pieces_stage),
]

#: Stages 1, 3 and 5 are no SQL: they are tested against brute force and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k + 1}")
    return docs
