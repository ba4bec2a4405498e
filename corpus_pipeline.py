"""A training-data pipeline over ``documents``: five stages, each on what the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes
each result as Parquet below the shared folder and reads it back for the next.  All
stages but the last return the columns of ``documents``; the last returns one row per
packed piece.  A stage hands rows to Python workers some megabytes at a time
(:func:`~rasterprep.llm.common.bounded_batches`).  Null texts count as empty, empty tables give empty results, and rows
without an id are duplicates like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterprep.llm import adaptjoin, fuse, packing, pulearn, zquality
from rasterprep.llm.common import bounded_batches, materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression score is good; labels of the held-out fold are not learned."""
    bounded_batches(spark)
    model = zquality.fit(docs, _labels(spark, sf_dir).where(~zquality.held_out()))
    return zquality.keep_rows(docs, model)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; labels of the held-out fold are not learned."""
    bounded_batches(spark)
    model = pulearn.fit(docs.where(~pulearn.held_out()), _labels(spark, sf_dir).where(~pulearn.held_out()))
    return pulearn.keep_rows(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    bounded_batches(spark)
    return fuse.keep_rows(docs, fuse.exact_dedup(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies (five words, 0.8)."""
    bounded_batches(spark)
    return adaptjoin.near_dedup(docs, width=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' tokens, packed into sequences of at most 2048."""
    bounded_batches(spark)
    # executors come here with the heap of four stages, and a next run's stages follow: a worker
    # remembers fewer words, and none beyond its task
    packed = packing.pack(docs, TOKENIZER, instead_of_ids={"ids_crc32": F.crc32("ids")}, remembered=50_000,
                          keep_words=False)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                         "sequence_id", "offset")


STAGES = [("quality", quality), ("toxicity", toxicity), ("exact_dedup", exact_dedup),
          ("near_dedup", near_dedup), ("pack", pack)]

#: The learned stages, the join's components and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces of what they keep."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
