"""The registered corpus queries: each applies one operator to its whole table.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds the
DuckDB equivalent where SQL can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from rasterprep.llm import (adaptjoin, dac, fuse, iblt, langid, merges, mixing, packing, pulearn, recompress,
                            scan_bpe, threshold, zquality)
from rasterprep.llm.common import id_crc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and its edited text, and how alike they are."""
    return iblt.fingerprints(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to and read from a file of directly addressable codes."""
    got = dac.write_and_read(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return got.select(F.col("id").alias("doc_id"), "start",
                      (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.identify(docs, model).select(
        F.col("id").alias("doc_id"), langid.held_out("id").alias("held_out"), "lang_pred", "score")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens packed into sequences of at most 2048."""
    got = packing.pack(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                       instead_of_ids={"ids_crc32": F.crc32("ids")})
    return got.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                      "sequence_id", "offset")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level token counts of every document."""
    got = merges.token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.PATTERN)
    return got.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > 1024).alias("over_limit"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    docs, labels = _documents(spark, sf_dir), _table(spark, sf_dir, "labels")
    model = zquality.fit(docs, labels.where(~zquality.held_out()))
    return zquality.score(docs, model).select(
        F.col("id").alias("doc_id"), zquality.held_out("id").alias("held_out"), "score",
        (F.col("score") >= zquality.GOOD).cast("int").alias("predicted"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents`` after whitespace is normalised."""
    got = fuse.exact_dedup(_documents(spark, sf_dir))
    return got.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.col("sha").alias("text_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    docs, labels = _documents(spark, sf_dir), _table(spark, sf_dir, "labels")
    model = pulearn.fit(docs.where(~pulearn.held_out()), labels.where(~pulearn.held_out()))
    return pulearn.score(docs, model).select(
        F.col("id").alias("doc_id"), pulearn.held_out("id").alias("held_out"), "score",
        (F.col("score") >= pulearn.TOXIC).cast("int").alias("predicted"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's byte-level ids and of their decoded bytes."""
    got = scan_bpe.round_trip_digests(_documents(spark, sf_dir),
                                      public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return got.withColumnRenamed("id", "doc_id")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85% of their 4-word shingles."""
    got = adaptjoin.near_components(_documents(spark, sf_dir), width=4, percent=85)
    return got.withColumnRenamed("id", "doc_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor's positives among all embeddings."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return threshold.hard_negatives(_table(spark, sf_dir, "embeddings"), every=50, label=label)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts with the contract's repeats: where the id's hash ends with 0, the words from
    some place on repeat the first few of them."""
    words = docs.withColumn("h", id_crc()).withColumn("g", F.expr("h div 10")).withColumn("words", F.when(
        F.col("h") % 10 == 0, F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")))
    placed = words.withColumn("n", F.size("words").cast("long")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    planted = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[cast(if(i < a, i, "
                     "a + (i - a) % (1 + (n - a) div (3 + g % 8))) as int)]), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and its text without the repeats."""
    got = recompress.periodic_runs(with_planted_runs(_documents(spark, sf_dir)))
    best = got.withColumn("best", recompress.longest_run())
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return best.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of sources by weight takes."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed_counts(docs).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_token_files": op2_token_files,
    "op3_language_id": op3_language_id,
    "op4_packing": op4_packing,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_join": op10_ngram_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_mixing": op13_mixing,
}

SQL = {
    "op7_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        pairs AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
                   CAST(list_sum([a.e[i] * b.e[i] for i in range(1, len(a.e) + 1)]) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        ranked AS (
            SELECT p.anchor_id, p.positive_id, n.id AS negative_id, p.positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS rank
            FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
              AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 3""",
}
