"""The registered corpus queries and the pipeline on the smallest tables."""

import pyarrow as pa
import pytest

import corpus_pipeline
from rasterprep.llm import queries
from rasterprep.llm.common import ARROW_BYTES, BATCH_BYTES, bounded_batches

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                         "near_next"],
    "op2_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op5_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op6_quality": ["doc_id", "held_out", "score", "predicted"],
    "op7_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op12_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"],
    "op13_mixing": ["doc_id", "size", "source_size", "target", "taken"],
}
#: Queries whose rows are no documents.
OTHERS = {"op11_hard_negatives"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_every_document_is_in_the_result(spark, name):
    docs = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    df = queries.QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name]
    got = [r["doc_id"] for r in df.select("doc_id").collect()]
    assert set(got) == docs and (name == "op4_packing" or len(got) == len(docs))


def test_all_queries_are_covered():
    assert set(queries.QUERIES) == set(COLUMNS) | OTHERS and set(queries.SQL) <= set(queries.QUERIES)


def test_stages_only_remove_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        left = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert left and len(left) == len(set(left)) and set(left) <= ids
        ids = set(left)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_workers_get_whole_texts_some_megabytes_at_a_time(spark):
    docs = spark.range(300, numPartitions=1).selectExpr("id AS doc_id", "repeat(cast(id % 10 as string), 100000) AS text")

    def measure(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    before = spark.conf.get(ARROW_BYTES, None)
    try:
        spark.conf.set(ARROW_BYTES, "1234567")
        bounded_batches(spark)
        assert spark.conf.get(ARROW_BYTES) == "1234567"          # the session's own limit stays
        spark.conf.unset(ARROW_BYTES)
        corpus_pipeline.pack(spark, docs.where("false"), SF)
        got = docs.mapInArrow(measure, "n long, bytes long").collect()
        assert sum(r["n"] for r in got) == 300 and max(r["bytes"] for r in got) < 2 * BATCH_BYTES
    finally:
        spark.conf.unset(ARROW_BYTES)
        if before is not None:
            spark.conf.set(ARROW_BYTES, before)
