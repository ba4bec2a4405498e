"""Parquet footers as a table (S10, S14): rows, row groups and bytes as they were written.

Tasks open the footers only, so sizes of a dataset cost a few kilobytes a file, and the rows
that make a file of a wanted size come from bytes measured, not from a constant.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterprep.sources.objects import _resolve, list_objects

#: Footers that a task reads, about.
FILES_PER_TASK = 256

_SCHEMA = "path string, row_group int, rows long, compressed long, uncompressed long"


def read_footers(files: DataFrame, path_col: str = "path") -> DataFrame:
    """``(path, row_group, rows, compressed, uncompressed)``: one row per row group of every file
    of ``files``; a file without rows has one row with NULL ``row_group`` and no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        for batch in batches:
            for lo in range(0, batch.num_rows, FILES_PER_TASK):
                rows = []
                for path in batch.column(0).slice(lo, FILES_PER_TASK).to_pylist():
                    filesystem, inner = _resolve(path)
                    with filesystem.open_input_file(inner) as f:
                        meta = pq.read_metadata(f)
                    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                    rows += [(path, i, g.num_rows,
                              sum(g.column(c).total_compressed_size for c in range(g.num_columns)), g.total_byte_size)
                             for i, g in enumerate(groups)] or [(path, None, 0, 0, 0)]
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["path", "row_group", "rows", "compressed", "uncompressed"])

    wanted = files.select(F.col(path_col).alias("path")).where("path IS NOT NULL")
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartition(tasks).mapInArrow(run, _SCHEMA)


def dataset_footers(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_footers` of all Parquet files below ``path``, with their ``split`` (NULL where
    the folder names none)."""
    found = F.regexp_extract("path", r"/split=([^/]*)/", 1)
    return read_footers(list_objects(spark, path, ".parquet")).withColumn(
        "split", F.when(found != "", found))


def sizes(footers: DataFrame, by: str = "split") -> DataFrame:
    """``(split, samples, files, row_groups, compressed_bytes, bytes_per_row)``."""
    return footers.groupBy(by).agg(
        F.sum("rows").alias("samples"), F.countDistinct("path").alias("files"),
        F.count("row_group").alias("row_groups"), F.sum("compressed").alias("compressed_bytes"),
        F.when(F.sum("rows") > 0, F.sum("compressed") / F.sum("rows")).alias("bytes_per_row"))


def bytes_per_row(footers: DataFrame) -> float | None:
    """Compressed bytes that a row takes on average; None without rows."""
    r = footers.agg(F.sum("rows").alias("n"), F.sum("compressed").alias("b")).first()
    return r["b"] / r["n"] if r["n"] else None
