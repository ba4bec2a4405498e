"""Metadata and run-profile sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterprep import schemas


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The patch metadata table; Catalyst prunes the columns a plan does not use."""
    return spark.read.parquet(path)


def read_profiles(spark: SparkSession, root: str, suffix: str = "_profile.json",
                  schema: T.StructType = schemas.PROFILE_SCHEMA) -> DataFrame:
    """Every run-profile JSON under ``root`` as one row, with its ``path``.

    Multi-line JSON under an explicit schema (no inference pass); missing keys
    read as NULL; a file that is not valid JSON becomes a row of NULLs and is
    dropped by the record filters downstream (X10).  :func:`read_profiles_checked` keeps
    those files apart, with their reason.
    """
    return _profile_rows(spark, root, suffix, schema)


def _profile_rows(spark: SparkSession, root: str, suffix: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema)
            .option("multiLine", "true")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{suffix}")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(root)
            .withColumn("path", F.col("_metadata.file_path")))


#: The column that holds a file's text where it does not fit the schema.
CORRUPT = "_corrupt_record"
#: Characters of such a text that a reject keeps.
DETAIL_CHARS = 200


def read_profiles_checked(spark: SparkSession, root: str, suffix: str = "_profile.json",
                          schema: T.StructType = schemas.PROFILE_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """S7 with a quarantine (X10): ``(profiles, rejects)``; every file is in one of the two.

    Rejects are ``(path, reason, detail)``: ``malformed`` for text that is no JSON object of the
    schema (``detail`` starts with it), ``no_steps`` and ``no_summary`` for profiles without
    what every record is made from.  A file with several documents has a row for each.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = _profile_rows(spark, root, suffix, whole)
    reason = (F.when(F.col(CORRUPT).isNotNull(), "malformed")
              .when(F.coalesce(F.size("steps"), F.lit(-1)) <= 0, "no_steps")
              .when(F.col("summary").isNull(), "no_summary"))
    judged = rows.withColumn("reason", reason)
    good = judged.where("reason IS NULL").drop("reason", CORRUPT)
    rejects = judged.where("reason IS NOT NULL").select(
        "path", "reason", F.substring(CORRUPT, 1, DETAIL_CHARS).alias("detail"))
    return good, rejects


def profile_logs(profiles: DataFrame) -> DataFrame:
    """One row per log message: ``(path, timestamp, ts, message, cpu_percent, ...)``."""
    return (profiles.select("path", F.explode("logs").alias("log"))
            .select("path",
                    F.col("log.timestamp").alias("timestamp"),
                    F.try_to_timestamp(F.col("log.timestamp")).alias("ts"),
                    F.col("log.message").alias("message"),
                    F.col("log.usage.cpu_percent").alias("cpu_percent"),
                    F.col("log.usage.ram_percent").alias("ram_percent"),
                    F.col("log.usage.ram_used_gb").alias("ram_used_gb")))
