"""Image-level label lists: vocabulary, index lookup, multi-hot.

The vocabulary is the distinct label set with its sorted index.  Labels find their
index by an equi-join (AQE broadcasts the vocabulary when its measured size is small);
per row only the row's own indices are gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.functions import arrays as A
from rasterprep.operators import kernels as K
from rasterprep.operators.ranking import ordered_index


def distinct_labels(df: DataFrame, labels_col: str = "labels") -> DataFrame:
    """Set union of all label lists, one ``label`` per row."""
    return (df.select(F.explode(labels_col).alias("label"))
            .where(F.col("label").isNotNull()).distinct())


def label_vocab(df: DataFrame, labels_col: str = "labels") -> DataFrame:
    """Sorted distinct labels (binary code-point order) numbered from 0: ``(label, idx)``.

    Labels are ranked within ranges of their order (``ranking.ordered_index``), so no task sorts
    the whole domain, however large it is.
    """
    return ordered_index(distinct_labels(df, labels_col), "label")


def label_index_lookup(df: DataFrame, vocab: DataFrame, id_col: str,
                       labels_col: str = "labels") -> DataFrame:
    """``(id, label, idx)`` for every label of every row; unknown labels get ``idx`` NULL."""
    exploded = df.select(id_col, F.explode(labels_col).alias("label"))
    return exploded.join(vocab, "label", "left").select(id_col, "label", "idx")


def _row_indices(df: DataFrame, vocab: DataFrame, id_cols: Sequence[str], labels_col: str) -> DataFrame:
    """Per id: the indices of its labels and the labels that the vocabulary lacks.

    ``id_cols`` identify a row, so a group holds one row's own labels.
    """
    exploded = df.select(*id_cols, F.explode(labels_col).alias("label")).where(F.col("label").isNotNull())
    return (exploded.join(vocab, "label", "left").groupBy(*id_cols)
            .agg(F.collect_set("idx").alias("__hits"),
                 F.collect_set(F.when(F.col("idx").isNull(), F.col("label"))).alias("__unknown")))


#: Labels of a vocabulary that rows look up by themselves; beyond, labels are joined.
SMALL_VOCAB = 256


def with_multi_hot(df: DataFrame, vocab: DataFrame, id_cols: str | Sequence[str],
                   labels_col: str = "labels", out: str = "multi_hot",
                   small_vocab: int = SMALL_VOCAB) -> DataFrame:
    """Add a 0/1 vector over the sorted vocabulary; NULL for rows with an unknown label.

    ``id_cols`` identify a row.  A NULL list gives NULL, an empty list all zeros; NULL labels
    count for nothing.  A vocabulary of at most ``small_vocab`` labels (looked at now) is a
    constant that every row is checked against, without a shuffle.  A larger one is joined
    label by label; a row's own positions are gathered and expanded once, in numpy.
    """
    first = vocab.select("label", "idx").limit(small_vocab + 1).collect()
    if len(first) <= small_vocab:
        known = [r["label"] for r in sorted(first, key=lambda r: r["idx"])]
        words = F.array(*[F.lit(w) for w in known]).cast(df.schema[labels_col].dataType)
        return df.withColumn(out, A.multi_hot(F.array_compact(labels_col), words))
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    found = _row_indices(df, vocab, ids, labels_col)
    found = found.select(*[F.col(c).alias(f"__id{i}") for i, c in enumerate(ids)], "__hits", "__unknown")
    same = F.lit(True)
    for i, c in enumerate(ids):
        same = same & F.col(c).eqNullSafe(F.col(f"__id{i}"))
    known = F.col(labels_col).isNotNull() & (F.coalesce(F.size("__unknown"), F.lit(0)) <= 0)
    hits = F.when(known, F.coalesce("__hits", F.array().cast("array<bigint>")))
    joined = df.join(found, same, "left").select(*df.columns, hits.alias("__at"))
    return K.with_hot(joined, "__at", vocab.count(), out).drop("__at")


def multi_hot_rejects(df: DataFrame, vocab: DataFrame, id_col: str,
                      labels_col: str = "labels") -> DataFrame:
    """P14 rejects: rows holding a label outside the vocabulary, as ``(id, reason, detail)``."""
    found = _row_indices(df, vocab, [id_col], labels_col)
    return (found.where(F.size("__unknown") > 0)
            .select(id_col, F.lit("unknown_label").alias("reason"),
                    F.array_join(F.array_sort("__unknown"), ",").alias("detail")))
