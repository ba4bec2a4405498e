"""Per-pixel evaluation metrics over a predictions table.

Each sample is counted once (a single pass over the table, not a repeating
feed).  Per-row sums are computed with ``aggregate`` over the pixel arrays and
then summed with partial aggregation, so no pixel is exploded into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pixel_accuracy(df: DataFrame, pred: str | Column = "pred", label: str | Column = "label",
                   out: str = "pixel_accuracy") -> DataFrame:
    """Share of pixels whose predicted class equals the label, over all rows."""
    eq = F.zip_with(_col(pred), _col(label), lambda p, t: (p == t).cast("long"))
    per_row = F.aggregate(eq, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return df.agg((F.sum(per_row) / F.sum(F.size(_col(label)))).alias(out))


def pixel_log_loss(df: DataFrame, prob_true: str | Column, eps: float = 1e-7,
                   out: str = "pixel_log_loss") -> DataFrame:
    """A10: mean of ``-ln(max(p, eps))`` where ``p`` is the probability given to the true class."""
    terms = F.transform(_col(prob_true),
                        lambda p: -F.ln(F.greatest(p.cast("double"), F.lit(float(eps)))))
    per_row = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return df.agg((F.sum(per_row) / F.sum(F.size(_col(prob_true)))).alias(out))
