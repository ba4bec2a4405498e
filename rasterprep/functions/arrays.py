"""Column functions on flat (row-major) pixel arrays.

A raster band is ``array<float>`` (or ``array<int>`` for class maps) plus
``height``/``width`` columns; a multi-band tensor is channel-last (HWC)
flattened to one array.  All functions are higher-order SQL expressions: no
Python runs per row, and NULL marks a row that must be rejected (wrong shape,
code out of range, unknown label).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasterprep import schemas


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_array_literal(values: Sequence[int]) -> Column:
    """A constant ``array<int>``; folded to one literal by the optimizer."""
    return F.array(*[F.lit(int(v)) for v in values])


def remap_classes(px: Column | str, lut: Sequence[int] | None = None) -> Column:
    """P10: per-pixel class code -> dense index through ``lut`` (default: the class table).

    Codes the table does not list (below its size) map to 0; a code outside the
    table, or one that is no whole number, gives a NULL element -- use ``has_null`` to
    reject the row.  ``get`` rather than ``element_at``: the latter raises under ANSI mode.
    """
    values = lut if lut is not None else schemas.class_lut()
    table = int_array_literal(values)
    # the range first: a cast of NaN or of a huge value would raise under ANSI mode
    return F.transform(_col(px), lambda v: F.when(
        (v >= 0) & (v < len(values)), F.when(v.cast("int") == v, F.get(table, v.cast("int")))))


def has_null(arr: Column | str) -> Column:
    """True when any element is NULL (or the array itself is NULL)."""
    return F.coalesce(F.exists(_col(arr), lambda v: v.isNull()), F.lit(True))


def has_fraction(arr: Column | str) -> Column:
    """True when some element is a finite number with a fraction."""
    return F.coalesce(F.exists(_col(arr), lambda v: (F.abs(v) < float("inf")) & (v % 1 != 0)), F.lit(False))


def stack_bands(*bands: Column | str) -> Column:
    """Equal-length bands -> one channel-last array (pixel-major, band-minor).

    Returns NULL when the band lengths differ (``arrays_zip`` would pad with NULL).
    """
    cols = [_col(b) for b in bands]
    if not cols:
        raise ValueError("need at least one band")
    first = cols[0]
    stacked = F.flatten(F.transform(first, lambda x, i: F.array(x, *[F.get(c, i) for c in cols[1:]])))
    same = F.lit(True)
    for c in cols[1:]:
        same = same & (F.size(c) == F.size(first))
    return F.when(same, stacked)


def concat_channels(a: Column | str, a_channels: int, b: Column | str, b_channels: int) -> Column:
    """Concatenate two HWC tensors on the channel axis (pixel counts must agree)."""
    ca, cb = _col(a), _col(b)
    n = F.size(ca) / a_channels
    out = F.flatten(F.transform(
        F.sequence(F.lit(0), (n - 1).cast("int")),
        lambda p: F.concat(F.slice(ca, p * a_channels + 1, a_channels),
                           F.slice(cb, p * b_channels + 1, b_channels))))
    ok = (F.size(ca) % a_channels == 0) & (F.size(cb) * a_channels == F.size(ca) * b_channels) & (n > 0)
    return F.when(ok, out)


def pad_to_size(px: Column | str, height: Column | str | int, width: Column | str | int,
                target_h: int, target_w: int, pad_value: float | int = 0) -> Column:
    """Pad a (h, w) band at the bottom/right to (target_h, target_w); larger axes stay.

    Output shape is ``(max(h, target_h), max(w, target_w))``, flattened row-major.
    """
    arr = _col(px)
    h = F.lit(height) if isinstance(height, int) else _col(height)
    w = F.lit(width) if isinstance(width, int) else _col(width)
    H = F.greatest(h, F.lit(target_h))
    W = F.greatest(w, F.lit(target_w))
    pad = F.lit(pad_value)
    body = F.transform(
        F.sequence(F.lit(0), H * W - 1),
        lambda i: F.when(((i % W) < w) & ((i / W).cast("int") < h),
                         F.get(arr, (i / W).cast("int") * w + i % W)).otherwise(pad))
    return F.when(H * W > 0, body).otherwise(F.array_repeat(pad, 0))


def padded_shape(height: Column | str | int, width: Column | str | int,
                 target_h: int, target_w: int) -> tuple[Column, Column]:
    """Shape after ``pad_to_size``."""
    h = F.lit(height) if isinstance(height, int) else _col(height)
    w = F.lit(width) if isinstance(width, int) else _col(width)
    return F.greatest(h, F.lit(target_h)), F.greatest(w, F.lit(target_w))


def scale_clip(px: Column | str, divisor: float = 3000.0, lo: float = 0.0, hi: float = 1.0) -> Column:
    """P15 per band: ``clip(v / divisor, lo, hi)`` as double."""
    return F.transform(_col(px), lambda v: F.greatest(F.lit(lo), F.least(F.lit(hi), v.cast("double") / F.lit(divisor))))


def display_rgb(red: Column | str, green: Column | str, blue: Column | str,
                divisor: float = 3000.0) -> Column:
    """RGB preview, bands stacked (R, G, B) and scaled to [0, 1]."""
    return scale_clip(stack_bands(red, green, blue), divisor)


def multi_hot(labels: Column | str, vocab: Column) -> Column:
    """0/1 ``tinyint`` vector over ``vocab``; NULL when a label is not in the vocabulary."""
    lab = _col(labels)
    vec = F.transform(vocab, lambda v: F.array_contains(lab, v).cast("tinyint"))
    return F.when(F.size(F.array_except(lab, vocab)) == 0, vec)


def label_preview(labels: Column | str, n: int = 2, sep: str = ", ") -> Column:
    """First ``n`` labels joined by ``sep``."""
    return F.array_join(F.slice(_col(labels), 1, n), sep)


def cast_items(px: Column | str, dtype: str) -> Column:
    """Cast array items (``float``, ``int``, ``tinyint`` ...).

    Under ANSI mode an out-of-range narrowing raises; numpy would wrap instead.
    Remap class codes before narrowing them.
    """
    return _col(px).cast(f"array<{dtype}>")


def shape_ok(px: Column | str, height: Column | str, width: Column | str, channels: int | Column = 1) -> Column:
    """The flat array holds exactly ``height * width * channels`` items."""
    ch = F.lit(channels) if isinstance(channels, int) else channels
    return F.coalesce(F.size(_col(px)) == _col(height) * _col(width) * ch, F.lit(False))


def with_channel_axis(channels: int = 1) -> Column:
    """``(H, W) -> (H, W, 1)``: the flat data is unchanged, only ``channels`` is set."""
    return F.lit(channels)
