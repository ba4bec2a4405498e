"""Array steps over whole Arrow batches (P11-P13): one strided copy of the child buffers.

The column functions in ``functions.arrays`` build arrays element by element outside
generated code.  Here a batch's bands are taken as flat buffers: bands of equal
lengths interleave as one matrix, whatever the rows' sizes, and rows of one shape are padded
together.  Results and NULL rules are those of the column functions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows handled by one round of numpy work.
ROWS = 1024


def _flat(col: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """``(items of all rows, items per row)``; a NULL row has -1 items."""
    sizes = np.diff(col.offsets.to_numpy()).astype(np.int64)
    sizes[col.is_null().to_numpy(zero_copy_only=False)] = -1
    return col.flatten(), sizes


def _lists(values: pa.Array, sizes: np.ndarray, bad: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.where(bad, 0, sizes))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(bad))


def _items(values: pa.Array, index: np.ndarray | None, width: int) -> np.ndarray:
    flat = values.to_numpy(zero_copy_only=False)
    return (flat if index is None else flat[index]).reshape(-1, width)


def _stacked(parts: list[tuple[pa.Array, np.ndarray, int]]) -> pa.ListArray:
    """The channel-last rows of ``(items, items per row, channels)`` of every part."""
    channels = [c for _, _, c in parts]
    first, pixels = parts[0][1], parts[0][1] // channels[0]
    bad = np.zeros(len(first), bool)
    for _, sizes, c in parts:
        bad |= (sizes < 0) | (sizes % c != 0) | (sizes // c != pixels)
    plain = all(v.null_count == 0 for v, _, _ in parts)
    blocks, places, before = [], [], 0
    for values, sizes, c in parts:
        keep = np.repeat(~bad, np.maximum(sizes, 0))
        index = None if keep.all() else np.flatnonzero(keep)
        if plain:
            blocks.append(_items(values, index, c))
        else:               # items that are NULL stay so: gather by place
            spot = np.arange(len(values)) if index is None else index
            places.append((spot + before).reshape(-1, c))
            before += len(values)
    if plain:
        flat = pa.array(np.concatenate(blocks, axis=1).reshape(-1), parts[0][0].type)
    else:
        flat = pa.concat_arrays([v for v, _, _ in parts]).take(pa.array(np.concatenate(places, axis=1).reshape(-1)))
    return _lists(flat, pixels * sum(channels), bad)


def _array_type(df: DataFrame, names: Sequence[str]) -> T.ArrayType:
    kinds = {df.schema[n].dataType.elementType for n in names}
    if len(kinds) != 1:
        raise ValueError(f"bands of one item type needed, got {sorted(k.simpleString() for k in kinds)}")
    return T.ArrayType(kinds.pop())


def _with_column(df: DataFrame, out: str, kind: T.DataType, make) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, kind)])
    names, given = schema.fieldNames(), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                columns = dict(zip(given, part.columns))
                made = make(columns)
                yield pa.RecordBatch.from_arrays([made if n == out else columns[n] for n in names], names=names)

    return df.mapInArrow(run, schema)


def with_stacked(df: DataFrame, parts: Sequence[str] | Sequence[tuple[str, int]], out: str = "image") -> DataFrame:
    """Add ``out``, the channel-last tensor of bands or of ``(tensor, channels)`` parts.

    NULL where a part is NULL or the parts' pixel counts differ.  Parts have one item type.
    """
    named = [(p, 1) if isinstance(p, str) else (p[0], int(p[1])) for p in parts]
    if not named or any(c < 1 for _, c in named):
        raise ValueError("need at least one part, each of one channel or more")
    kind = _array_type(df, [n for n, _ in named])
    return _with_column(df, out, kind, lambda columns: _stacked([(*_flat(columns[n]), c) for n, c in named]))


def with_padded(df: DataFrame, band: str, height: int | str, width: int | str, target_h: int, target_w: int,
                pad_value: float | int = 0, out: str = "padded") -> DataFrame:
    """Add ``out``, the band padded at the bottom and right to ``(target_h, target_w)``; larger
    axes stay.  ``height`` and ``width`` are numbers or columns; NULL where the band, its
    height or its width is NULL or their product is not its size.
    """
    kind = _array_type(df, [band])

    def size(columns: dict, given: int | str, n: int) -> np.ndarray:
        if isinstance(given, int):
            return np.full(n, given, np.int64)
        return columns[given].fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def make(columns: dict) -> pa.ListArray:
        values, sizes = _flat(columns[band])
        h, w = size(columns, height, len(sizes)), size(columns, width, len(sizes))
        bad = (sizes < 0) | (h < 0) | (w < 0) | (h * w != sizes)
        full_h, full_w = np.maximum(h, target_h), np.maximum(w, target_w)
        total = np.where(bad, 0, full_h * full_w)
        first = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        begin = np.cumsum(total) - total
        # where every item of the result comes from; the last place is the padding
        source = np.full(int(total.sum()), len(values), np.int64)
        shapes = np.stack([h, w], 1)[~bad]
        for sh, sw in np.unique(shapes, axis=0).tolist() if len(shapes) else []:
            rows = np.flatnonzero(~bad & (h == sh) & (w == sw))
            wide = max(sw, target_w)
            inner = (np.arange(sh)[:, None] * wide + np.arange(sw)[None, :]).reshape(-1)
            source[(begin[rows][:, None] + inner).reshape(-1)] = (first[rows][:, None] + np.arange(sh * sw)).reshape(-1)
        items = pa.concat_arrays([values, pa.array([pad_value], values.type)])
        return _lists(items.take(pa.array(source)), total, bad)

    return _with_column(df, out, kind, make)


def with_hot(df: DataFrame, hits: str, size: int, out: str) -> DataFrame:
    """Add ``out``, a 0/1 vector of ``size`` items with ones at the positions in ``hits``; NULL
    where ``hits`` is."""
    def make(columns: dict) -> pa.ListArray:
        values, sizes = _flat(columns[hits])
        bad = sizes < 0
        hot = np.zeros((len(sizes), size), np.int8)
        row = np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))
        hot[row, values.to_numpy(zero_copy_only=False).astype(np.int64)] = 1
        return _lists(pa.array(hot[~bad].reshape(-1)), np.full(len(sizes), size), bad)

    return _with_column(df, out, T.ArrayType(T.ByteType()), make)
