"""F1 as the loader does it: a shuffle through a bounded buffer.

The buffer fills with a shard's first rows; from then on every row that comes in takes the
place of a row drawn at random, which goes out; at the end what is left goes out in random
order.  Memory is bounded by the buffer whatever the shard's size.  The draws depend on the
seed, the epoch and the shard alone, so a repeated task gives the same order.  The global
shuffle (``feed.epoch_shuffle``) stays the default; this one follows it, or takes its place
where rows are read in the order of their files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that the buffer holds.
BUFFER_ROWS = 2000


def shard_draws(seed: int, epoch: int, shard: int) -> np.random.Generator:
    """The random draws of one shard in one epoch."""
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([seed & (1 << 64) - 1, epoch, shard & (1 << 64) - 1])))


class ShuffleBuffer:
    """A bounded buffer over Arrow batches; :meth:`push` a batch, :meth:`drain` at the end.

    A batch is handled at once: the row that goes out for the t-th row coming in is the one
    that its slot held, which is the last row put there, by an earlier row of the batch or
    before it.
    """

    def __init__(self, draws: np.random.Generator, size: int = BUFFER_ROWS):
        if size < 1:
            raise ValueError("the buffer needs a row at least")
        self.draws, self.size = draws, size
        self.held: pa.Table | None = None

    def push(self, batch: pa.RecordBatch | pa.Table) -> pa.Table | None:
        """Take rows in; returns the rows that go out, in order, if any."""
        rows = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
        have = 0 if self.held is None else self.held.num_rows
        fill = min(self.size - have, rows.num_rows)
        if fill:
            first = rows.slice(0, fill)
            self.held = first if self.held is None else pa.concat_tables([self.held, first])
            rows = rows.slice(fill)
        n = rows.num_rows
        if not n:
            return None
        # one double a row, so that the order does not depend on how rows are cut into batches
        slot = np.minimum((self.draws.random(n) * self.size).astype(np.int64), self.size - 1)
        order = np.argsort(slot, kind="stable")
        again = slot[order][1:] == slot[order][:-1]
        out = slot.copy()
        out[order[1:][again]] = self.size + order[:-1][again]
        stays = np.arange(self.size)
        last = np.append(~again, True)
        stays[slot[order][last]] = self.size + order[last]
        both = pa.concat_tables([self.held, rows])
        self.held = both.take(pa.array(stays)).combine_chunks()
        return both.take(pa.array(out))

    def drain(self) -> pa.Table | None:
        """The rows still held, in random order."""
        if self.held is None:
            return None
        return self.held.take(pa.array(self.draws.permutation(self.held.num_rows)))


def buffered_shuffle(df: DataFrame, order_col: str, shard_col: str = "shard", epoch: int = 0, seed: int = 42,
                     buffer: int = BUFFER_ROWS, out: str = "pos") -> DataFrame:
    """Each shard's rows, read in ``order_col`` order, through a buffer of ``buffer`` rows (all of
    them, if fewer); ``out`` is the position in which a row comes out.

    A shard is a sequence by nature and one task reads it, holding the buffer only; shards
    spread over tasks.  A NULL shard is one of its own.
    """
    kept = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType(kept + [T.StructField(out, T.LongType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = [None, None, 0]                      # shard, its buffer, rows out so far

        def emit(rows: pa.Table | None) -> Iterator[pa.RecordBatch]:
            if rows is not None and rows.num_rows:
                pos = pa.array(np.arange(state[2], state[2] + rows.num_rows))
                state[2] += rows.num_rows
                yield from rows.append_column(out, pos).combine_chunks().to_batches()

        for batch in batches:
            shard = batch.column(len(names)).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if state[1] is None or shard[lo] != state[0]:
                    if state[1] is not None:
                        yield from emit(state[1].drain())
                    state[:] = [shard[lo], ShuffleBuffer(shard_draws(seed, epoch, int(shard[lo])), buffer), 0]
                yield from emit(state[1].push(batch.slice(lo, hi - lo).select(names)))
        if state[1] is not None:
            yield from emit(state[1].drain())

    keyed = df.select(*names, F.coalesce(F.col(shard_col).cast("long"), F.lit(-1)).alias("__shard"))
    ordered = keyed.repartition("__shard").sortWithinPartitions("__shard", order_col)
    return ordered.mapInArrow(run, schema)
