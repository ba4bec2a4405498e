"""Training batches as a Python data source (S13): shards in files, read as planned.

:func:`write_feed` deals the samples of a split over shards in the global shuffled order
(F1, F3) and writes each shard in chunks of files.  The source ``rasterfeed`` reads them back
as ``(epoch, shard, batch, pos, *columns)``: one input partition per epoch and shard, which
opens its shard's files only.  Every epoch takes the chunks in an order of its own and
passes the rows through a bounded buffer; batches hold ``batch_size`` rows of one shard and an
incomplete last one is dropped.  Filters on ``epoch`` and ``shard`` prune partitions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from rasterprep.operators import feed as FD
from rasterprep.operators.buffered import BUFFER_ROWS, ShuffleBuffer, shard_draws
from rasterprep.sinks.writers import write_small_file
from rasterprep.sources.objects import _open_bytes, _resolve

NAME = "rasterfeed"
FEED = "_feed.json"
#: Rows of a chunk, and rows that a reader takes from a file at a time.
CHUNK_ROWS, READ_ROWS = 4096, 256
PLACES = [T.StructField(c, T.LongType()) for c in ("epoch", "shard", "batch", "pos")]


def write_feed(samples: DataFrame, path: str, shards: int, id_col: str | Sequence[str] = "patch_id",
               seed: int = 42, chunk_rows: int = CHUNK_ROWS) -> None:
    """Write the samples of one split as ``shards`` shards (an earlier feed there is replaced).

    The order is ``feed.epoch_shuffle``'s; sample ``pos`` goes to shard ``pos mod shards``.  A
    chunk is a folder of its own, written by one task, so a shard of any size is written
    by many.  Columns named like the source's own may not be there.
    """
    clash = {f.name for f in PLACES} & set(samples.columns)
    if clash:
        raise ValueError(f"the feed adds {sorted(clash)} itself")
    fields = T.StructType(samples.schema.fields)
    placed = FD.assign_shards(FD.epoch_shuffle(samples, id_col, seed=seed, epoch_col=None), shards).drop("__n")
    placed = placed.withColumn("chunk", F.expr(f"pos div {shards} div {int(chunk_rows)}"))
    (placed.repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "pos").drop("pos")
     .write.mode("overwrite").partitionBy("shard", "chunk").parquet(path))
    write_small_file(f"{path.rstrip('/')}/{FEED}", json.dumps({"shards": shards, "schema": fields.jsonValue()}))


class ShardEpoch(InputPartition):
    """What one task reads: a shard in an epoch."""

    def __init__(self, epoch: int, shard: int):
        self.epoch, self.shard = epoch, shard


class FeedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns = [f.name for f in schema.fields if f.name not in {p.name for p in PLACES}]
        self.names = schema.fieldNames()
        self.path = options["path"].rstrip("/")
        self.epochs, self.batch_size = int(options.get("epochs", 1)), int(options.get("batch_size", 16))
        self.buffer, self.seed = int(options.get("buffer", BUFFER_ROWS)), int(options.get("seed", 42))
        self.drop_remainder = str(options.get("drop_remainder", "true")).lower() == "true"
        self.shards = json.loads(_open_bytes(f"{self.path}/{FEED}"))["shards"]
        self.wanted: dict[str, set[int]] = {}

    def pushFilters(self, filters: list[Filter]):
        """Equality and membership on ``epoch`` and ``shard`` choose partitions; the rest is Spark's."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column not in ("epoch", "shard"):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self):
        def of(column: str, n: int) -> list[int]:
            return [i for i in range(n) if column not in self.wanted or i in self.wanted[column]]
        # a source has one partition at least; one that no shard has reads nothing
        return [ShardEpoch(e, s) for e in of("epoch", self.epochs) for s in of("shard", self.shards)] or [ShardEpoch(0, -1)]

    def _files(self, shard: int) -> list[list[str]]:
        """The shard's files by chunk, in chunk order."""
        from pyarrow import fs as pafs
        filesystem, inner = _resolve(f"{self.path}/shard={shard}")
        found: dict[int, list[str]] = {}
        for info in filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True, recursive=True)):
            m = re.search(r"/chunk=(\d+)/[^/]*\.parquet$", info.path)
            if m:
                found.setdefault(int(m[1]), []).append(info.path)
        return [sorted(found[c]) for c in sorted(found)]

    def read(self, partition: ShardEpoch):
        import pyarrow.parquet as pq
        filesystem, _ = _resolve(f"{self.path}/shard={partition.shard}")
        chunks = self._files(partition.shard)
        draws = shard_draws(self.seed, partition.epoch, partition.shard)
        order = draws.permutation(len(chunks))
        opened = [(f, filesystem) for c in order.tolist() for f in chunks[c]]
        total = 0
        if self.drop_remainder:                    # footers alone
            for name, _ in opened:
                with filesystem.open_input_file(name) as f:
                    total += pq.read_metadata(f).num_rows
            total -= total % self.batch_size
        buffer, at = ShuffleBuffer(draws, self.buffer), 0

        def placed(rows: pa.Table | None):
            nonlocal at
            if rows is None:
                return
            if self.drop_remainder:
                rows = rows.slice(0, max(0, min(rows.num_rows, total - at)))
            if not rows.num_rows:
                return
            pos = np.arange(at, at + rows.num_rows)
            at += rows.num_rows
            own = {"epoch": np.full(len(pos), partition.epoch), "shard": np.full(len(pos), partition.shard),
                   "batch": pos // self.batch_size, "pos": pos}
            table = pa.table({n: pa.array(own[n]) if n in own else rows.column(n) for n in self.names})
            yield from table.combine_chunks().to_batches()

        for name, _ in opened:
            with filesystem.open_input_file(name) as f:
                for batch in pq.ParquetFile(f).iter_batches(READ_ROWS, columns=self.columns):
                    yield from placed(buffer.push(batch.select(self.columns)))
        yield from placed(buffer.drain())


class FeedSource(DataSource):
    """``spark.read.format("rasterfeed")`` with the options ``path``, ``epochs``, ``batch_size``,
    ``buffer``, ``seed`` and ``drop_remainder``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        fields = json.loads(_open_bytes(f"{self.options['path'].rstrip('/')}/{FEED}"))["schema"]
        return T.StructType(PLACES + T.StructType.fromJson(fields).fields)

    def reader(self, schema: T.StructType) -> FeedReader:
        return FeedReader(schema, self.options)


def read_feed(spark: SparkSession, path: str, epochs: int = 1, batch_size: int = 16, buffer: int = BUFFER_ROWS,
              seed: int = 42, drop_remainder: bool = True) -> DataFrame:
    """The feed's rows as ``(epoch, shard, batch, pos, *columns)``; see the module."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeedSource)
    options = {"path": path, "epochs": epochs, "batch_size": batch_size, "buffer": buffer, "seed": seed,
               "drop_remainder": str(drop_remainder).lower()}
    return spark.read.format(NAME).options(**options).load()
