"""Object listing in rounds over a written frontier.

A listing starts from a table of folders and works in rounds.  Every row of the frontier is
a range of names of one folder; a task reads one page of it, writes the objects it finds, and
puts on the next frontier what is left: the folders it met and, if the page was full, the
rest of the range, cut into several.  So a flat folder of millions of objects spreads over
as many tasks as a deep tree does, and nothing but the number of rows left reaches the
driver.  Each round is a table, so a lost executor costs its own pages only.

How a page is read is a parameter: an object store answers a range of names directly;
the default (any filesystem that pyarrow opens) reads a folder's names for every page.
"""

from __future__ import annotations

import functools
import os
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.sources.objects import STORE_ATTEMPTS, _resolve

#: ``(folder, after, upto, limit) -> names``: at most ``limit`` names of a folder in ascending
#: order, those greater than ``after`` and (if not None) at most ``upto``; a folder's name ends
#: with "/".
PageReader = Callable[[str, str, str | None, int], list[str]]

#: Names of a page, and ranges that a full page's rest is cut into, about.
PAGE_SIZE, MAX_CUTS = 1000, 64
#: Pages that one task reads in a round, at most.
PAGES_PER_TASK = 64
#: Places of a name (the first where a page's names differ, and those before) that give cuts.
CUT_PLACES = 3

_FRONTIER = "root string, folder string, after string, upto string"
_ROUND = "kind string, root string, path string, folder string, after string, upto string"


@functools.lru_cache(maxsize=4)
def _names(folder: str, asked_at: int) -> tuple[str, ...]:
    """All names of a folder, ascending; kept for the few pages that a task reads of it."""
    from pyarrow import fs as pafs
    filesystem, inner = _resolve(folder.rstrip("/") or "/")
    if isinstance(filesystem, pafs.LocalFileSystem):
        try:
            with os.scandir(inner) as found:
                return tuple(sorted(e.name + "/" if e.is_dir() else e.name for e in found))
        except (FileNotFoundError, NotADirectoryError):
            return ()
    infos = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    return tuple(sorted(i.base_name + "/" if i.type == pafs.FileType.Directory else i.base_name for i in infos))


def read_page(folder: str, after: str, upto: str | None, limit: int) -> list[str]:
    """The default :data:`PageReader`, over any filesystem that pyarrow opens."""
    from bisect import bisect_right
    names = _names(folder, int(time.time()) // 60)
    lo = bisect_right(names, after)
    hi = len(names) if upto is None else bisect_right(names, upto)
    return list(names[lo:min(hi, lo + limit)])


def rest_of_range(page: list[str], upto: str | None) -> list[tuple[str, str | None]]:
    """Ranges ``(after, upto)`` that cover the names after a full page, up to ``upto``.

    Cuts lie where the page's last name gets a larger character at the first place where
    the page's names differ, or a little before it: names counted up (``img_0001``) then
    fall into ranges of like sizes, and larger ones further on.  Any cuts cover the
    range; good ones only balance it.
    """
    first, last = page[0], page[-1]
    at = len(os.path.commonprefix([first, last]))
    letters = sorted({c for name in page[:: max(1, len(page) // 50)] for c in name.rstrip("/")})
    cuts = {last[:i] + c for i in range(max(0, at - CUT_PLACES + 1), min(at + 1, len(last)))
            for c in letters if c > last[i]}
    inside = sorted(c for c in cuts if c > last and (upto is None or c < upto))
    inside = inside[:: -(-len(inside) // MAX_CUTS)] if inside else []
    edges = [last, *inside, upto]
    return list(zip(edges[:-1], edges[1:]))


def _page_rows(row: dict, reader: PageReader, size: int, recursive: bool) -> Iterator[tuple]:
    folder, root = row["folder"], row["root"]
    for attempt in range(STORE_ATTEMPTS):
        try:
            page = reader(folder, row["after"] or "", row["upto"], size)
            break
        except OSError:
            if attempt == STORE_ATTEMPTS - 1:
                raise                       # a listing that fails must not look like an empty one
            time.sleep(0.2 * 2 ** attempt)
    for name in page:
        if not name.endswith("/"):
            yield "object", root, folder + name, None, None, None
        elif recursive:
            yield "folder", root, None, folder + name, None, None
    if len(page) >= size:
        for after, upto in rest_of_range(page, row["upto"]):
            yield "folder", root, None, folder, after, upto


def list_frontier(roots: DataFrame, work: str, prefix_col: str = "prefix", recursive: bool = True,
                  page_size: int = PAGE_SIZE, reader: PageReader = read_page) -> DataFrame:
    """``(prefix, path)`` of every object under each distinct prefix.

    ``work`` is a folder that all machines share; the rounds' tables are written below
    it (an earlier listing there is replaced).  NULL prefixes and prefixes that do not exist
    list nothing.  A prefix below another lists its objects for both.  A page that cannot be
    read is retried and then fails its task.
    """
    import pyarrow as pa
    if page_size < 2:
        raise ValueError("page_size must be at least 2")
    spark = roots.sparkSession

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = list(_page_rows(row, reader, page_size, recursive))
                for lo in range(0, len(found), 10_000):
                    cols = zip(*found[lo:lo + 10_000])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols],
                                                     names=["kind", "root", "path", "folder", "after", "upto"])

    wanted = F.regexp_replace(prefix_col, r"/+$", "")
    frontier = (roots.select(F.col(prefix_col).alias("root"), F.concat(wanted, F.lit("/")).alias("folder"))
                .where("root IS NOT NULL").distinct()
                .withColumns({"after": F.lit(None).cast("string"), "upto": F.lit(None).cast("string")}))
    work = work.rstrip("/")
    frontier.write.mode("overwrite").parquet(f"{work}/start")
    frontier = spark.read.schema(_FRONTIER).parquet(f"{work}/start")
    left, rounds = frontier.count(), []
    while left or not rounds:
        tasks = max(1, min(left, max(4 * spark.sparkContext.defaultParallelism, -(-left // PAGES_PER_TASK))))
        path = f"{work}/round-{len(rounds)}"
        # a few rows that stand for much work: an explicit count, which AQE leaves as it is
        frontier.repartition(tasks).mapInArrow(run, _ROUND).write.mode("overwrite").parquet(path)
        rounds.append(path)
        frontier = spark.read.schema(_ROUND).parquet(path).where("kind = 'folder'").select(
            "root", "folder", "after", "upto")
        left = frontier.count()
    return (spark.read.schema(_ROUND).parquet(*rounds).where("kind = 'object'")
            .select(F.col("root").alias("prefix"), "path"))
