"""Exact deduplication with static binary-fuse filters per immutable snapshot.

The corpus is taken as batches in ascending id order.  Equal texts of a batch are
grouped by digest (partially aggregated before the shuffle, so a text that fills
a third of the rows is no hot key).  The groups' digests are screened by the fuse
filters of the earlier batches' snapshots; only positives join the snapshot's
exact buckets, where the texts themselves are compared byte by byte.  What
survives becomes the batch's own immutable snapshot with its filter.

A filter is built per bucket of digests.  The number of buckets follows the number
of digests, so a bucket stays a few thousand digests at any corpus size, and no
filter is ever broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.llm.common import materialize, mix64

#: Digests per filter bucket, on average.
BUCKET_KEYS = 4096
#: Whitespace that one space stands for.
SPACES = r"[\x20\x09-\x0D]+"

FILTER_SCHEMA = "bucket long, seed long, n_keys long, segment int, n_segments int, cells binary"


# --- binary-fuse filter --------------------------------------------------------------

def _places(keys: np.ndarray, seed: int, segment: int, n_segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three cells of each key (one in each of three consecutive segments) and its fingerprint."""
    with np.errstate(over="ignore"):
        h = mix64(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        g = mix64(h + np.uint64(0xD1B54A32D192ED03))
    base = ((h >> np.uint64(32)) * np.uint64(n_segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    cells = np.empty((3, len(keys)), np.int64)
    for j, bits in enumerate((g & mask, (g >> np.uint64(20)) & mask, (g >> np.uint64(40)) & mask)):
        cells[j] = ((base + np.uint64(j)) * np.uint64(segment) + bits).astype(np.int64)
    return cells, (h & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> dict:
    """A filter of 16-bit fingerprints over distinct ``uint64`` keys.

    Cells holding one key are peeled round by round, then filled in reverse order so
    that the three cells of every key xor to its fingerprint.  A failed peeling is
    tried again with the next seed and, every eighth time, with more cells.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    room = 1.25
    for seed in range(1, 1 << 20):
        segment = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        n_segments = max(1, -(-int(n * room + 8) // segment) - 2)
        cells, marks = _places(keys, seed, segment, n_segments)
        size = (n_segments + 2) * segment
        count = np.bincount(cells.ravel(), minlength=size)
        holds = np.zeros(size, np.int64)
        index = np.arange(n, dtype=np.int64)
        for row in cells:
            np.bitwise_xor.at(holds, row, index)
        rounds, left = [], n
        single = np.flatnonzero(count == 1)
        while len(single):
            key = holds[single]
            key, first = np.unique(key, return_index=True)
            spot = single[first]
            rounds.append((key, spot))
            left -= len(key)
            touched = cells[:, key]
            np.subtract.at(count, touched.ravel(), 1)
            for row in touched:
                np.bitwise_xor.at(holds, row, key)
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        if left == 0:
            table = np.zeros(size, np.uint16)
            for key, spot in reversed(rounds):
                table[spot] = 0
                a, b, c = table[cells[0, key]], table[cells[1, key]], table[cells[2, key]]
                table[spot] = marks[key] ^ a ^ b ^ c
            return {"seed": seed, "n_keys": n, "segment": segment, "n_segments": n_segments,
                    "cells": table.tobytes()}
        if seed % 8 == 0:
            room *= 1.2
    raise RuntimeError("a binary-fuse filter could not be built")


def might_hold(filt: dict, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; never false for a key that is."""
    if not filt["n_keys"]:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filt["cells"], np.uint16)
    cells, marks = _places(keys.astype(np.uint64), filt["seed"], filt["segment"], filt["n_segments"])
    return (table[cells[0]] ^ table[cells[1]] ^ table[cells[2]]) == marks


def filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the ``digest`` column (a long)."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = build_filter(pdf["digest"].to_numpy().astype(np.int64).view(np.uint64))
        return pd.DataFrame([{"bucket": int(pdf["bucket"].iloc[0]), **made}])

    keyed = digests.select("digest", F.pmod("digest", F.lit(buckets)).alias("bucket"))
    return keyed.groupBy("bucket").applyInPandas(build, FILTER_SCHEMA)


def screen(incoming: DataFrame, snapshot_filters: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``incoming`` whose ``digest`` the snapshot's filters let through."""
    names = incoming.columns
    keyed = incoming.withColumn("bucket", F.pmod("digest", F.lit(buckets)))

    def through(key, rows: pd.DataFrame, filt: pd.DataFrame) -> pd.DataFrame:
        if not len(filt) or not len(rows):
            return rows.iloc[:0][names]
        keys = rows["digest"].to_numpy().astype(np.int64).view(np.uint64)
        return rows[might_hold(filt.iloc[0].to_dict(), keys)][names]

    return (keyed.groupBy("bucket").cogroup(snapshot_filters.groupBy("bucket"))
            .applyInPandas(through, incoming.schema))


# --- the operator -----------------------------------------------------------------------

def normalised(text_col: str = "text"):
    """The text with every run of ASCII whitespace as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ")


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(row, id, digest, sha)`` of every row."""
    norm = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    return norm.select(F.monotonically_increasing_id().alias("row"), "id",
                       F.xxhash64("norm").alias("digest"), F.unhex(F.sha2("norm", 256)).alias("sha"))


def _batch_bounds(keys: DataFrame, batches: int) -> list:
    """Ids that cut the corpus into ``batches`` parts of about equal size."""
    shares = [i / batches for i in range(1, batches)]
    got = keys.agg(F.percentile_approx("id", shares, 1000).alias("b")).first()["b"] if shares else None
    return sorted(set(got or []))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                batches: int = 2) -> DataFrame:
    """Group equal texts; one output row per input row.

    Returns ``(id, keep_id, group_size, kept, sha)``.  Texts are equal when
    identical after replacing each run of ASCII whitespace by one space; null
    counts as empty.  The row with the smallest id stays; a null id counts as
    larger than every other.  Of rows that repeat both id and text exactly one is
    ``kept``.  An empty table gives an empty result; other columns are ignored.
    """
    keys = materialize(digests(docs, id_col, text_col), "dedup-keys")
    bounds = _batch_bounds(keys, batches)
    total = keys.count()
    buckets = max(1, -(-total // (BUCKET_KEYS * (len(bounds) + 1))))

    batch = F.lit(len(bounds)) - sum((F.when(F.col("id") < b, 1).otherwise(0) for b in bounds), F.lit(0))
    keys = keys.withColumn("batch", F.when(F.col("id").isNull(), len(bounds)).otherwise(batch))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    groups = keys.groupBy("batch", "digest", "sha").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))

    snapshots: list[DataFrame] = []   # groups of earlier batches that were new then
    found: list[DataFrame] = []       # groups of a batch with the snapshot row they repeat
    for b in range(len(bounds) + 1):
        own = groups.where(F.col("batch") == b).select("digest", "sha", "first", "n")
        fresh = materialize(own, f"dedup-batch{b}")
        for earlier in snapshots:
            positive = screen(fresh, filters(earlier.select("digest"), buckets), buckets)
            same = materialize(_byte_checked(positive, earlier, docs, id_col, text_col), "dedup-hits")
            found.append(same.select("digest", "sha", "keep", "n"))
            fresh = fresh.join(same.select("digest", "sha"), ["digest", "sha"], "left_anti")
        if snapshots:
            fresh = materialize(fresh, f"dedup-snapshot{b}")
        snapshots.append(fresh)
    for s in snapshots:
        found.append(s.select("digest", "sha", F.col("first").alias("keep"), "n"))

    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    whole = whole.groupBy("digest", "sha").agg(
        F.min("keep").alias("keep"), F.sum("n").alias("group_size"))
    return keys.join(whole, ["digest", "sha"]).select(
        "id", F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("sha"))


def _byte_checked(positive: DataFrame, snapshot: DataFrame, docs: DataFrame,
                  id_col: str, text_col: str) -> DataFrame:
    """Positives that are in the snapshot's bucket and whose first text equals, byte by
    byte, the snapshot's: ``(digest, sha, keep, n)``.  One pair of texts per group."""
    pairs = positive.select("digest", "sha", "n", F.col("first.id").alias("id")).join(
        snapshot.select("digest", "sha", F.col("first").alias("keep")), ["digest", "sha"])
    wanted = pairs.select("digest", "sha", F.explode(F.array("id", "keep.id")).alias("id"))
    wanted = wanted.select("digest", "sha", F.coalesce("id", F.lit(0)).alias("key"),
                           F.col("id").isNull().alias("no_id"))
    texts = docs.select(F.coalesce(F.col(id_col), F.lit(0)).alias("key"),
                        F.col(id_col).isNull().alias("no_id"), F.col(text_col).alias("text"))
    # only the wanted rows are normalised; a repeated id brings its other texts, told apart by digest
    fetched = (texts.join(wanted, ["key", "no_id"])
               .withColumn("norm", normalised("text"))
               .where(F.xxhash64("norm") == F.col("digest")))
    checked = fetched.groupBy("digest", "sha").agg(
        F.min("norm").alias("lo"), F.max("norm").alias("hi")).where("lo = hi")
    return pairs.join(checked.select("digest", "sha"), ["digest", "sha"])


def keep_rows(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    names = docs.columns
    stay = decisions.where("kept").select(
        F.coalesce("id", F.lit(0)).alias("__key"), F.col("id").isNull().alias("__no_id"),
        F.unhex("sha").alias("__sha")).distinct()
    keyed = docs.select(
        *names, F.coalesce(F.col(id_col), F.lit(0)).alias("__key"),
        F.col(id_col).isNull().alias("__no_id"),
        F.unhex(F.sha2(normalised(text_col), 256)).alias("__sha"))
    key = ["__key", "__no_id", "__sha"]
    return keyed.join(stay, key).dropDuplicates(key).select(*names)
