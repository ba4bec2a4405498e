"""Mixing sources to target weights, over blocks of a fixed number of words.

Each source's texts stand one after the other, and this stream is cut into blocks of
``block_words`` words.  The mix is a number of output shards of equally many slots.  A
shard draws from the targets how many slots each source gets: the whole parts of the
expected numbers are given, the rest is a multinomial draw over their fractions, so that
totals stay near the targets also where there are few slots.  A source's slots are
numbered over all shards; slot ``j`` takes the block that a pseudorandom permutation of
the source's blocks puts at ``j`` (another one for every pass over the source), found by a
join on the block's index.

Everything is DataFrame and SQL expressions, and every draw is a hash of the seed, so a
rerun gives the same mix.  A source may hold most rows: its texts are placed in buckets dealt
by a hash, with running totals of the buckets, and its slots are dealt by shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterprep.llm.common import materialize
from rasterprep.operators.ranking import ordered_index

#: Words of a block, and slots of a shard (or 64 times the sources, if that is more).
BLOCK_WORDS, SHARD_SLOTS = 64, 4096
#: Output shards, at most; beyond that they grow.
MAX_SHARDS = 1 << 16
#: Texts of one bucket of the placing, about.
BUCKET_ROWS = 1024
#: Slots that a task makes, about, and tasks at most.
TASK_SLOTS, MAX_TASKS = 1 << 17, 1 << 16
#: Rounds of the permutation.
ROUNDS = 24
#: One slot in the whole-number arithmetic of the draws.
UNIT = 1 << 40

_WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    """The number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)), F.lit(0)).cast("long")


# --- targets ----------------------------------------------------------------------------

def water_level(sources: DataFrame) -> float:
    """The words per unit of weight at which the sources ``(size, weight, cap)`` take all sizes
    together, none more than its cap.  Each round gives what capped sources leave to the
    others; only two sums come back from it."""
    total = sources.agg(F.sum("size").alias("n")).first()["n"] or 0
    level = 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        r = sources.agg(F.sum(F.when(full, F.col("cap"))).alias("full"),
                        F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not r["open"]:
            return level
        rise = (total - (r["full"] or 0)) / r["open"]
        if rise <= level:
            return level
        level = rise


def source_targets(sized: DataFrame, weights: Sequence[int], cap: int, block_words: int) -> DataFrame:
    """One row per source of ``(skey, size)``: its place by code point, size, target and blocks."""
    sources = sized.groupBy("skey").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n_docs"))
    sources = materialize(sources, "sources")
    placed = ordered_index(sources, "skey", "idx").withColumn(
        "weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                               (F.col("idx") % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("size") * cap)
    placed = materialize(placed, "weighted")
    level = water_level(placed)
    return materialize(placed.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")))
                       .withColumn("blocks", F.expr(f"(size + {block_words - 1}) div {block_words}")), "targets")


# --- where texts stand in their source -----------------------------------------------------

def placed_texts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Add ``idx`` and ``start``, the words of the source before the text.

    Texts stand by bucket (a hash of id and text), then id.  A bucket's base is the sum of
    its source's earlier buckets; within a bucket a window adds up.  So a source with a third
    of all rows is dealt over as many groups as its rows ask for.
    """
    rows = targets.agg(F.sum("n_docs").alias("n")).first()["n"] or 0
    buckets = 1 << max(0, (rows // BUCKET_ROWS).bit_length())
    dealt = sized.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)).cast("int"))
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (dealt.groupBy("skey", "bucket").agg(F.sum("size").alias("s"))
            .withColumn("base", F.coalesce(F.sum("s").over(earlier), F.lit(0))).drop("s")
            .join(targets.select("skey", "idx", F.col("size").alias("source_size"), "target"), "skey"))
    before = Window.partitionBy("skey", "bucket").orderBy("id", "key").rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = inside.join(base, ["skey", "bucket"]).select(
        "id", "size", "source_size", "target", "idx", (F.col("base") + F.col("before")).alias("start"))
    return materialize(placed, "placed")


def text_blocks(placed: DataFrame, block_words: int) -> DataFrame:
    """``(idx, block, start, id, first, words)``: the words that each text has in each block;
    ``first`` counts from the text's start."""
    spread = placed.where("size > 0").withColumn("block", F.explode(F.expr(
        f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
    first = F.greatest("start", F.col("block") * block_words)
    return spread.select(
        "idx", "block", "start", "id", (first - F.col("start")).alias("first"),
        (F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - first).alias("words"))


# --- slots -----------------------------------------------------------------------------------

def _hash(seed: int, *parts: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *parts)


def shard_counts(targets: DataFrame, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(idx, blocks, cap_slots, shard, n)``: the slots that every source gets in every shard."""
    spark = targets.sparkSession
    # the last block of a source may be short, so slots are worth what a block holds on average
    expected = F.col("target") * F.col("blocks") / F.col("size")
    used = targets.where("size > 0 AND target > 0")
    sums = used.agg(F.sum(F.ceil(expected)).alias("slots"), F.count(F.lit(1)).alias("sources")).first()
    per_shard = max(shard_slots, 64 * sums["sources"])
    shards = max(1, min(MAX_SHARDS, -(-(sums["slots"] or 0) // per_shard)))
    used = (used.withColumn("e", expected / shards).withColumn("whole", F.floor("e").cast("long"))
            .withColumn("part", F.floor((F.col("e") - F.col("whole")) * UNIT).cast("long")))
    used = materialize(ordered_index(used, "idx", "nth", sums=["part"]), "expected")
    parts = used.agg(F.sum("part").alias("n")).first()["n"] or 0

    every = used.select("idx", "blocks", "size", "cap", "whole",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    if parts:
        # a shard draws as many slots as the fractions add up to, on average
        some = F.expr(f"(pmod(xxhash64({seed}, 1, shard), {UNIT}L) + {parts}L) div {UNIT}L")
        draws = (spark.range(shards).withColumnRenamed("id", "shard").withColumn("some", some).where("some > 0")
                 .withColumn("r", F.explode(F.expr("sequence(1L, some)")))
                 .withColumn("u", F.pmod(_hash(seed, F.lit(2), "shard", "r"), F.lit(parts)))
                 .withColumn("near", F.expr(f"u div {UNIT}L")))
        spans = used.where("part > 0").withColumn("near", F.explode(F.expr(
            f"sequence(part_before div {UNIT}L, (part_before + part - 1) div {UNIT}L)")))
        drawn = (draws.join(spans.select("near", "idx", "part_before", "part"), "near")
                 .where("u >= part_before AND u < part_before + part")
                 .groupBy("idx", "shard").agg(F.count(F.lit(1)).alias("more")))
        every = every.join(drawn, ["idx", "shard"], "left")
    else:
        every = every.withColumn("more", F.lit(0).cast("long"))
    cap_slots = F.expr("cap div size * blocks")
    return every.select("idx", "blocks", cap_slots.alias("cap_slots"), "shard",
                        (F.col("whole") + F.coalesce("more", F.lit(0))).alias("n"))


def permuted(x: str, n: str, *key: str, seed: int = 0, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of ``0 .. n - 1`` at ``x``, for every value of the key columns.

    Rounds of swap-or-not: a round pairs ``x`` with ``k - x`` and swaps the two where a hash
    of the pair says so; both sides ask the same hash, so it is a permutation for any n.
    """
    keys = ", ".join(key)
    partner = f"pmod(pmod(xxhash64({seed}, 3, {keys}, r), {n}) - x, {n})"
    swap = f"xxhash64({seed}, 4, {keys}, r, greatest(x, y)) & 1L"
    step = f"element_at(transform(array({partner}), y -> if({swap} = 1, y, x)), 1)"
    return F.expr(f"aggregate(sequence(1, {rounds}), cast({x} as bigint), (x, r) -> {step})")


def mix_slots(targets: DataFrame, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(idx, shard, slot, block)``: the block that each slot of the mix takes.

    ``slot`` numbers a source's slots over all shards.  No block is taken more often than
    the cap allows: slots beyond stay empty.
    """
    earlier = Window.partitionBy("idx").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    slots = targets.where("size > 0").agg(F.sum(F.ceil(F.expr("target * blocks / size"))).alias("n")).first()["n"] or 0
    tasks = min(MAX_TASKS, 1 + slots // TASK_SLOTS)     # the rows to deal are few, what they become is not
    counts = shard_counts(targets, seed, shard_slots).withColumn(
        "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))         # at most MAX_SHARDS rows a source
    counts = (counts.withColumn("n", F.least(F.col("n"), F.col("cap_slots") - F.col("first"))).where("n > 0")
              .repartition(tasks, "idx", "shard"))
    slots = counts.select("idx", "blocks", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    slots = slots.withColumn("pass", F.expr("slot div blocks")).withColumn("at", F.expr("slot % blocks"))
    return slots.select("idx", "shard", "slot", permuted("at", "blocks", "idx", "pass", seed=seed).alias("block"))


# --- the mix --------------------------------------------------------------------------------------

def _prepared(docs: DataFrame, weights: Sequence[int], cap: int, block_words: int, id_col: str,
              source_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    # a source's key sorts by code point, with null last
    skey = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col)))
    sized = materialize(docs.select(F.col(id_col).alias("id"), skey.alias("skey"), n_words(text_col).alias("size"),
                                    F.xxhash64(id_col, text_col).alias("key")), "sized")
    targets = source_targets(sized, weights, cap, block_words)
    return targets, placed_texts(sized, targets)


def mixture(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 0,
            block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id",
            source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix as spans of texts: ``(shard, source_nth, slot, block, id, first, words)``.

    A slot takes a block, whose words are those from ``first`` on of each of its texts.
    ``source_nth`` is the source's place by code point (null last).  See :func:`mixed_counts`.
    """
    targets, placed = _prepared(docs, weights, cap, block_words, id_col, source_col, text_col)
    return (mix_slots(targets, seed, shard_slots).join(text_blocks(placed, block_words), ["idx", "block"])
            .select("shard", F.col("idx").alias("source_nth"), "slot", "block", "id", "first", "words"))


def mixed_counts(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 0,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id",
                 source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How many words the mix takes of every row: ``(id, size, source_size, target, taken)``.

    Sources by code point (null, one source, last) have the ``weights`` in turn and share
    the words of all rows; a target stops at ``cap`` times its source's size and the excess
    is shared anew.  ``size`` is the number of words, ``taken`` counts repeats, and is
    at most ``cap`` times the size.  A null or empty text has no words.  Null and repeated ids
    and repeated rows are rows of their own; an empty table gives an empty result.
    """
    targets, placed = _prepared(docs, weights, cap, block_words, id_col, source_col, text_col)
    times = mix_slots(targets, seed, shard_slots).groupBy("idx", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (text_blocks(placed, block_words).join(times, ["idx", "block"])
             .groupBy("idx", "start").agg(F.sum(F.col("times") * F.col("words")).alias("taken")))
    columns = ("id", "size", "source_size", "target")
    # texts with words have starts of their own
    return (placed.where("size > 0").join(taken, ["idx", "start"], "left")
            .select(*columns, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
            .unionByName(placed.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))))
