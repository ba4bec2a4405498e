"""Jaccard self-join of documents' word n-grams by adaptive multi-match prefixes.

Two sets of at least a given similarity share enough elements that, in any fixed
order of all elements, their prefixes must meet; if both prefixes are lengthened by
``m - 1`` elements, they must share at least ``m``.  Elements are ordered by how many
documents have them (estimated by a sketch that counts every shingle of every
document), rarest first.  A document whose prefix promises many candidates takes a
longer one and asks for more shared elements; a pair must share the smaller of its two
numbers before its texts are compared.

Large groups of near copies would still make a pair for any two members.  So
components grow in rounds: documents of crowded elements first meet the leaders of their
min-hash buckets, then leaders of those elements; documents already connected need no further link between them.  The last
round takes every remaining candidate pair between different components, which makes
the components exact.

Each set also has a parity bitmap: every element flips one of its bits, so two bitmaps
differ in no more bits than their sets in elements.  A pair whose bitmaps differ too
much is left out inside the join, before it becomes a row.  The pairs left are compared
once more by bitmaps as wide as their sets ask for; only then texts are read, those of paired
nodes.

Documents with equal sets are one node from the start.  Frequent elements are split
over several groups by the sketch's estimate, before any shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterprep.llm.common import (ascii_lower, ascii_words, materialize, mix64, slice_hashes,
                                   text_chunks, then_released)
from rasterprep.llm.components import connected

#: Counters of the frequency sketch (4 bytes each), and rows that carry them.
SLOTS = 1 << 20
SKETCH_ROWS = 64
#: Shared prefix elements asked for, at most.
MAX_MATCH = 3
#: Expected candidates that one more shared element is asked for (doubling from here).
CANDIDATES = 64
#: Documents of one element that stay in one group.
GROUP_ROWS = 4096
#: Bits of the parity bitmap, and min-hash values of a set.
BITS, MINS = 512, 32
#: Bytes of text whose words are hashed together: numpy takes some fifty times as much meanwhile.
CHUNK = 1 << 19
#: Bits of the bitmap that paired nodes are compared by before their texts are, at most.
MAX_BITS = 1 << 17
#: An element of more nodes than this is busy: its nodes meet leaders before all pairs are taken.
BUSY_NODES = 16
#: Min-hash values of a bucket key, and the buckets of the first round (by the first value
#: of their key).
BUCKET_MINS = 4
BUCKETS = (0, 4, 8, 12, 16, 20, 24, 28)
#: Leaders that a node meets in each of its buckets, and rounds over busy elements.
LEADERS, ELEMENT_ROUNDS = 8, 2
#: 64-bit words of the filter that keeps unwanted texts out of shuffles.
FILTER_WORDS = 1 << 17


# --- shingles ------------------------------------------------------------------------------

def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's set of ``width``-word shingles as sorted distinct 64-bit hashes.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  Fewer words than ``width``
    make one shingle of them all; no words make an empty set.
    """
    starts, ends, row = ascii_words(data, offs)
    n_texts = len(offs) - 1
    if not len(starts):
        return [np.empty(0, np.uint64)] * n_texts
    word = slice_hashes(ascii_lower(data), starts, ends)
    per_text = np.bincount(row, minlength=n_texts)
    first = np.cumsum(per_text) - per_text
    mult = [np.uint64(m) for m in mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)]
    with np.errstate(over="ignore"):
        whole = np.zeros(max(0, len(word) - width + 1), np.uint64)
        for j in range(width):
            whole += word[j:len(word) - width + 1 + j] * mult[j]
        whole = mix64(whole)
        out = []
        for k, at in zip(per_text.tolist(), first.tolist()):
            if k >= width:
                out.append(np.unique(whole[at:at + k - width + 1]))
            elif k:
                h = np.uint64(k)
                for j in range(k):
                    h = h + word[at + j] * mult[j]
                out.append(mix64(np.array([h])))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit key of a set."""
    with np.errstate(over="ignore"):
        total = s.sum(dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.bitwise_xor.reduce(s)
        return int(mix64(np.array([total + np.uint64(len(s))])).view(np.int64)[0])


def bitmap(s: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity bitmap of a set, as signed 64-bit words."""
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def wide_bitmap(s: np.ndarray) -> np.ndarray:
    """A parity bitmap of twice as many bits as the set has elements, or more (a power of two, from
    ``BITS`` to ``MAX_BITS``): a short one is all noise for a large set."""
    return bitmap(s, min(MAX_BITS, max(BITS, 1 << (2 * len(s)).bit_length())))


def min_hashes(s: np.ndarray) -> np.ndarray:
    """The smallest element in each of ``MINS`` equal ranges of hashes (0 where there is none)."""
    edges = np.arange(MINS, dtype=np.uint64) << np.uint64(64 - MINS.bit_length() + 1)
    at = np.searchsorted(s, edges)
    end = np.append(at[1:], len(s))
    low = s[np.minimum(at, len(s) - 1)]
    return np.where(end > at, (low >> np.uint64(16)).astype(np.uint32), 0).astype(np.uint32).view(np.int32)


# --- how many documents have a shingle ---------------------------------------------------------

def frequency_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """``SLOTS`` counters over all shingles of all rows; a shingle counts in one slot.

    Tasks send their counters as ``SKETCH_ROWS`` compressed pieces; pieces are added up
    by Spark, each in its own group, and the sum (a fixed size) comes back.
    """
    size = SLOTS // SKETCH_ROWS
    shift = np.uint64(64 - SLOTS.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.uint32)
        held, waiting = [], 0

        def add_held() -> None:
            h = np.concatenate(held) if held else np.empty(0, np.uint64)
            np.add(total, np.bincount((h >> shift).astype(np.int64), minlength=SLOTS), out=total, casting="unsafe")

        for _, data, offs in text_chunks(batches, "text", CHUNK):
            held += shingle_sets(data, offs, width)
            waiting += sum(map(len, held[-(len(offs) - 1):]))
            if waiting > SLOTS // 2:            # counters are added up for many shingles at once
                add_held()
                held, waiting = [], 0
        add_held()
        pieces = total.reshape(SKETCH_ROWS, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SKETCH_ROWS, dtype=np.int32)),
             pa.array([zlib.compress(p.astype("<u4").tobytes(), 1) for p in pieces], pa.binary())],
            names=["slot", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                piece = np.frombuffer(zlib.decompress(raw.as_py()), "<u4").astype(np.uint64)
                total[slot] = total[slot] + piece if slot in total else piece
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([zlib.compress(np.minimum(x, 2**32 - 1).astype("<u4").tobytes(), 1)
                           for x in total.values()], pa.binary())], names=["slot", "counts"])

    schema = "slot int, counts binary"
    summed = docs.mapInArrow(lambda b: then_released(count(b)), schema).repartition(SKETCH_ROWS, "slot").mapInArrow(add, schema)
    out = np.zeros((SKETCH_ROWS, size), np.uint32)
    for r in summed.collect():
        out[r["slot"]] = np.frombuffer(zlib.decompress(bytes(r["counts"])), "<u4")
    return out.ravel()


# --- prefixes ----------------------------------------------------------------------------------

def prefix(s: np.ndarray, estimate: np.ndarray, noise: float, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(elements, their estimated documents, how many a pair must share)``."""
    n = len(s)
    order = np.argsort((np.minimum(estimate, (1 << 20) - 1).astype(np.uint64) << np.uint64(44))
                       | (s >> np.uint64(20)))
    alpha = -(-percent * n // 100)
    others = np.maximum(estimate[order[:n - alpha + 1]] - noise - 1, 0).sum()
    match = 1 + int(np.log2(1 + others / CANDIDATES))
    match = max(1, min(match, MAX_MATCH, alpha))
    chosen = order[:n - alpha + match]
    return s[chosen], np.maximum(estimate[chosen] - noise, 1), match


def _signatures(docs: DataFrame, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """``(id, t, n, key, match, bits, mins, wide, tokens, parts)`` of every row of ``(id, t, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)      # a fixed size
    shift = np.uint64(64 - SLOTS.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        noise = float(counts.mean())
        for rows, data, offs in text_chunks(batches, "text", CHUNK):
            n, keys, need, tokens, parts, lens, bits, mins, wide = [], [], [], [], [], [], [], [], []
            for s in shingle_sets(data, offs, width):
                n.append(len(s))
                if not len(s):
                    keys.append(0), need.append(0), lens.append(0), bits.append(None), mins.append(None)
                    wide.append(None)
                    continue
                keys.append(set_key(s)), bits.append(bitmap(s)), mins.append(min_hashes(s))
                wide.append(wide_bitmap(s))
                t, est, match = prefix(s, counts[(s >> shift).astype(np.int64)].astype(np.float64), noise, percent)
                need.append(match), lens.append(len(t))
                tokens.append(t)
                parts.append((est / GROUP_ROWS).astype(np.int32))
            ends = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
            split = np.concatenate(parts) if parts else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(need, pa.int32()),
                 pa.array(bits, pa.list_(pa.int64())), pa.array(mins, pa.list_(pa.int32())),
                 pa.array(wide, pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(ends, pa.array(flat.view(np.int64))),
                 pa.ListArray.from_arrays(ends, pa.array(split))],
                names=["id", "t", "n", "key", "match", "bits", "mins", "wide", "tokens", "parts"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(lambda b: then_released(run(b)), f"id {kind}, t long, n long, key long, match int, bits array<long>, mins array<int>, "
                                f"wide array<long>, tokens array<long>, parts array<int>")


def _postings(nodes: DataFrame) -> DataFrame:
    """``(token, grp, node, n, match)`` of the tokens that two nodes or more may share.

    A token estimated in many documents is dealt over ``parts + 1`` groups.  One shuffle
    by token and group; runs of one row, which no pair can come from, are left out.
    """
    flat = nodes.select("node", "n", "match", F.explode(F.arrays_zip("tokens", "parts")).alias("t")).select(
        F.col("t.tokens").alias("token"),
        F.when(F.col("t.parts") > 0, F.pmod(F.xxhash64("node"), F.col("t.parts") + 1).cast("int"))
        .otherwise(F.lit(0)).alias("grp"),
        (F.col("t.parts") > 0).alias("dealt"), "node", F.col("n").cast("int").alias("n"),
        F.col("match").cast("byte").alias("match"))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None          # the last row, whose run may go on
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, grp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            same = (token[1:] == token[:-1]) & (grp[1:] == grp[:-1])
            keep = batch.column(2).to_numpy(zero_copy_only=False).copy()
            keep[1:] |= same
            keep[:-1] |= same
            last = batch.num_rows - 1
            # the last row waits, unless it is already known to be shared
            held = batch.slice(last, 1)
            if keep[last] and last and same[-1]:
                # mark it so that it is kept whatever follows
                held = held.set_column(2, held.schema.field(2), pa.array([True]))
            keep[last] = False
            if keep.any():
                yield batch.filter(pa.array(keep))
        if held is not None and held.column(2)[0].as_py():
            yield held

    ordered = flat.repartition("token", "grp").sortWithinPartitions("token", "grp")
    return ordered.mapInArrow(shared, ordered.schema)


# --- candidates and their verification -------------------------------------------------------------

def _differ(a: str, b: str) -> str:
    """SQL: the number of bits in which two bitmaps differ."""
    return " + ".join(f"bit_count({a}b{i} ^ {b}b{i})" for i in range(BITS // 64))


def _may_link(a: str, b: str, percent: int):
    """Sizes and bitmaps that leave the similarity possible (columns with prefixes)."""
    differ = _differ(a, b)
    return F.expr(f"100L * least({a}n, {b}n) >= {percent}L * greatest({a}n, {b}n) AND "
                  f"{100 + percent}L * ({differ}) <= {100 - percent}L * ({a}n + {b}n)")


def _prefixed(df: DataFrame, prefix: str, *others: str) -> DataFrame:
    words = [f"b{i}" for i in range(BITS // 64)]
    return df.select(*others, *[F.col(c).alias(prefix + c) for c in ("node", "label", "n", *words)])


def _labelled(marks: DataFrame, labels: DataFrame) -> DataFrame:
    return marks.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _min_hash_buckets(busy: DataFrame, marks: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes of busy elements, keyed by runs of their min-hash values."""
    keys = F.array(*[F.xxhash64(F.lit(at), F.slice("mins", at + 1, BUCKET_MINS)) for at in BUCKETS])
    some = marks.join(busy.select("node").distinct(), "node", "left_semi")
    return _labelled(some, labels).withColumn("bucket", F.explode(keys)).drop("mins")


def _element_buckets(busy: DataFrame, marks: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes keyed by the busy elements that several components share."""
    known = busy.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = known.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return (known.join(mixed.select("token"), "token").join(marks.drop("mins"), "node")
            .withColumnRenamed("token", "bucket"))


def _leader_pairs(keyed: DataFrame, seed: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of nodes with leaders of their buckets that may link.

    A bucket's nodes are dealt into ``LEADERS`` groups by a hash; the lowest of each group
    leads, and every node of the bucket meets all leaders of other components.  Of a node's
    pairs with one component the one with the closest bitmaps is kept.  Leaders are found by
    an aggregation, so a bucket with a third of all nodes is no hot key there, and the
    join back is at most ``LEADERS`` rows per node and bucket.
    """
    words = [f"b{i}" for i in range(BITS // 64)]
    group = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(LEADERS))
    leaders = keyed.groupBy("bucket", group.alias("g")).agg(
        F.min(F.struct(F.xxhash64("node", F.lit(seed + 1)).alias("h"), "node", "label", "n", *words)).alias("lead"))
    one, other = _prefixed(keyed, "x_", "bucket"), _prefixed(leaders.select("bucket", "lead.*"), "y_", "bucket")
    met = one.join(other, (one["bucket"] == other["bucket"]) & F.expr("x_label <> y_label")
                   & _may_link("x_", "y_", percent))
    near = met.groupBy("x_node", "y_label").agg(
        F.min(F.struct(F.expr(_differ("x_", "y_")).alias("d"), F.col("y_node").alias("node"))).alias("y"))
    return near.select(F.least("x_node", "y.node").alias("a"), F.greatest("x_node", "y.node").alias("b")).distinct()


def _cross_pairs(postings: DataFrame, marks: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Every pair ``(a, b)`` of nodes of different components that shares enough prefix
    elements.

    Of an element's components the one with most nodes never pairs with itself: the
    nodes of the others meet all nodes of different components, so that an element whose
    nodes are connected already costs nothing.
    """
    known = postings.join(labels, "node", "left").select(
        "token", "node", "match", F.coalesce("label", "node").alias("label"))
    per_label = known.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c"))
    major = per_label.groupBy("token").agg(
        F.max_by("label", F.struct("c", "label")).alias("major"), F.count(F.lit(1)).alias("labels"))
    mixed = known.join(major.where("labels > 1").select("token", "major"), "token")
    mixed = mixed.join(marks.drop("mins"), "node")
    minor = _prefixed(mixed.where("label <> major"), "x_", "token", F.col("match").alias("x_match"))
    every = _prefixed(mixed, "y_", "token", F.col("match").alias("y_match"),
                      (F.col("label") == F.col("major")).alias("in_major"))
    met = minor.join(every, (minor["token"] == every["token"]) & F.expr(
        "x_label <> y_label AND (in_major OR x_node < y_node)") & _may_link("x_", "y_", percent))
    return (met.groupBy(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"),
                        F.least("x_match", "y_match").alias("need"))
            .agg(F.count(F.lit(1)).alias("c")).where("c >= need").select("a", "b"))


def _likely(df: DataFrame, wanted: DataFrame, *cols: str) -> DataFrame:
    """The rows of ``df`` whose ``cols`` may be among those of ``wanted``, found without a
    shuffle: a bitmap of ``FILTER_WORDS`` words (a fixed size, whatever the tables) is
    broadcast.  An exact join has to follow."""
    spot = F.pmod(F.xxhash64(*cols), F.lit(FILTER_WORDS * 64))
    bit = F.expr("shiftleft(1L, cast(__spot % 64 as int))")
    word = F.expr("__spot div 64")
    words = wanted.select(spot.alias("__spot")).groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    return (df.withColumn("__spot", spot).withColumn("__word", word).join(F.broadcast(words), "__word")
            .where(F.col("__bits").bitwiseAND(bit) != 0).select(*df.columns))


def _wide_enough(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose wide bitmaps leave the similarity possible; the longer bitmap of a pair is
    folded to the shorter one's length, which gives the bitmap of that length."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("wide").alias("aw"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("wide").alias("bw"))

    def word(w: str) -> str:
        return f"aggregate(sequence(0, size({w}) div m - 1), 0L, (x, k) -> x ^ {w}[i + k * m])"

    differ = (f"element_at(transform(array(least(size(aw), size(bw))), m -> aggregate(sequence(0, m - 1), 0, "
              f"(t, i) -> t + bit_count({word('aw')} ^ {word('bw')}))), 1)")
    return pairs.join(one, "a").join(two, "b").where(F.expr(
        f"{100 + percent}L * ({differ}) <= {100 - percent}L * (an + bn)")).select("a", "b")


def _of_pairs(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The nodes that are in a pair."""
    return nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")


def _links(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame | None:
    """The pairs ``(a, b)`` whose texts' sets are similar enough, by exact comparison; None if there
    is none to compare.

    Most nodes are in no pair, so a round reads bitmaps and texts of its own pairs' nodes, once each.
    """
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in text_chunks(batches, "text", CHUNK):
            # the other texts of a small chunk are of like size: they passed the size test
            _, other, edges = next(text_chunks(iter([rows]), "other", 1 << 62))
            ok = []
            for p, q in zip(shingle_sets(data, offs, width), shingle_sets(other, edges, width)):
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1)], names=["a", "b"]).filter(
                pa.array(ok, pa.bool_()))

    pairs = materialize(pairs, "candidates")
    if pairs.isEmpty():
        return None
    nodes = materialize(_of_pairs(nodes, pairs), "paired")
    pairs = materialize(_wide_enough(pairs, nodes, percent), "pairs")
    if pairs.isEmpty():
        return None
    texts = _node_texts(docs, _of_pairs(nodes, pairs), width)
    one = pairs.join(texts.select(F.col("node").alias("a"), "text"), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("other")), "b")
    links = materialize(two.select("a", "b", "text", "other").mapInArrow(
        lambda b: then_released(check(b)), "a long, b long"), "links")
    return None if links.isEmpty() else links


def _row_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(id, t, n, component, component_id)`` of every row of ``(id, t, text)``; ``component`` is
    a number of the component, null for a text without words."""
    signed = materialize(_signatures(docs, width, percent, frequency_sketch(docs.select("text"), width)),
                         "signatures")
    # one node for each distinct set; its arrays are equal in all rows
    by_set = signed.where("n > 0").groupBy(F.col("key").alias("node"))
    row = F.struct(F.col("id").isNull().alias("x"), "id", "t")
    nodes = materialize(by_set.agg(F.min("id").alias("low"), F.min(row).alias("carrier"), F.first("n").alias("n"),
                                   F.first("bits").alias("bits"), F.first("mins").alias("mins"),
                                   F.first("wide").alias("wide")), "nodes")
    postings = materialize(_postings(by_set.agg(
        F.first("n").alias("n"), F.first("match").alias("match"), F.first("tokens").alias("tokens"),
        F.first("parts").alias("parts"))), "postings")
    marks = materialize(nodes.join(_pairable(postings), "node", "left_semi").select(
        "node", "n", "mins", *[F.col("bits")[i].alias(f"b{i}") for i in range(BITS // 64)]), "marks")
    crowded = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > BUSY_NODES)
    busy = materialize(postings.select("token", "node").join(crowded.select("token"), "token", "left_semi"), "busy")

    labels = postings.sparkSession.createDataFrame([], "node long, label long")
    for seed in range(1 + ELEMENT_ROUNDS):
        keyed = (_element_buckets if seed else _min_hash_buckets)(busy, marks, labels)
        links = _links(_leader_pairs(keyed, 10 * seed, percent), docs, nodes, width, percent)
        if links is not None:
            labels = _merged(labels, links)
        elif seed:
            break                       # other leaders would seldom link more; the last round is exact
    links = _links(_cross_pairs(postings, marks, labels, percent), docs, nodes, width, percent)
    if links is not None:
        labels = _merged(labels, links)

    low = nodes.select("node", "low").join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("component"), "low")
    least = low.groupBy("component").agg(F.min("low").alias("component_id"))
    per_node = low.join(least, "component").select(F.col("node").alias("key"), "component", "component_id")
    linked = signed.where("n > 0").select("id", "t", "n", "key").join(per_node, "key")
    return linked.select("id", "t", "n", "component", "component_id").unionByName(
        signed.where("n = 0").select("id", "t", "n", F.lit(None).cast("long").alias("component"),
                                     F.col("id").alias("component_id")))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, t, text)``: ``t`` tells rows of one id, or without one, apart by their text."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))


def near_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets' Jaccard similarity is at least
    ``percent`` / 100: ``(id, n_shingles, component_id)`` per row.

    ``component_id`` is the smallest id reachable over similar pairs.  Null counts as
    empty; a text without words links with nothing and has its own id.  Equal texts link
    with each other, also under one id.  Rows without an id are linked like others and
    have the component's smallest id (null if none).  An empty table gives an empty
    result.
    """
    return _row_components(_rows(docs, id_col, text_col), width, percent).select(
        "id", F.col("n").alias("n_shingles"), "component_id")


def _pairable(postings: DataFrame) -> DataFrame:
    """The nodes that may be in a pair.

    A pair needs the smaller of its two numbers of shared elements.  So a node stays if it
    shares as many as its own number asks for, or, for some smaller number m, if at least m
    of its elements are shared with a node that asks for m at most.
    """
    # an element's two smallest (number, node): a node's peers ask for the first that is not its own
    ends = postings.groupBy("token").agg(F.min(F.struct("match", "node")).alias("first"))
    after = postings.join(ends, "token").where(F.col("node") != F.col("first.node")).groupBy("token").agg(
        F.min("match").alias("second"), F.first("first").alias("first"))
    asked = postings.join(after, "token").withColumn(
        "peer", F.when(F.col("node") == F.col("first.node"), F.col("second")).otherwise(F.col("first.match")))
    met = asked.groupBy("node").agg(F.max("match").alias("match"), F.count(F.lit(1)).alias("all"),
                                    *[F.count_if(F.col("peer") <= m).alias(f"at{m}") for m in range(1, MAX_MATCH)])
    enough = F.col("all") >= F.col("match")
    for m in range(1, MAX_MATCH):
        enough = enough | ((F.col("match") > m) & (F.col(f"at{m}") >= m))
    return met.where(enough).select("node")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: components of the labels' own edges and the links."""
    return materialize(connected(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
                                 .unionByName(links)), "labels")


def _node_texts(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``(node, text)`` of ``nodes``: one text per node, that of its carrier row, written once.

    Rows are found by id and text hash, so rows of one id, or without one, never meet each
    other's nodes.
    """
    carriers = materialize(nodes.select("node", F.coalesce("carrier.id", F.lit(0)).alias("k"),
                                        F.col("carrier.x").alias("x"), F.col("carrier.t").alias("t")), "carriers")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in text_chunks(batches, "text", CHUNK):
            keys = [set_key(s) if len(s) else 0 for s in shingle_sets(data, offs, width)]
            same = np.array(keys, np.int64) == rows.column(0).to_numpy(zero_copy_only=False)
            yield rows.filter(pa.array(same))

    texts = docs.where("text IS NOT NULL").select(
        F.coalesce("id", F.lit(0)).alias("k"), F.col("id").isNull().alias("x"), "t", "text")
    at = ["k", "x", "t"]
    # repeated rows bring a node's text more than once; the join has brought them together
    found = carriers.join(_likely(texts, carriers, *at), at).dropDuplicates(at)
    return materialize(found.select("node", "text").mapInArrow(
        lambda b: then_released(keyed(b)), "node long, text string"), "node-texts")


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, but for all rows except one of each
    component of near copies: the one with the smallest id (without ids: with the smallest
    text hash).  Of rows that repeat that one exactly, any one stays.  Texts without words
    link with nothing and all stay.
    """
    names = docs.columns
    rows = _rows(docs, id_col, text_col)
    found = materialize(_row_components(rows, width, percent), "components")
    row = F.struct(F.col("id").isNull().alias("x"), "id", "t")
    grouped = found.where("component IS NOT NULL").groupBy("component").agg(
        F.min(row).alias("r"), F.count(F.lit(1)).alias("size")).select(
        F.col("r.id").alias("__id"), F.col("r.t").alias("__t"), (F.col("size") > 1).alias("__many"))
    blank = found.where("component IS NULL").select(
        F.col("id").alias("__id"), F.col("t").alias("__t"), F.lit(False).alias("__many")).distinct()
    tagged = docs.withColumn("__t", F.xxhash64(text_col))
    kept = tagged.join(grouped.unionByName(blank).withColumnRenamed("__t", "__u"),
                       F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__u")))
    # a component of several rows may have its chosen row more than once
    order = Window.partitionBy(id_col, "__t").orderBy(F.lit(1))
    once = kept.where("__many").withColumn("__n", F.row_number().over(order)).where("__n = 1")
    return kept.where("NOT __many").select(*names).unionByName(once.select(*names))


def keep_rows(docs: DataFrame, components: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, with all their columns;
    rows without an id stay (see :func:`near_dedup` for exactly one row a component)."""
    names = docs.columns
    stay = components.where("id = component_id").select(F.col("id").alias(id_col)).distinct()
    return docs.join(stay, id_col, "left_semi").select(*names).unionByName(
        docs.where(F.col(id_col).isNull()))
