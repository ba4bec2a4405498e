"""Document fingerprints: invertible Bloom lookup sketches over paragraphs.

A text is cut into paragraphs, each hashed to a 64-bit digest.  A sketch has three
rows of cells; a digest falls into one cell of each row, where the count, the xor of
digests and the xor of their check values are kept.  Subtracting two versions' sketches
cell by cell leaves only the digests they don't share.  A cell with one digest left is
recognised by its check value and peeled: the digest is recovered and taken out of its
other cells, until all cells are empty.  If peeling gets stuck, it is retried with
larger sketches.  The recovered digests on either side give the likeness.

Everything is DataFrame and SQL expressions.  The next document of each row comes
from one shuffle by ranges of ids; the fingerprints are row-wise.

A paragraph is a run of words that ends where a hash of its last word and the next
meets a condition (about every ``MEAN_WORDS`` words), or after ``MAX_WORDS`` words.  So a
changed word alters the paragraphs around it only, and a text has as many paragraphs as
its length makes.  Digests are dealt by their high bits over blocks, as many as the number
of digests asks for; each block has its own sketch and retries.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a paragraph: about so many on average (a power of two), and at most.
MEAN_WORDS, MAX_WORDS = 16, 128
#: Digests of a block, at most on average; the number of blocks is a power of two.
BLOCK_DIGESTS = 24
#: Cells in each of a block's three rows: the first try and the retries.
ROW_CELLS = (11, 37, 149, 601, 2411)
#: Rows of a range of ids, which is one shuffle group, about; there are at most MAX_RANGES of
#: them, cut by about RANGE_SAMPLE sampled ids for each.
RANGE_IDS, RANGE_SAMPLE = 512, 16
MAX_RANGES = 1 << 14

_SPACES = r"[\\x20\\x09-\\x0D]+"
_CHECK = "xxhash64({0}, 7)"


# --- paragraphs ------------------------------------------------------------------------------

def word_hashes(text: str) -> str:
    """SQL: the hashes of a text column's words."""
    return f"transform(array_remove(split({text}, '{_SPACES}'), ''), w -> xxhash64(w))"


def starts(hashes: str) -> str:
    """SQL: where the paragraphs of a list of word hashes start, and their end.

    A paragraph starts at the first word, where a hash of the word before and the word
    says so, and ``MAX_WORDS`` after another start without one between.
    """
    cut = f"(({hashes}[i - 1] ^ shiftrightunsigned({hashes}[i], 23)) & {MEAN_WORDS - 1}L) = 0"
    at = f"filter(sequence(0, size({hashes})), i -> i = 0 OR i = size({hashes}) OR {cut})"
    runs = (f"flatten(transform(v, (x, i) -> if(i + 1 = size(v), array(x), "
            f"sequence(x, v[i + 1] - 1, {MAX_WORDS}))))")
    return f"if(size({hashes}) = 0, array(0), transform(array({at}), v -> {runs})[0])"


def digests(hashes: str, ends: str) -> str:
    """SQL: the distinct digests of the paragraphs between :func:`starts`."""
    return (f"array_distinct(transform(slice({ends}, 1, size({ends}) - 1), "
            f"(x, i) -> xxhash64(slice({hashes}, x + 1, {ends}[i + 1] - x))))")


def paragraphs(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Add the digests ``<prefix>_digests``."""
    h, at = f"{prefix}_hashes", f"{prefix}_starts"
    return (df.withColumn(h, F.expr(word_hashes(text)))
            .withColumn(at, F.expr(starts(h)))
            .withColumn(f"{prefix}_digests", F.expr(digests(h, at)))
            .drop(h, at))


def n_blocks(n: str) -> str:
    """SQL: the blocks that a number of digests is dealt over."""
    return f"cast(pow(2, ceil(log2(greatest({n}, {BLOCK_DIGESTS}) / {BLOCK_DIGESTS}.0D))) as int)"


def of_block(keys: str, block: str, blocks: str) -> str:
    """SQL: the digests of a block; cells are found by other bits."""
    return f"if({blocks} = 1, {keys}, filter({keys}, x -> pmod(shiftrightunsigned(x, 51), {blocks}) = {block}))"


# --- sketches -----------------------------------------------------------------------------------

def _cells(key: str, cells: int) -> str:
    """SQL: the fields with a digest's cells within the three rows."""
    return ", ".join(f"'c{r}', cast(pmod(shiftrightunsigned({key}, {17 * r}), {cells}L) as int)" for r in range(3))


def _rows(row: str) -> str:
    """SQL: a sketch's three rows, from the text of one with ``#`` as its number."""
    return "named_struct(" + ", ".join(f"'s{r}', {row.replace('#', str(r))}" for r in range(3)) + ")"


def sketch(keys: str, cells: int) -> str:
    """SQL: the sketch of an array of digests, three rows of ``cells`` structs ``(n, k, h)``.

    A digest's cells and check are computed once."""
    hashed = f"transform({keys}, x -> named_struct('k', x, 'h', {_CHECK.format('x')}, {_cells('x', cells)}))"
    cell = ("aggregate(filter(e, x -> x.c# = c), named_struct('n', 0, 'k', 0L, 'h', 0L), (y, x) -> "
            "named_struct('n', y.n + 1, 'k', y.k ^ x.k, 'h', y.h ^ x.h))")
    rows = _rows(f"transform(sequence(0, {cells - 1}), c -> {cell})")
    return f"transform(array({hashed}), e -> {rows})[0]"


def subtract(a: str, b: str) -> str:
    """SQL: the cellwise difference of two sketches."""
    cell = "named_struct('n', p.n - q.n, 'k', p.k ^ q.k, 'h', p.h ^ q.h)"
    rows = _rows(f"zip_with(v.a.s#, v.b.s#, (p, q) -> {cell})")
    return f"transform(array(named_struct('a', {a}, 'b', {b})), v -> {rows})[0]"


def peel(difference: str, cells: int) -> str:
    """SQL: ``(a, b)`` numbers of digests recovered from either side, null if stuck.

    By turns, all cells that hold one digest are read, and those digests removed from the cells
    that are not empty; it ends when there is no such cell.
    """
    # each step of aggregate() copies its state, so at the end the cells are dropped: the steps left
    # over cost nothing
    pure = (f"transform(array_distinct(transform(filter(concat(t.s.s0, t.s.s1, t.s.s2), x -> abs(x.n) = 1 "
            f"AND x.h = {_CHECK.format('x.k')}), x -> named_struct('n', x.n, 'k', x.k, 'h', x.h))), "
            f"x -> named_struct('n', x.n, 'k', x.k, 'h', x.h, {_cells('x.k', cells)}))")
    cell = ("if(x.n = 0 AND x.k = 0L, x, aggregate(filter(t.p, p -> p.c# = c), x, (y, p) -> "
            "named_struct('n', y.n - p.n, 'k', y.k ^ p.k, 'h', y.h ^ p.h)))")
    removed = _rows(f"transform(t.s.s#, (x, c) -> {cell})")
    ones = "size(filter(t.p, p -> p.n > 0))"

    def state(cells_sql: str, found: str, a: str, b: str, done: str) -> str:
        return f"named_struct('s', {cells_sql}, 'p', {found}, 'a', {a}, 'b', {b}, 'done', {done})"

    none = f"filter(array(named_struct('n', 0, 'k', 0L, 'h', 0L, {_cells('0L', cells)})), x -> false)"
    read = state("t.s", pure, "t.a", "t.b", "0")
    remove = state(removed, "t.p", f"t.a + {ones}", f"t.b + size(t.p) - {ones}", "0")
    empty = "forall(concat(t.s.s0, t.s.s1, t.s.s2), x -> x.n = 0 AND x.k = 0L)"
    end = state(_rows("filter(t.s.s#, x -> false)"), "t.p", "t.a", "t.b", f"if({empty}, 1, 2)")
    return (f"aggregate(sequence(0, {6 * cells + 1}), {state(difference, none, '0', '0', '0')}, (t, i) -> "
             f"if(t.done > 0, t, if(i % 2 = 0, {read}, if(size(t.p) = 0, {end}, {remove}))), "
             f"t -> if(t.done = 1, named_struct('a', t.a, 'b', t.b), null))")


def likeness(a: str, b: str, row_cells: tuple[int, ...] = ROW_CELLS) -> Column:
    """Shared paragraphs over all paragraphs of the texts with prefixes ``a`` and ``b``,
    from their sketches' differences, block by block, with sketches of ``row_cells``.

    Two texts without words are alike (1).  Should every retry of a block get stuck, its
    digests themselves are compared.
    """
    x, y = f"{a}_digests", f"{b}_digests"
    tries = [peel(subtract(sketch("v.x", c), sketch("v.y", c)), c) for c in row_cells]
    plain = ("named_struct('a', size(array_except(v.x, v.y)), 'b', size(array_except(v.y, v.x)))")
    found = f"coalesce({', '.join(tries)}, {plain})"
    blocks = (f"transform(array({n_blocks(f'greatest(size({x}), size({y}))')}), m -> transform(sequence(0, m - 1), "
              f"j -> named_struct('x', {of_block(x, 'j', 'm')}, 'y', {of_block(y, 'j', 'm')})))[0]")
    total = (f"aggregate(transform({blocks}, v -> {found}), named_struct('a', 0, 'b', 0), "
             f"(t, d) -> named_struct('a', t.a + d.a, 'b', t.b + d.b))")
    # |shared| = |x| - a;  |all| = |x| + b
    share = f"transform(array({total}), d -> (size({x}) - d.a) / cast(size({x}) + d.b as double))[0]"
    return F.expr(
        f"CASE WHEN size({x}) = 0 AND size({y}) = 0 THEN 1.0D "
        f"WHEN size({x}) = 0 OR size({y}) = 0 THEN 0.0D ELSE {share} END")


def fingerprint(prefix: str) -> Column:
    """The numbers of blocks and paragraphs and each block's smallest sketch as one string:
    per cell the count, the digests' xor and the low half of the checks' xor, in hex."""
    keys, blocks = f"{prefix}_digests", n_blocks(f"size({prefix}_digests)")
    cells = (f"transform(array({blocks}), m -> flatten(transform(transform(transform(sequence(0, m - 1), "
             f"j -> {of_block(keys, 'j', 'm')}), v -> {sketch('v', ROW_CELLS[0])}), "
             f"t -> concat(t.s0, t.s1, t.s2))))[0]")
    return F.expr(
        f"concat('iblt2:', {blocks}, ':', size({keys}), ':', array_join(transform({cells}, "
        f"x -> concat(lpad(lower(hex(x.n)), 2, '0'), lpad(lower(hex(x.k)), 16, '0'), "
        f"lpad(lower(hex(x.h & 4294967295L)), 8, '0'))), ''))")


# --- the next document and the edited text ------------------------------------------------------

def with_ranges(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``ids`` with the ``range`` of the column ``id``, and ``(range, last)``: the largest id of
    each range.

    Ranges are cut at quantiles of sampled ids, so that they hold about as many rows each
    whatever the gaps between ids; all rows of an id are in one.  The sample, at most about
    MAX_RANGES * RANGE_SAMPLE ids, decides on balance alone.  Rows without an id are dealt over
    negative ranges by a hash of their text.
    """
    named = ids.select("id").where("id IS NOT NULL")
    n = named.count()
    ranges = min(MAX_RANGES, n // RANGE_IDS + 1)
    share = int(1e9 * min(1.0, RANGE_SAMPLE * ranges / max(1, n)))
    picked = named.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000_000)) < share)
    sample = picked.agg(F.sort_array(F.collect_list("id"))).first()[0]
    cuts = sorted({float(sample[len(sample) * i // ranges]) for i in range(1, ranges)} if sample else ())

    def ranged(rows: DataFrame) -> DataFrame:
        place = F.lit(0)
        if cuts:
            rows = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="spot").transform(
                rows.withColumn("at", F.coalesce(F.col("id").cast("double"), F.lit(0.0))))
            place = F.col("spot").cast("int")
        return rows.withColumn("range", F.when(F.col("id").isNotNull(), place)
                               .otherwise(-1 - F.pmod(F.xxhash64("text"), F.lit(MAX_RANGES)))).drop("at", "spot")

    lasts = ranged(named.withColumn("text", F.lit(""))).groupBy("range").agg(F.max("id").alias("last"))
    return ranged(ids), lasts


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digested: bool = False) -> DataFrame:
    """``(id, text, next)``: each row's text and that of the row next in descending id;
    after the last comes the first.  With ``digested`` also both texts' paragraph digests,
    ``a_digests`` and ``b_digests``, made once per row before the shuffle.

    Rows are shuffled once, by ranges of ids.  A range's first row needs the text of an
    earlier range's last row, which is fetched by a broadcast of at most MAX_RANGES ids
    and enters the range as one more row.  Rows of one id follow each other by a hash of
    the text.  Rows without an id have no place in that order; their next text is empty.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own_rows, lasts = with_ranges(texts)
    by_range = Window.orderBy("range")              # at most MAX_RANGES rows
    before = F.lag("last").over(by_range)
    top = F.max("last").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edges = lasts.select("range", F.coalesce(before, top).alias("id"))
    edge_rows = texts.join(F.broadcast(edges), "id").select("range", F.lit(0).alias("own"), "id", "text")
    own_rows = own_rows.select("range", F.lit(1).alias("own"), "id", "text")
    if digested:
        edge_rows, own_rows = paragraphs(edge_rows, "text", "a"), paragraphs(own_rows, "text", "a")
    order = Window.partitionBy("range").orderBy("own", "id", F.xxhash64("text"))
    placed = edge_rows.unionByName(own_rows).withColumn("next", F.lag("text").over(order))
    named = F.col("id").isNotNull()
    columns = ["id", "text", F.when(named, F.coalesce("next", F.lit(""))).otherwise(F.lit("")).alias("next")]
    if digested:
        placed = placed.withColumn("b", F.lag("a_digests").over(order))
        none = F.array().cast("array<bigint>")
        columns += ["a_digests", F.when(named, F.coalesce("b", none)).otherwise(none).alias("b_digests")]
    return placed.where("own = 1").select(*columns)


def with_edit(rows: DataFrame) -> DataFrame:
    """Add ``n_chars`` and ``edited``: the last third of the code points replaced by the
    first as many (or all) of the next text."""
    return (rows.withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("edited", F.expr(
                "concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)), "
                "substring(next, 1, cast(n_chars div 3 as int)))")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    Returns ``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``.  Null counts as empty; equal texts have equal fingerprints; repeated
    ids and rows without an id are kept (see :func:`with_next`); an empty table gives an
    empty result.
    """
    rows = with_edit(with_next(docs, id_col, text_col, digested=True))
    rows = paragraphs(rows.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "e")
    # neighbours mostly share nothing, for which the smallest sketch is too small
    return rows.select(
        "id", "n_chars", "edited_sha256", fingerprint("a").alias("fingerprint"),
        fingerprint("e").alias("edited_fingerprint"),
        likeness("a", "e").alias("near_edited"), likeness("a", "b", ROW_CELLS[1:]).alias("near_next"))
