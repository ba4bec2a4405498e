"""Registered queries: the library's operators run over the driver tables.

The driver tables are not raster archives, so each query maps a table onto the
operator's data model (a "stand-in"), e.g. ``documents`` is the patch manifest,
``lang`` gives the split, and ``labels`` / ``benchmark`` / ``pages`` hold the
three component folders.  Every query reads whole tables; the SQL equivalents
live in ``rasterprep.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterprep.functions import arrays as A
from rasterprep.functions import paths as P
from rasterprep.functions import times as TM
from rasterprep.operators import evaluate as EV
from rasterprep.operators import feed as FD
from rasterprep.operators import inventory as INV
from rasterprep.operators import kernels as K
from rasterprep.operators import labels as LB
from rasterprep.operators import raster as R
from rasterprep.operators import runs as RU
from rasterprep.operators import sampling as S
from rasterprep.sinks import writers as SK
from rasterprep.sources import metadata as M


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    return M.read_metadata(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- manifest stand-in: documents as patches, lang as split ---------------------

ARCHIVE_ROOT = "s3://archive/"
LANG_SPLIT = {"en": "train", "fr": "validation", "de": "validation", "es": "test"}


def lang_split(c: str = "lang"):
    expr = None
    for lang, split in LANG_SPLIT.items():
        expr = (F.when(F.col(c) == lang, split) if expr is None
                else expr.when(F.col(c) == lang, split))
    return expr


def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, split, s1_path, s2_path, reference_path)`` per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    ident = F.col("doc_id").cast("string")
    return docs.select(
        "doc_id",
        lang_split().alias("split"),
        P.join_path(ARCHIVE_ROOT, F.lit("labels"), ident).alias("s1_path"),
        P.join_path(ARCHIVE_ROOT, F.lit("benchmark"), ident).alias("s2_path"),
        P.join_path(ARCHIVE_ROOT, F.lit("pages"), ident).alias("reference_path"),
    )


def component_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object listing: one object path per row of ``labels``, ``benchmark`` and ``pages``."""
    def objs(name: str, key: str, leaf: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(f"{ARCHIVE_ROOT}{name}/"), F.col(key).cast("string"),
                     F.lit(f"/{leaf}")).alias("path"))
    return (objs("labels", "doc_id", "quality.json")
            .unionByName(objs("benchmark", "item_id", "item.txt"))
            .unionByName(objs("pages", "page_id", "page.html")))


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = document_manifest(spark, sf_dir)
    return INV.validate_components(meta, component_inventory(spark, sf_dir), id_col="doc_id")


def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split: sampled documents (fraction 0.5) and how many have all three components."""
    meta = S.split_dataset(document_manifest(spark, sf_dir), 0.5, id_col="doc_id")
    checked = INV.validate_components(meta, component_inventory(spark, sf_dir), id_col="doc_id",
                                      keep=["split"])
    return (checked.groupBy("split")
            .agg(F.count(F.lit(1)).alias("sampled"),
                 F.count_if(F.col("all_exist")).alias("complete")))


def q_validate_components(spark, sf_dir):
    return validation(spark, sf_dir)


def q_missing_components(spark, sf_dir):
    return INV.missing_components(validation(spark, sf_dir))


def q_validation_summary(spark, sf_dir):
    return INV.validation_summary(validation(spark, sf_dir), 1.0)


def q_sample_stratified(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return S.sample_stratified(orders, 0.1, "o_orderkey", strata=["o_orderstatus"])


def q_sample_random(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return S.sample_random(cust, 0.1, "c_custkey")


def graded_documents(spark, sf_dir) -> DataFrame:
    """``(doc_id, quality)``: most documents have no label, so the key is mostly NULL."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


def q_sample_nullable_key(spark, sf_dir):
    return S.sample_random(graded_documents(spark, sf_dir), 0.3, ["quality", "doc_id"])


def q_shuffle_nullable_key(spark, sf_dir):
    return FD.epoch_shuffle(graded_documents(spark, sf_dir), ["quality", "doc_id"], epoch_col=None).drop("__n")


def q_split_dataset(spark, sf_dir):
    meta = document_manifest(spark, sf_dir).select("doc_id", "split")
    return S.split_counts(S.split_dataset(meta, 0.5, id_col="doc_id"))


def q_splits_exist(spark, sf_dir):
    meta = document_manifest(spark, sf_dir)
    return INV.splits_missing(meta, ["train", "validation", "test", "holdout"])


ROW_COUNT_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                    "events", "documents", "embeddings", "pages", "benchmark", "labels",
                    "conversations"]


def q_dataset_sizes(spark, sf_dir):
    return FD.dataset_sizes(document_manifest(spark, sf_dir))


def q_batch_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    placed = FD.epoch_shuffle(rows, "c_custkey", epoch_col=None).drop("__n")
    return SK.batch_ids(placed, 16)


def q_row_count(spark, sf_dir):
    out = None
    for name in ROW_COUNT_TABLES:
        one = INV.row_count(table(spark, sf_dir, name), name)
        out = one if out is None else out.unionByName(one)
    return out



# --- paths (P1-P9, X3) ------------------------------------------------------------

def q_path_prefix(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", "url",
                        P.field_prefix("url", 3, "/").alias("url_prefix3"),
                        P.field_prefix("url", 2, ".").alias("host_prefix2"))


def customer_meta(spark, sf_dir) -> DataFrame:
    """Patch-like names from ``customer``: 6-field radar names, 7- or 5-field patch ids."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    s1_name = F.when(F.col("c_mktsegment") != "HOUSEHOLD",
                     F.concat(F.lit("S1A_IW_"), F.col("c_mktsegment"), F.lit("_"),
                              F.col("c_nationkey").cast("string"), F.lit("_"), key, F.lit("_"),
                              F.pmod(F.col("c_custkey"), F.lit(7)).cast("string")))
    tail = F.when(F.col("c_acctbal") > 0,
                  F.concat(F.lit("_"), F.floor("c_acctbal").cast("string"), F.lit("_"),
                           F.pmod(F.col("c_custkey"), F.lit(3)).cast("string"))).otherwise(F.lit(""))
    patch_id = F.concat(F.lit("S2A_MSIL2A_"), F.col("c_mktsegment"), F.lit("_"),
                        F.col("c_nationkey").cast("string"), F.lit("_"), key, tail)
    return c.select("c_custkey", patch_id.alias("patch_id"), s1_name.alias("s1_name"))


def q_with_paths(spark, sf_dir):
    return R.with_paths(customer_meta(spark, sf_dir), "s3://archive")


def scheme_urls(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    s3url = F.regexp_replace(F.regexp_replace("url", r"^https://", "s3://"), r"^http://", "s3a://")
    return pages.select("page_id", s3url.alias("uri"))


def q_strip_scheme(spark, sf_dir):
    return scheme_urls(spark, sf_dir).select("page_id", "uri", P.strip_scheme("uri").alias("stripped"))


def q_normalize_uri(spark, sf_dir):
    u = scheme_urls(spark, sf_dir)
    return u.select("page_id", P.normalize_uri("uri").alias("normalized"),
                    P.normalize_uri(P.strip_scheme("uri"), cwd="/data").alias("normalized_local"))


def q_split_bucket_key(spark, sf_dir):
    u = scheme_urls(spark, sf_dir).withColumn("stripped", P.strip_scheme("uri"))
    return u.select("page_id", P.bucket_of("stripped").alias("bucket"),
                    P.key_of("stripped").alias("object_key"),
                    P.ensure_trailing_slash("stripped").alias("folder"),
                    P.valid_uri("uri").alias("valid"))


def part_meta(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    size = F.col("p_size").cast("string")
    meta = p.select(
        F.concat(F.lit("S2B_MSIL2A_"), size, F.lit("_"), key, F.lit("_T33_"), size, F.lit("_"), key)
        .alias("patch_id"),
        F.concat(F.lit("S1B_IW_GRDH_"), size, F.lit("_"), key, F.lit("_X")).alias("s1_name"))
    return R.with_paths(meta, "s3://archive")


def q_expand_band_paths(spark, sf_dir):
    return R.expand_band_paths(part_meta(spark, sf_dir))


# --- arrays (P10-P15, J4, J5) -----------------------------------------------------

def embedding_codes(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    codes = F.transform("embedding", lambda v: F.floor(F.abs(v.cast("double")) * 2000).cast("int"))
    return e.select("vec_id", codes.alias("codes"))


def q_remap_classes(spark, sf_dir):
    df = embedding_codes(spark, sf_dir).withColumn("idx", A.remap_classes("codes"))
    ok = df.where(~A.has_null("idx"))
    return ok.select("vec_id", F.posexplode(F.arrays_zip("codes", "idx")).alias("pixel", "z")) \
             .select("vec_id", F.col("pixel").cast("long").alias("pixel"),
                     F.col("z.codes").alias("code"), F.col("z.idx").alias("idx"))


def q_code_lookup(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    coded = p.select("p_partkey", (F.lit(100) + F.col("p_size") * 20
                                   + F.pmod(F.col("p_partkey"), F.lit(5))).cast("int").alias("code"))
    return R.code_lookup(coded, "code")


def q_stack_bands(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    bands = e.select("vec_id", *[F.slice("embedding", 1 + 16 * k, 16).alias(f"b{k}") for k in range(4)])
    image = K.with_stacked(bands, [f"b{k}" for k in range(4)])
    return (image.select("vec_id", F.posexplode("image").alias("pos", "v"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("value")))


def q_concat_channels(spark, sf_dir):
    """P12 by column functions: two tensors of two bands each."""
    e = table(spark, sf_dir, "embeddings")
    q = [F.slice("embedding", 1 + 16 * k, 16) for k in range(4)]
    image = A.concat_channels(A.stack_bands(q[0], q[1]), 2, A.stack_bands(q[2], q[3]), 2)
    return (e.select("vec_id", F.posexplode(image).alias("pos", "v"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("value")))


def q_pad_batches(spark, sf_dir):
    """P13 over whole batches: 8 x 8 bands padded to 9 x 12."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    padded = K.with_padded(e, "embedding", 8, 8, 9, 12)
    return (padded.select("vec_id", F.posexplode("padded").alias("pos", "v"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("value")))


def q_cast_items(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda v: v.cast("double") * 100)
    return (e.select("vec_id", F.posexplode(A.cast_items(scaled, "tinyint")).alias("pos", "v"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("int").alias("item")))


def q_to_bytes(spark, sf_dir):
    codes = SK.to_bytes(embedding_codes(spark, sf_dir), {"codes": "<u2"})
    return codes.select("vec_id", F.lower(F.hex("codes")).alias("codes_hex"))


def q_class_code_check(spark, sf_dir):
    """Codes that are no whole number of the class table are rejected, with a reason."""
    price = F.col("p_retailprice") / 2
    ps = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 3 == 0, price).otherwise(F.floor(price)).cast("double").alias("code"))
    idx = A.remap_classes(F.array("code"))[0]
    return ps.select("p_partkey", "code", idx.alias("idx"), F.when(A.has_fraction(F.array("code")), F.lit("bad_dtype"))
                     .when(idx.isNull(), F.lit("code_out_of_range")).alias("reason"))


def q_pad_to_size(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    padded = A.pad_to_size("embedding", 8, 8, 10, 10)
    return (e.select("vec_id", F.posexplode(padded).alias("pos", "v"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("v").cast("double").alias("value")))


def q_display_rgb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    # three planes of 22 values that share an end: all 64 values take part
    r, g, b = (F.slice("embedding", 1 + 21 * k, 22) for k in range(3))
    return (e.select("vec_id", F.posexplode(A.display_rgb(r, g, b, divisor=0.25)).alias("pos", "value"))
            .withColumn("pos", F.col("pos").cast("long")))


def q_assemble_patch(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    bands = li.select(F.col("l_orderkey").alias("patch_id"),
                      F.col("l_linenumber").cast("string").alias("band"),
                      F.col("l_extendedprice").alias("pixels"))
    names = [str(n) for n in range(1, 8)]       # every line number of the table
    wide = R.assemble_patch(bands, names)
    return wide.select(F.col("patch_id").alias("l_orderkey"), R.complete(names).alias("complete"),
                       *[F.col(f"`{n}`").alias(f"band_{n}") for n in names])


# --- labels (A4, P14, J6, T1, P28) ------------------------------------------------

def order_labels(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.collect_set(F.concat("l_returnflag", "l_linestatus")).alias("labels"))


def line_labels(spark, sf_dir) -> DataFrame:
    """One single-label list per line: the same label set as ``order_labels`` without
    grouping, so vocabularies need no per-order aggregation first."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.array(F.concat("l_returnflag", "l_linestatus")).alias("labels"))


def q_distinct_labels(spark, sf_dir):
    return LB.distinct_labels(line_labels(spark, sf_dir))


def q_label_vocab(spark, sf_dir):
    return LB.label_vocab(line_labels(spark, sf_dir))


def q_label_index_lookup(spark, sf_dir):
    labels = order_labels(spark, sf_dir)
    return LB.label_index_lookup(labels, LB.label_vocab(line_labels(spark, sf_dir)), "l_orderkey")


def q_multi_hot(spark, sf_dir):
    labels = order_labels(spark, sf_dir)
    hot = LB.with_multi_hot(labels, LB.label_vocab(line_labels(spark, sf_dir)), "l_orderkey")
    return hot.select("l_orderkey", F.posexplode("multi_hot").alias("idx", "hot")) \
              .select("l_orderkey", F.col("idx").cast("long").alias("idx"), F.col("hot").cast("int").alias("hot"))


def q_label_preview(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    sets = ev.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    return sets.select("user_id", A.label_preview("types").alias("preview"))


# --- events as run steps (P25, A3, P26, A8, P33) ----------------------------------

STEP_NAMES = ["view", "click", "purchase", "signup", "error"]


def q_steps_by_name(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    last = RU.last_value(ev, ["user_id", "event_type"], "value", ["ts", "event_id"])
    runs = user_profiles(last.withColumnRenamed("value", "duration"))
    return runs.select("user_id", *[RU.step_duration("steps", n).alias(n) for n in STEP_NAMES])


def user_profiles(steps: DataFrame) -> DataFrame:
    """One profile-like row per user; ``steps`` holds one row per user and event type, so a
    user's array has at most as many items as there are types."""
    return steps.groupBy("user_id").agg(F.collect_list(F.struct(
        F.col("event_type").alias("name"), "duration")).alias("steps"))


def q_total_duration(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    per_type = ev.groupBy("user_id", "event_type").agg(F.sum("value").alias("duration"),
                                                       F.count(F.lit(1)).alias("n"))
    counts = per_type.groupBy("user_id").agg(F.sum("n").alias("steps"))
    runs = user_profiles(per_type).select("user_id", F.round(RU.total_duration("steps"), 6).alias("total_duration"))
    return runs.join(counts, "user_id")


def q_summary_fields(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    summary = F.from_json("props", "k int, missing string")
    return ev.select("event_id", summary.alias("summary")).select(
        "event_id", F.col("summary.k").alias("k"), F.col("summary.missing").alias("missing"),
        RU.required(["summary.k"]).alias("complete"))


def q_run_metrics(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return RU.last_value(ev, ["user_id", "event_type"], "value", ["ts", "event_id"])


def q_step_times(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return ev.select("event_id", TM.log_time("ts").alias("log_time"), TM.iso_time("ts").alias("iso_time"),
                     F.unix_seconds(TM.parse_time(TM.log_time("ts"))).alias("epoch_s"))


# --- run keys and records (P22-P24, X5-X10) ---------------------------------------

def run_keys(spark, sf_dir, *more: str) -> DataFrame:
    """``(l_orderkey, l_linenumber, *more, key)``: an object key per line, built once."""
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_discount").cast("string")
    ln = F.col("l_linenumber").cast("string")
    g = (F.pmod(F.col("l_quantity").cast("int"), F.lit(4)) + 1).cast("string")
    root = F.lit("user/exp/")
    key = (F.when(F.col("l_returnflag") == "A",
                   F.concat(root, F.lit("petastorm/frac_"), d, F.lit("/exec_"), ln,
                            F.lit("/profile/conversion_profile.json")))
            .when(F.col("l_returnflag") == "N",
                  F.concat(root, F.lit("petastorm/frac_"), d, F.lit("/exec_"), ln,
                           F.lit("/train_gpu"), g, F.lit("_profile.json")))
            .otherwise(F.concat(root, F.lit("local/frac_"), d, F.lit("/train_"), g,
                                F.lit("gpu_profile.json"))))
    # ``inline`` of a one-element array computes the key once per row: what is parsed from
    # it stays above the generator instead of copying the key expression
    return li.select("l_orderkey", "l_linenumber", *more, F.inline(F.array(F.struct(key.alias("key")))))


def run_profiles(spark, sf_dir) -> DataFrame:
    """A run profile per line: its key, steps (some are missing) and summary."""
    rows = run_keys(spark, sf_dir, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey")
    order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("int")
    price, quantity = F.col("l_extendedprice").cast("double"), F.col("l_quantity").cast("double")

    def step(name: str, present, duration):
        return F.when(present, F.struct(F.lit(name).alias("name"), duration.alias("duration")))

    steps = [step(n, (order + k) % 7 != 0, quantity * (k + 1)) for k, n in enumerate(RU.CONVERSION_STEPS)]
    steps += [step("training", order % 11 != 0, price), step("evaluation", order % 13 != 0, price / 4)]
    none = F.lit(None).cast("int")
    summary = F.struct(
        F.when(line != 7, quantity * 10).alias("total_duration"),
        F.col("l_partkey").cast("long").alias("train_samples"), F.col("l_suppkey").cast("long").alias("validation_samples"),
        line.cast("long").alias("test_samples"),
        F.when(order % 2 != 0, line).alias("train_partitions"), none.alias("validation_partitions"),
        none.alias("test_partitions"), *[(line + 100 * (k + 1)).alias(f"{sp}_rdd_partitions")
                                         for k, sp in enumerate(("train", "validation", "test"))],
        (line * 16).alias("global_batch_size"), F.col("l_discount").cast("double").alias("learning_rate"),
        F.col("l_tax").cast("double").alias("test_accuracy"))
    return rows.select("l_orderkey", "l_linenumber", "key", summary.alias("summary"),
                       F.filter(F.array(*steps), lambda s: s.isNotNull()).alias("steps"))


def q_conversion_runs(spark, sf_dir):
    return RU.conversion_runs(run_profiles(spark, sf_dir))


def q_conversion_runs_ext(spark, sf_dir):
    return RU.conversion_runs_ext(run_profiles(spark, sf_dir), part_index=3)


def q_training_runs_batch(spark, sf_dir):
    return RU.training_runs_batch(run_profiles(spark, sf_dir), executors=7)


def q_training_runs_lr(spark, sf_dir):
    return RU.training_runs_lr(run_profiles(spark, sf_dir))


def q_require_steps(spark, sf_dir):
    runs = run_profiles(spark, sf_dir)
    return runs.where(RU.has_steps("steps", ["read_metadata", "training"])).select("l_orderkey", "l_linenumber")


def q_drop_null_records(spark, sf_dir):
    keys = run_keys(spark, sf_dir)
    records = keys.select("l_orderkey", "l_linenumber", P.run_executors("key").alias("executor"),
                          P.gpu_count("key").alias("gpus"))
    return RU.drop_null_records(records, ["executor", "gpus"])


def q_parse_run_path(spark, sf_dir):
    r = run_keys(spark, sf_dir)
    return r.select("l_orderkey", "l_linenumber", "key",
                    P.run_fraction("key").alias("fraction"),
                    P.run_executors("key").alias("executor"),
                    P.run_fraction("key", last=False).alias("fraction_first"))


def q_parse_gpu_count(spark, sf_dir):
    r = run_keys(spark, sf_dir)
    return r.select("l_orderkey", "l_linenumber",
                    P.gpu_count("key").alias("gpus"),
                    P.gpu_count("key", P.GPU_FILE_PATTERN_LOOSE).alias("gpus_loose"),
                    P.gpu_count_any("key").alias("gpus_any"))


def q_fraction_regex(spark, sf_dir):
    r = run_keys(spark, sf_dir)
    return r.select("l_orderkey", "l_linenumber", P.fraction_regex("key").alias("fraction"))


def q_run_record_filter(spark, sf_dir):
    r = RU.suffix_filter(run_keys(spark, sf_dir), "_profile.json", "key")
    # parsed once, inside a second generator that the filter stays above
    parts = F.struct(P.run_fraction("key").alias("fraction"), P.run_executors("key").alias("executor"))
    parsed = r.select("l_orderkey", "l_linenumber", "key", F.inline(F.array(parts)))
    kept = RU.run_record_filter(parsed)
    return kept.select("l_orderkey", "l_linenumber", "fraction", "executor",
                       RU.exec_only("key", 7).alias("exec_match"),
                       P.has_run_depth("key", 5, 3).alias("deep"))


# --- speedup and curves (C1, J7, W5, A5, A6, O1) ----------------------------------

def flag_runs(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag", "l_linenumber").agg(
        F.count(F.lit(1)).cast("double").alias("total_time"))


def q_speedup(spark, sf_dir):
    return RU.speedup(flag_runs(spark, sf_dir), "l_linenumber", 1, key="l_returnflag")


def q_speedup_window(spark, sf_dir):
    return RU.speedup_window(flag_runs(spark, sf_dir), "l_linenumber", 1, key="l_returnflag")


def q_group_curves(spark, sf_dir):
    sp = RU.speedup_window(flag_runs(spark, sf_dir), "l_linenumber", 1, key="l_returnflag")
    curves = RU.group_curves(sp, "l_linenumber", "speedup", key="l_returnflag")
    return curves.select("l_returnflag", F.posexplode("points").alias("point", "p")).select(
        "l_returnflag", (F.col("point") + 1).cast("long").alias("point"), "p.*")


def q_curve_points(spark, sf_dir):
    sp = RU.speedup(flag_runs(spark, sf_dir), "l_linenumber", 1, key="l_returnflag")
    return RU.curve_points(sp, "l_linenumber", "speedup", key="l_returnflag")


def q_ideal_line(spark, sf_dir):
    return RU.ideal_line(flag_runs(spark, sf_dir), "l_linenumber")


def q_sort_runs(spark, sf_dir):
    # ids that increase along the sorted partitions show the order the sort produced
    runs = RU.sort_runs(flag_runs(spark, sf_dir), ["l_returnflag", "l_linenumber"])
    runs = runs.withColumn("__at", F.monotonically_increasing_id())
    w = Window.orderBy("__at")                  # run tables hold one row per run
    return runs.withColumn("rank", F.row_number().over(w).cast("long")).drop("__at")


# --- sizes and plans from counts (P19-P21, P27, P29) -------------------------------

def status_counts(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    counts = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy()))


def q_fraction_label(spark, sf_dir):
    c = status_counts(spark, sf_dir).withColumn("fraction", F.col("n") / F.col("total"))
    return c.select("o_orderstatus", "n", "fraction", P.fraction_label("fraction").alias("label"))


def q_dataset_bytes(spark, sf_dir):
    c = status_counts(spark, sf_dir)
    return c.select("o_orderstatus", "n", SK.dataset_bytes(F.col("n")).alias("bytes"),
                    SK.dataset_gib(F.col("n")).alias("gib"))


def q_partition_plan(spark, sf_dir):
    c = status_counts(spark, sf_dir)
    parts = SK.partition_plan(F.col("n"), cores=3, executors=8)
    return c.select("o_orderstatus", parts.alias("partitions"),
                    SK.tasks_per_executor(parts, 8).alias("tasks_per_executor"))


def q_steps_per_epoch(spark, sf_dir):
    c = status_counts(spark, sf_dir)
    gb = FD.global_batch(16, 4)
    steps = FD.steps_per_epoch(F.col("n"), gb, 30).cast("long")
    return c.select("o_orderstatus", steps.alias("steps"), (steps * gb).cast("long").alias("samples_per_epoch"))


def q_run_grid(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    fr = li.select(F.col("l_discount").alias("fraction")).distinct()
    conv = RU.run_grid(fr, [8, 5, 2, 1], "n").select(
        F.lit("convert").alias("kind"), "fraction", "n",
        P.output_dir(F.lit("s3://bucket/user"), F.lit("exp"), "fraction", "n").alias("output_dir"))
    train = RU.run_grid(fr, [4, 3, 2, 1], "n").select(
        F.lit("train").alias("kind"), "fraction", "n",
        FD.global_batch(16, F.col("n")).alias("global_batch"),
        FD.scaled_lr(0.001, F.col("n")).alias("learning_rate"))
    return RU.append_records([conv, train])


# --- feed planning (F1-F4) ---------------------------------------------------------

FEED_EPOCHS, FEED_BATCH, FEED_REPLICAS = 2, 64, 4


def feed_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey")


def q_repeat_epochs(spark, sf_dir):
    return FD.repeat_epochs(feed_orders(spark, sf_dir), FEED_EPOCHS)


def _shuffled(spark, sf_dir):
    df = FD.repeat_epochs(feed_orders(spark, sf_dir), FEED_EPOCHS)
    return FD.epoch_shuffle(df, "o_orderkey", seed=42)


def q_epoch_shuffle(spark, sf_dir):
    return _shuffled(spark, sf_dir).drop("__n")


def q_assign_batches(spark, sf_dir):
    return FD.assign_batches(_shuffled(spark, sf_dir), FEED_BATCH).drop("__n")


def q_assign_shards(spark, sf_dir):
    df = FD.assign_batches(_shuffled(spark, sf_dir), FEED_BATCH)
    return FD.assign_shards(df, FEED_REPLICAS).drop("__n")


# --- evaluation (A9, A10) ----------------------------------------------------------

def embedding_predictions(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    bits = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1),
                       lambda i: F.pmod((F.col("label") / F.pow(F.lit(2), i % 4)).cast("int"), F.lit(2)))
    pred = F.transform("embedding", lambda v: F.when(v > 0, 1).otherwise(0))
    sig = F.transform("embedding", lambda v: 1.0 / (1.0 + F.exp(-v.cast("double"))))
    p_true = F.zip_with(sig, bits, lambda p, t: F.when(t == 1, p).otherwise(1.0 - p))
    return e.select("vec_id", pred.alias("pred"), bits.alias("truth"), p_true.alias("p_true"))


def q_pixel_accuracy(spark, sf_dir):
    acc = EV.pixel_accuracy(embedding_predictions(spark, sf_dir), "pred", "truth")
    return acc.select(F.round("pixel_accuracy", 9).alias("pixel_accuracy"))


def q_pixel_log_loss(spark, sf_dir):
    ll = EV.pixel_log_loss(embedding_predictions(spark, sf_dir), "p_true")
    return ll.select(F.round("pixel_log_loss", 9).alias("pixel_log_loss"))


# --- set operations and previews (T2, O3) ------------------------------------------

def q_append_records(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"))
    s = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return RU.append_records([c, s])


def q_head(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.array("p_brand").alias("labels"))
    vocab = LB.label_vocab(part).withColumnRenamed("label", "p_brand")
    return S.head(vocab, 5, ["idx"])


def registry() -> dict:
    """All registered queries, keyed by name (functions named ``q_<key>``)."""
    return {name[2:]: fn for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}
