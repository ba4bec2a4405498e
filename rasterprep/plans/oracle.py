"""DuckDB SQL equivalents of the registered queries (``plans.standins``).

Conventions: ``0.1::DOUBLE`` (a bare 0.1 is DECIMAL in DuckDB), ``round_even``
for Spark's ``bround``, ``md5`` and ``regexp_replace`` agree between engines.
"""

from __future__ import annotations

LANG_SPLIT_SQL = ("CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'validation' "
                  "WHEN 'de' THEN 'validation' WHEN 'es' THEN 'test' END")

VALIDATION_CTE = f"""
meta AS (
  SELECT doc_id, {LANG_SPLIT_SQL} AS split FROM documents
),
val AS (
  SELECT m.doc_id,
         (l.doc_id IS NOT NULL) AS s1_exists,
         (b.item_id IS NOT NULL) AS s2_exists,
         (p.page_id IS NOT NULL) AS ref_exists
  FROM meta m
  LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = m.doc_id
  LEFT JOIN (SELECT DISTINCT item_id FROM benchmark) b ON b.item_id = m.doc_id
  LEFT JOIN (SELECT DISTINCT page_id FROM pages) p ON p.page_id = m.doc_id
)"""

SQL: dict[str, str] = {}

SQL["flagship"] = f"""
WITH {VALIDATION_CTE},
ranked AS (
  SELECT doc_id, split,
         row_number() OVER (PARTITION BY split ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
         count(*) OVER (PARTITION BY split) AS n
  FROM meta WHERE split IN ('train', 'validation', 'test')
)
SELECT r.split, count(*) AS sampled,
       count(*) FILTER (WHERE v.s1_exists AND v.s2_exists AND v.ref_exists) AS complete
FROM ranked r JOIN val v USING (doc_id)
WHERE r.rn <= round_even(r.n * 0.5::DOUBLE, 0)
GROUP BY r.split
"""

SQL["validate_components"] = f"""
WITH {VALIDATION_CTE}
SELECT doc_id, (s1_exists AND s2_exists AND ref_exists) AS all_exist, s1_exists, s2_exists, ref_exists
FROM val
"""

SQL["missing_components"] = f"""
WITH {VALIDATION_CTE}
SELECT doc_id, (s1_exists AND s2_exists AND ref_exists) AS all_exist, s1_exists, s2_exists, ref_exists
FROM val WHERE NOT (s1_exists AND s2_exists AND ref_exists)
"""

SQL["validation_summary"] = f"""
WITH {VALIDATION_CTE}
SELECT count(*) FILTER (WHERE s1_exists AND s2_exists AND ref_exists) AS all_files_found,
       count(*) FILTER (WHERE NOT (s1_exists AND s2_exists AND ref_exists)) AS not_found,
       count(*) AS total_checked,
       1.0::DOUBLE AS fraction_used
FROM val
"""

SQL["sample_stratified"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM (
  SELECT o_orderkey, o_orderstatus, o_totalprice,
         row_number() OVER (PARTITION BY o_orderstatus
                            ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus) AS n
  FROM orders WHERE o_orderstatus IS NOT NULL
) WHERE rn <= round_even(n * 0.1::DOUBLE, 0)
"""

SQL["sample_random"] = """
SELECT c_custkey, c_name, c_mktsegment FROM (
  SELECT c_custkey, c_name, c_mktsegment,
         row_number() OVER (ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS rn,
         count(*) OVER () AS n
  FROM customer
) WHERE rn <= round_even(n * 0.1::DOUBLE, 0)
"""

SQL["split_dataset"] = f"""
WITH meta AS (SELECT doc_id, {LANG_SPLIT_SQL} AS split FROM documents),
ranked AS (
  SELECT doc_id, split,
         row_number() OVER (PARTITION BY split ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
         count(*) OVER (PARTITION BY split) AS n
  FROM meta WHERE split IN ('train', 'validation', 'test')
),
s AS (SELECT * FROM ranked WHERE rn <= round_even(n * 0.5::DOUBLE, 0))
SELECT COALESCE(split, 'total') AS split, count(*) AS rows FROM s GROUP BY ROLLUP (split)
"""

SQL["splits_exist"] = f"""
SELECT split FROM (VALUES ('train'), ('validation'), ('test'), ('holdout')) AS e(split)
WHERE split NOT IN (SELECT {LANG_SPLIT_SQL} FROM documents WHERE {LANG_SPLIT_SQL} IS NOT NULL)
"""

SQL["row_count"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}"
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"])

# --- paths ----------------------------------------------------------------------------

SQL["path_prefix"] = r"""
SELECT page_id, url,
       regexp_replace(url, '((?:[^/]+/){2}[^/]+)/.*', '\1') AS url_prefix3,
       regexp_replace(url, '((?:[^\.]+\.){1}[^\.]+)\..*', '\1') AS host_prefix2
FROM pages
"""

CUSTOMER_META = r"""
cm AS (
  SELECT c_custkey,
         'S2A_MSIL2A_' || c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR)
           || CASE WHEN c_acctbal > 0 THEN '_' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) || '_' || CAST(c_custkey % 3 AS VARCHAR) ELSE '' END AS patch_id,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN
           'S1A_IW_' || c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR) || '_' || CAST(c_custkey % 7 AS VARCHAR)
         END AS s1_name
  FROM customer
)"""

SQL["with_paths"] = rf"""
WITH {CUSTOMER_META}
SELECT c_custkey, patch_id, s1_name,
       's3://archive/BigEarthNet-S1/' || regexp_replace(s1_name, '((?:[^_]+_){{4}}[^_]+)_.*', '\1') || '/' || s1_name AS s1_path,
       's3://archive/BigEarthNet-S2/' || regexp_replace(patch_id, '((?:[^_]+_){{5}}[^_]+)_.*', '\1') || '/' || patch_id AS s2_path,
       's3://archive/Reference_Maps/' || regexp_replace(patch_id, '((?:[^_]+_){{5}}[^_]+)_.*', '\1') || '/' || patch_id AS reference_path
FROM cm
"""

SCHEME_URLS = r"""
u AS (
  SELECT page_id, regexp_replace(regexp_replace(url, '^https://', 's3://'), '^http://', 's3a://') AS uri
  FROM pages
)"""

SQL["strip_scheme"] = f"""
WITH {SCHEME_URLS}
SELECT page_id, uri, replace(replace(uri, 's3a://', ''), 's3://', '') AS stripped FROM u
"""

SQL["normalize_uri"] = rf"""
WITH {SCHEME_URLS}, v AS (SELECT page_id, uri, replace(replace(uri, 's3a://', ''), 's3://', '') AS stripped FROM u)
SELECT page_id,
       regexp_replace(uri, '^s3a://', 's3://') AS normalized,
       CASE WHEN regexp_matches(stripped, '^[A-Za-z][A-Za-z0-9+.\-]*://') THEN regexp_replace(stripped, '^s3a://', 's3://')
            WHEN starts_with(stripped, '/') THEN 'file://' || stripped
            ELSE 'file:///data/' || stripped END AS normalized_local
FROM v
"""

SQL["split_bucket_key"] = f"""
WITH {SCHEME_URLS}, v AS (SELECT page_id, uri, replace(replace(uri, 's3a://', ''), 's3://', '') AS stripped FROM u)
SELECT page_id,
       regexp_extract(stripped, '^([^/]*)', 1) AS bucket,
       CASE WHEN contains(stripped, '/') THEN regexp_extract(stripped, '^[^/]*/(.*)$', 1) END AS object_key,
       CASE WHEN ends_with(stripped, '/') THEN stripped ELSE stripped || '/' END AS folder,
       COALESCE(starts_with(uri, 's3://'), false) AS valid
FROM v
"""

SQL["expand_band_paths"] = r"""
WITH pm AS (
  SELECT 'S2B_MSIL2A_' || CAST(p_size AS VARCHAR) || '_' || CAST(p_partkey AS VARCHAR) || '_T33_' || CAST(p_size AS VARCHAR) || '_' || CAST(p_partkey AS VARCHAR) AS patch_id,
         'S1B_IW_GRDH_' || CAST(p_size AS VARCHAR) || '_' || CAST(p_partkey AS VARCHAR) || '_X' AS s1_name
  FROM part
), wp AS (
  SELECT patch_id, s1_name,
         's3://archive/BigEarthNet-S1/' || regexp_replace(s1_name, '((?:[^_]+_){4}[^_]+)_.*', '\1') || '/' || s1_name AS s1_path,
         's3://archive/BigEarthNet-S2/' || regexp_replace(patch_id, '((?:[^_]+_){5}[^_]+)_.*', '\1') || '/' || patch_id AS s2_path,
         's3://archive/Reference_Maps/' || regexp_replace(patch_id, '((?:[^_]+_){5}[^_]+)_.*', '\1') || '/' || patch_id AS reference_path
  FROM pm
)
SELECT patch_id, band, path FROM (
  SELECT patch_id, 'VV' AS band, s1_path || '/' || s1_name || '_VV.tif' AS path FROM wp
  UNION ALL SELECT patch_id, 'VH', s1_path || '/' || s1_name || '_VH.tif' FROM wp
  UNION ALL SELECT patch_id, 'B02', s2_path || '/' || patch_id || '_B02.tif' FROM wp
  UNION ALL SELECT patch_id, 'B03', s2_path || '/' || patch_id || '_B03.tif' FROM wp
  UNION ALL SELECT patch_id, 'B04', s2_path || '/' || patch_id || '_B04.tif' FROM wp
  UNION ALL SELECT patch_id, 'B08', s2_path || '/' || patch_id || '_B08.tif' FROM wp
  UNION ALL SELECT patch_id, 'reference_map', reference_path || '/' || patch_id || '_reference_map.tif' FROM wp
)
"""

# --- arrays ---------------------------------------------------------------------------


def _class_table_sql() -> str:
    from rasterprep.schemas import CLASS_CODES
    rows = ", ".join(f"({c}, {i})" for i, c in enumerate(CLASS_CODES))
    return f"(SELECT * FROM (VALUES {rows}) AS t(code, idx))"


CLASS_TABLE = _class_table_sql()

SQL["remap_classes"] = f"""
WITH px AS (
  SELECT vec_id,
         unnest(range(0, len(embedding))) AS pixel,
         unnest(list_transform(embedding, lambda v: CAST(floor(abs(CAST(v AS DOUBLE)) * 2000) AS INTEGER))) AS code
  FROM embeddings
), bad AS (SELECT DISTINCT vec_id FROM px WHERE code >= 1000 OR code < 0)
SELECT px.vec_id, px.pixel, px.code, COALESCE(ct.idx, 0) AS idx
FROM px LEFT JOIN {CLASS_TABLE} ct ON ct.code = px.code
WHERE px.vec_id NOT IN (SELECT vec_id FROM bad)
"""

SQL["code_lookup"] = f"""
WITH coded AS (SELECT p_partkey, CAST(100 + p_size * 20 + p_partkey % 5 AS INTEGER) AS code FROM part)
SELECT p_partkey, coded.code,
       CASE WHEN coded.code >= 0 AND coded.code < 1000 THEN COALESCE(ct.idx, 0) END AS idx,
       CASE WHEN coded.code >= 0 AND coded.code < 1000 THEN 'ok' ELSE 'code_out_of_range' END AS status
FROM coded LEFT JOIN {CLASS_TABLE} ct ON ct.code = coded.code
"""

SQL["stack_bands"] = """
SELECT vec_id, pos, CAST(embedding[(pos % 4) * 16 + (pos // 4) + 1] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest(range(0, 64)) AS pos FROM embeddings)
"""

SQL["concat_channels"] = SQL["stack_bands"]

SQL["pad_batches"] = """
SELECT vec_id, pos,
       CASE WHEN pos % 12 < 8 AND pos // 12 < 8 THEN CAST(embedding[(pos // 12) * 8 + pos % 12 + 1] AS DOUBLE) ELSE 0.0 END AS value
FROM (SELECT vec_id, embedding, unnest(range(0, 108)) AS pos FROM embeddings)
"""

SQL["cast_items"] = """
SELECT vec_id, pos, CAST(trunc(CAST(embedding[pos + 1] AS DOUBLE) * 100) AS INTEGER) AS item
FROM (SELECT vec_id, embedding, unnest(range(0, 64)) AS pos FROM embeddings)
"""

SQL["to_bytes"] = """
WITH c AS (
  SELECT vec_id, [CAST(floor(abs(CAST(v AS DOUBLE)) * 2000) AS INTEGER) for v in embedding] AS codes FROM embeddings)
SELECT vec_id, array_to_string([printf('%02x%02x', v % 256, v // 256) for v in codes], '') AS codes_hex FROM c
"""

SQL["class_code_check"] = f"""
WITH p AS (
  SELECT p_partkey, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_retailprice / 2 ELSE floor(p_retailprice / 2) END AS DOUBLE) AS code
  FROM part)
SELECT p_partkey, p.code,
       CASE WHEN p.code = floor(p.code) AND p.code >= 0 AND p.code < 1000 THEN COALESCE(ct.idx, 0) END AS idx,
       CASE WHEN p.code <> floor(p.code) THEN 'bad_dtype'
            WHEN p.code < 0 OR p.code >= 1000 THEN 'code_out_of_range' END AS reason
FROM p LEFT JOIN {CLASS_TABLE} ct ON ct.code = p.code
"""

SQL["pad_to_size"] = """
SELECT vec_id, pos,
       CASE WHEN pos % 10 < 8 AND pos // 10 < 8 THEN CAST(embedding[(pos // 10) * 8 + pos % 10 + 1] AS DOUBLE) ELSE 0.0 END AS value
FROM (SELECT vec_id, embedding, unnest(range(0, 100)) AS pos FROM embeddings)
"""

SQL["display_rgb"] = """
SELECT vec_id, pos,
       greatest(0.0, least(1.0, CAST(embedding[(pos % 3) * 21 + (pos // 3) + 1] AS DOUBLE) / 0.25)) AS value
FROM (SELECT vec_id, embedding, unnest(range(0, 66)) AS pos FROM embeddings)
"""

SQL["assemble_patch"] = """
SELECT *, band_1 IS NOT NULL AND band_2 IS NOT NULL AND band_3 IS NOT NULL AND band_4 IS NOT NULL AND band_5 IS NOT NULL AND band_6 IS NOT NULL AND band_7 IS NOT NULL AS complete FROM (
SELECT l_orderkey,
       max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS band_1,
       max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS band_2,
       max(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS band_3,
       max(CASE WHEN l_linenumber = 4 THEN l_extendedprice END) AS band_4,
       max(CASE WHEN l_linenumber = 5 THEN l_extendedprice END) AS band_5,
       max(CASE WHEN l_linenumber = 6 THEN l_extendedprice END) AS band_6,
       max(CASE WHEN l_linenumber = 7 THEN l_extendedprice END) AS band_7
FROM lineitem GROUP BY l_orderkey)
"""

# --- labels ---------------------------------------------------------------------------

ORDER_LABELS = """
ol AS (SELECT l_orderkey, list(DISTINCT l_returnflag || l_linestatus) AS labels FROM lineitem GROUP BY l_orderkey),
vocab AS (
  SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx
  FROM (SELECT DISTINCT l_returnflag || l_linestatus AS label FROM lineitem)
)"""

SQL["distinct_labels"] = "SELECT DISTINCT l_returnflag || l_linestatus AS label FROM lineitem"

SQL["label_vocab"] = f"WITH {ORDER_LABELS} SELECT label, idx FROM vocab"

SQL["label_index_lookup"] = f"""
WITH {ORDER_LABELS}
SELECT e.l_orderkey, e.label, v.idx
FROM (SELECT l_orderkey, unnest(labels) AS label FROM ol) e LEFT JOIN vocab v USING (label)
"""

SQL["multi_hot"] = f"""
WITH {ORDER_LABELS}
SELECT ol.l_orderkey, v.idx, CAST(list_contains(ol.labels, v.label) AS INTEGER) AS hot
FROM ol, vocab v
"""

SQL["label_preview"] = """
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type))[1:2], ', ') AS preview
FROM events GROUP BY user_id
"""

# --- events ---------------------------------------------------------------------------

LAST_EVENT = """
last AS (
  SELECT user_id, event_type, value FROM (
    SELECT user_id, event_type, value,
           row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
    FROM events
  ) WHERE rn = 1
)"""

SQL["steps_by_name"] = f"""
WITH {LAST_EVENT}
SELECT user_id,
       max(CASE WHEN event_type = 'view' THEN value END) AS "view",
       max(CASE WHEN event_type = 'click' THEN value END) AS "click",
       max(CASE WHEN event_type = 'purchase' THEN value END) AS "purchase",
       max(CASE WHEN event_type = 'signup' THEN value END) AS "signup",
       max(CASE WHEN event_type = 'error' THEN value END) AS "error"
FROM last GROUP BY user_id
"""

SQL["total_duration"] = """
SELECT user_id, round(sum(value), 6) AS total_duration, count(*) AS steps FROM events GROUP BY user_id
"""

SQL["summary_fields"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing') AS missing,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL AS complete
FROM events
"""

SQL["run_metrics"] = f"WITH {LAST_EVENT} SELECT user_id, event_type, value FROM last"

SQL["step_times"] = """
SELECT event_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS log_time,
       CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso_time,
       CAST(epoch(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS epoch_s
FROM events
"""

# --- run keys ------------------------------------------------------------------------------

RUN_PATHS = """
rp AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'A' THEN 'user/exp/petastorm/frac_' || CAST(l_discount AS VARCHAR) || '/exec_' || CAST(l_linenumber AS VARCHAR) || '/profile/conversion_profile.json'
              WHEN l_returnflag = 'N' THEN 'user/exp/petastorm/frac_' || CAST(l_discount AS VARCHAR) || '/exec_' || CAST(l_linenumber AS VARCHAR) || '/train_gpu' || CAST(CAST(l_quantity AS INTEGER) % 4 + 1 AS VARCHAR) || '_profile.json'
              ELSE 'user/exp/local/frac_' || CAST(l_discount AS VARCHAR) || '/train_' || CAST(CAST(l_quantity AS INTEGER) % 4 + 1 AS VARCHAR) || 'gpu_profile.json' END AS key
  FROM lineitem
),
parsed AS (
  SELECT *,
         TRY_CAST(substr(list_filter(string_split(key, '/'), lambda p: starts_with(p, 'frac_'))[-1], 6) AS DOUBLE) AS fraction,
         TRY_CAST(substr(list_filter(string_split(key, '/'), lambda p: starts_with(p, 'exec_'))[-1], 6) AS INTEGER) AS executor,
         TRY_CAST(substr(list_filter(string_split(key, '/'), lambda p: starts_with(p, 'frac_'))[1], 6) AS DOUBLE) AS fraction_first
  FROM rp
)"""

SQL["parse_run_path"] = f"WITH {RUN_PATHS} SELECT l_orderkey, l_linenumber, key, fraction, executor, fraction_first FROM parsed"

SQL["parse_gpu_count"] = rf"""
WITH {RUN_PATHS}
SELECT l_orderkey, l_linenumber,
       TRY_CAST(nullif(regexp_extract(key, 'train_gpu(\d+)_profile\.json', 1), '') AS INTEGER) AS gpus,
       TRY_CAST(nullif(regexp_extract(key, 'gpu(\d+)_profile\.json', 1), '') AS INTEGER) AS gpus_loose,
       COALESCE(TRY_CAST(nullif(regexp_extract(key, 'train_gpu(\d+)_profile\.json', 1), '') AS INTEGER),
                TRY_CAST(nullif(regexp_extract(key, 'train_(\d+)gpu', 1), '') AS INTEGER)) AS gpus_any
FROM rp
"""

SQL["fraction_regex"] = f"""
WITH {RUN_PATHS}
SELECT l_orderkey, l_linenumber, TRY_CAST(nullif(regexp_extract(key, 'frac_([0-9.]+)', 1), '') AS DOUBLE) AS fraction FROM rp
"""

SQL["run_record_filter"] = f"""
WITH {RUN_PATHS}
SELECT l_orderkey, l_linenumber, fraction, executor,
       contains(key, '/exec_7/') AS exec_match,
       COALESCE(len(string_split(key, '/')) >= 5 AND starts_with(string_split(key, '/')[4], 'frac_'), false) AS deep
FROM parsed
WHERE ends_with(key, '_profile.json') AND fraction >= 0.001 AND executor IS NOT NULL
"""

# a profile per line: what its key says, the durations of its steps, its summary
RUN_PROFILES = RUN_PATHS.replace("SELECT l_orderkey, l_linenumber,", "SELECT *,", 1) + """,
prof AS (
  SELECT *, CAST(l_extendedprice AS DOUBLE) AS price, CAST(l_quantity AS DOUBLE) AS quantity,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS DOUBLE) * 10 END AS total_time,
         CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_quantity AS DOUBLE) END AS read_metadata,
         CASE WHEN (l_orderkey + 1) % 7 <> 0 THEN CAST(l_quantity AS DOUBLE) * 2 END AS spark_init,
         CASE WHEN (l_orderkey + 2) % 7 <> 0 THEN CAST(l_quantity AS DOUBLE) * 3 END AS write_train,
         CASE WHEN (l_orderkey + 3) % 7 <> 0 THEN CAST(l_quantity AS DOUBLE) * 4 END AS write_validation,
         CASE WHEN (l_orderkey + 4) % 7 <> 0 THEN CAST(l_quantity AS DOUBLE) * 5 END AS write_test,
         CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_extendedprice AS DOUBLE) END AS train_time,
         CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_extendedprice AS DOUBLE) / 4 END AS test_time
  FROM parsed
)"""
CONVERTED = """read_metadata, spark_init, write_train, write_validation, write_test"""
ALL_CONVERTED = """total_time IS NOT NULL AND read_metadata IS NOT NULL AND spark_init IS NOT NULL
  AND write_train IS NOT NULL AND write_validation IS NOT NULL AND write_test IS NOT NULL"""

SQL["conversion_runs"] = f"""
WITH {RUN_PROFILES}
SELECT fraction, executor, total_time, {CONVERTED} FROM prof
WHERE fraction >= 0.001 AND executor IS NOT NULL AND {ALL_CONVERTED}
"""

SQL["conversion_runs_ext"] = f"""
WITH {RUN_PROFILES}
SELECT fraction, total_time, {CONVERTED},
       CAST(l_partkey AS BIGINT) AS train_samples, CAST(l_suppkey AS BIGINT) AS validation_samples,
       CAST(l_linenumber AS BIGINT) AS test_samples,
       CAST(CASE WHEN l_orderkey % 2 <> 0 THEN l_linenumber ELSE l_linenumber + 100 END AS INTEGER) AS train_partitions,
       CAST(l_linenumber + 200 AS INTEGER) AS validation_partitions,
       CAST(l_linenumber + 300 AS INTEGER) AS test_partitions
FROM prof
WHERE starts_with(string_split(key, '/')[4], 'frac_') AND fraction >= 0.001 AND {ALL_CONVERTED}
"""

SQL["training_runs_batch"] = rf"""
WITH {RUN_PROFILES}, g AS (
  SELECT *, COALESCE(TRY_CAST(nullif(regexp_extract(key, 'train_gpu(\d+)_profile\.json', 1), '') AS INTEGER),
                     TRY_CAST(nullif(regexp_extract(key, 'train_(\d+)gpu', 1), '') AS INTEGER)) AS num_gpus
  FROM prof WHERE contains(key, '/exec_7/'))
SELECT fraction, num_gpus, CAST(l_linenumber * 16 AS INTEGER) AS batch_size, total_time, train_time, test_time,
       CAST(l_tax AS DOUBLE) AS test_accuracy
FROM g WHERE fraction >= 0.001 AND num_gpus IS NOT NULL AND train_time IS NOT NULL AND test_time IS NOT NULL
"""

SQL["training_runs_lr"] = rf"""
WITH {RUN_PROFILES}, g AS (
  SELECT *, TRY_CAST(nullif(regexp_extract(key, 'gpu(\d+)_profile\.json', 1), '') AS INTEGER) AS num_gpus,
         TRY_CAST(nullif(regexp_extract(key, 'frac_([0-9.]+)', 1), '') AS DOUBLE) AS any_fraction
  FROM prof)
SELECT any_fraction AS fraction, num_gpus, CAST(l_linenumber * 16 AS INTEGER) AS batch_size,
       CAST(l_discount AS DOUBLE) AS learning_rate, total_time, train_time, test_time, CAST(l_tax AS DOUBLE) AS test_accuracy
FROM g WHERE train_time IS NOT NULL AND test_time IS NOT NULL AND any_fraction IS NOT NULL AND num_gpus IS NOT NULL
"""

SQL["require_steps"] = "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0"

SQL["drop_null_records"] = rf"""
WITH {RUN_PATHS}, r AS (
  SELECT l_orderkey, l_linenumber, executor,
         TRY_CAST(nullif(regexp_extract(key, 'train_gpu(\d+)_profile\.json', 1), '') AS INTEGER) AS gpus
  FROM parsed)
SELECT * FROM r WHERE executor IS NOT NULL OR gpus IS NOT NULL
"""

# --- speedup --------------------------------------------------------------------------------

FLAG_RUNS = """
runs AS (SELECT l_returnflag, l_linenumber, CAST(count(*) AS DOUBLE) AS total_time FROM lineitem GROUP BY ALL),
sp AS (
  SELECT r.l_returnflag, r.l_linenumber, r.total_time,
         CASE WHEN r.total_time <> 0 THEN b.total_time / r.total_time END AS speedup
  FROM runs r LEFT JOIN (SELECT l_returnflag, total_time FROM runs WHERE l_linenumber = 1) b USING (l_returnflag)
)"""

SQL["speedup"] = f"WITH {FLAG_RUNS} SELECT * FROM sp"
SQL["speedup_window"] = f"WITH {FLAG_RUNS} SELECT * FROM sp"
SQL["group_curves"] = f"""
WITH {FLAG_RUNS}
SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linenumber, speedup) AS point,
       l_linenumber, speedup
FROM sp
"""
SQL["ideal_line"] = "SELECT x, x AS y FROM (SELECT unnest(range(1, (SELECT max(l_linenumber) FROM lineitem) + 1)) AS x)"
SQL["sort_runs"] = f"""
WITH {FLAG_RUNS}
SELECT l_returnflag, l_linenumber, total_time, row_number() OVER (ORDER BY l_returnflag, l_linenumber) AS rank FROM runs
"""

# --- sizes from counts -------------------------------------------------------------------------

STATUS_COUNTS = """
sc AS (SELECT o_orderstatus, count(*) AS n, sum(count(*)) OVER () AS total FROM orders GROUP BY o_orderstatus)"""

SQL["fraction_label"] = f"""
WITH {STATUS_COUNTS}
SELECT o_orderstatus, n, n / total AS fraction,
       CAST(CAST(round_even(n / total * 100, 0) AS BIGINT) AS VARCHAR) || '%' AS label
FROM sc
"""

SQL["dataset_bytes"] = f"""
WITH {STATUS_COUNTS}
SELECT o_orderstatus, n, n * 360000 AS bytes, round_even(CAST(n * 360000 AS DOUBLE) / 1073741824.0, 2) AS gib FROM sc
"""

SQL["partition_plan"] = f"""
WITH {STATUS_COUNTS}
SELECT o_orderstatus, least(n, 96) AS partitions, greatest(1, least(n, 96) // 8) AS tasks_per_executor FROM sc
"""

SQL["steps_per_epoch"] = f"""
WITH {STATUS_COUNTS}
SELECT o_orderstatus,
       CAST(CASE WHEN n > 0 THEN ceil(n / 64) ELSE 30 END AS BIGINT) AS steps,
       CAST(CASE WHEN n > 0 THEN ceil(n / 64) ELSE 30 END * 64 AS BIGINT) AS samples_per_epoch
FROM sc
"""

SQL["run_grid"] = """
WITH fr AS (SELECT DISTINCT l_discount AS fraction FROM lineitem)
SELECT 'convert' AS kind, fraction, e.n,
       's3://bucket/user/exp/petastorm/frac_' || CAST(fraction AS VARCHAR) || '/exec_' || CAST(e.n AS VARCHAR) AS output_dir,
       NULL::INTEGER AS global_batch, NULL::DOUBLE AS learning_rate
FROM fr, (VALUES (8), (5), (2), (1)) e(n)
UNION ALL
SELECT 'train', fraction, g.n, NULL, 16 * g.n, 0.001::DOUBLE * g.n
FROM fr, (VALUES (4), (3), (2), (1)) g(n)
"""

# --- feed ----------------------------------------------------------------------------------------

FEED = """
ep AS (SELECT o_orderkey, unnest(range(0, 2)) AS epoch FROM orders),
sh AS (
  SELECT o_orderkey, epoch,
         row_number() OVER (PARTITION BY epoch ORDER BY md5('42:' || CAST(epoch AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS pos,
         count(*) OVER (PARTITION BY epoch) AS n
  FROM ep
)"""

SQL["repeat_epochs"] = f"WITH {FEED} SELECT o_orderkey, epoch FROM ep"
SQL["epoch_shuffle"] = f"WITH {FEED} SELECT o_orderkey, epoch, pos FROM sh"
SQL["assign_batches"] = f"WITH {FEED} SELECT o_orderkey, epoch, pos, pos // 64 AS batch FROM sh WHERE pos // 64 < n // 64"
SQL["assign_shards"] = f"WITH {FEED} SELECT o_orderkey, epoch, pos, pos // 64 AS batch, pos % 4 AS shard FROM sh WHERE pos // 64 < n // 64"

# --- evaluation -------------------------------------------------------------------------------------

PIXELS = """
px AS (
  SELECT vec_id, label,
         unnest(range(0, len(embedding))) AS i,
         unnest(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) AS v
  FROM embeddings
),
pt AS (SELECT *, (label >> (i % 4)) & 1 AS bit FROM px)"""

SQL["pixel_accuracy"] = f"""
WITH {PIXELS}
SELECT round(sum(CASE WHEN (CASE WHEN v > 0 THEN 1 ELSE 0 END) = bit THEN 1 ELSE 0 END) / count(*), 9) AS pixel_accuracy FROM pt
"""

SQL["pixel_log_loss"] = f"""
WITH {PIXELS}
SELECT round(avg(-ln(greatest(CASE WHEN bit = 1 THEN 1.0 / (1.0 + exp(-v)) ELSE 1.0 - 1.0 / (1.0 + exp(-v)) END, 1e-7))), 9) AS pixel_log_loss FROM pt
"""

# --- set operations / previews --------------------------------------------------------------------

SQL["append_records"] = """
SELECT 'customer' AS kind, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer
UNION ALL
SELECT 'supplier', s_name, s_nationkey, s_acctbal, NULL FROM supplier
"""

SQL["head"] = """
SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS idx FROM (SELECT DISTINCT p_brand FROM part) ORDER BY idx LIMIT 5
"""

SQL["curve_points"] = SQL["group_curves"]

_GRADED = """
SELECT d.doc_id, l.quality,
       row_number() OVER (ORDER BY md5('42:' || coalesce(CAST(l.quality AS VARCHAR), '\\N') || ':' || CAST(d.doc_id AS VARCHAR)),
                          l.quality NULLS FIRST, d.doc_id) - 1 AS pos,
       count(*) OVER () AS n
FROM documents d LEFT JOIN labels l USING (doc_id)
"""

SQL["sample_nullable_key"] = f"SELECT doc_id, quality FROM ({_GRADED}) WHERE pos < round_even(n * 0.3::DOUBLE, 0)"

SQL["shuffle_nullable_key"] = f"SELECT doc_id, quality, pos FROM ({_GRADED})"

SQL["dataset_sizes"] = """
SELECT CASE lang WHEN 'en' THEN 'train' WHEN 'fr' THEN 'validation' WHEN 'de' THEN 'validation' WHEN 'es' THEN 'test' END AS split,
       count(*) AS samples
FROM documents GROUP BY 1
"""

SQL["batch_ids"] = """
SELECT c_custkey, pos, pos // 16 AS part
FROM (SELECT c_custkey, row_number() OVER (ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey) - 1 AS pos
      FROM customer)
"""
