"""Column functions on object paths, names and run-folder keys.

All functions are ``Column -> Column`` built from JVM expressions, so they stay
inside whole-stage codegen and null-propagate like the rest of Spark SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasterprep import schemas


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_prefix_pattern(n_fields: int, sep: str = "_") -> str:
    """Regex keeping the first ``n_fields`` ``sep``-separated fields when more follow."""
    if n_fields < 1:
        raise ValueError("n_fields must be >= 1")
    s = re.escape(sep)
    return f"((?:[^{s}]+{s}){{{n_fields - 1}}}[^{s}]+){s}.*"


def field_prefix(c: Column | str, n_fields: int, sep: str = "_") -> Column:
    """First ``n_fields`` fields of a name; unchanged when the pattern does not match.

    A regex replace, not ``substring_index``: the two differ on empty fields
    (``a__b``), and the source semantics are the regex ones.
    """
    return F.regexp_replace(_col(c), field_prefix_pattern(n_fields, sep), "$1")


def s1_prefix(c: Column | str = "s1_name") -> Column:
    """Radar folder prefix, the first 5 ``_`` fields of ``s1_name``."""
    return field_prefix(c, 5, "_")


def s2_prefix(c: Column | str = "patch_id") -> Column:
    """Optical folder prefix, the first 6 ``_`` fields of ``patch_id``."""
    return field_prefix(c, 6, "_")


def join_path(base: str | Column, prefix: Column | str, leaf: Column | str) -> Column:
    """``base + prefix + '/' + leaf``; NULL when any part is NULL (``concat`` semantics)."""
    b = F.lit(base) if isinstance(base, str) else base
    return F.concat(b, _col(prefix), F.lit("/"), _col(leaf))


def strip_scheme(c: Column | str) -> Column:
    """P5: drop ``s3a://`` then ``s3://`` wherever they occur."""
    return F.replace(F.replace(_col(c), F.lit("s3a://"), F.lit("")), F.lit("s3://"), F.lit(""))


def normalize_uri(c: Column | str, cwd: str = "/") -> Column:
    """``s3a://`` -> ``s3://``; a path without scheme becomes ``file://`` + absolute path.

    Any URI that already has a scheme is kept (``s3a`` included, fixing the
    source's misreading of it as a relative path).  ``cwd`` anchors relative
    paths; it is a parameter so results do not depend on the process.
    """
    col = _col(c)
    s3 = F.regexp_replace(col, r"^s3a://", "s3://")
    base = cwd.rstrip("/")
    absolute = F.when(col.startswith("/"), col).otherwise(F.concat(F.lit(base + "/"), col))
    return (F.when(col.isNull(), F.lit(None).cast("string"))
            .when(col.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), s3)
            .otherwise(F.concat(F.lit("file://"), absolute)))


def bucket_of(c: Column | str) -> Column:
    """Bucket part of ``bucket/key`` (text before the first ``/``)."""
    return F.regexp_extract(_col(c), r"^([^/]*)", 1)


def key_of(c: Column | str) -> Column:
    """Key part of ``bucket/key``; NULL when there is no ``/``."""
    col = _col(c)
    return F.when(col.contains("/"), F.regexp_extract(col, r"^[^/]*/(.*)$", 1))


def ensure_trailing_slash(c: Column | str) -> Column:
    """Append ``/`` unless present."""
    col = _col(c)
    return F.when(col.endswith("/"), col).otherwise(F.concat(col, F.lit("/")))


def valid_uri(c: Column | str, schemes: tuple[str, ...] = ("s3",)) -> Column:
    """Non-null, non-empty and starting with one of ``scheme://`` (``s3a://`` fails by default)."""
    col = _col(c)
    cond = F.lit(False)
    for s in schemes:
        cond = cond | col.startswith(f"{s}://")
    return F.coalesce(cond, F.lit(False))


def band_file(folder: Column | str, name: Column | str, band: str,
              suffix: str = schemas.RASTER_SUFFIX) -> Column:
    """Path of one band file: ``{folder}/{name}_{band}{suffix}``."""
    return F.concat(_col(folder), F.lit("/"), _col(name), F.lit(f"_{band}{suffix}"))


# --- run-folder keys (P22-P24, X9) -------------------------------------------------

def path_parts(c: Column | str) -> Column:
    return F.split(_col(c), "/")


def _part_text(c: Column | str, prefix: str, last: bool) -> Column:
    """Text after ``prefix`` in the last (or first) ``/``-separated part that starts with it,
    '' when absent, referencing the input once.

    A single reference keeps the expression small when the optimizer inlines it
    into a pushed-down filter together with the expression that builds the key.
    """
    if last:
        marker = "/" + prefix
        return F.substring_index(F.substring_index(F.concat(F.lit("/"), _col(c)), marker, -1), "/", 1)
    return F.regexp_extract(_col(c), rf"(?:^|/){re.escape(prefix)}([^/]*)", 1)


def _number(text: Column, dtype: str) -> Column:
    # empty text -> NULL before the cast: a failing try_cast takes a slow exception path
    return F.nullif(text, F.lit("")).try_cast(dtype)


def run_fraction(c: Column | str, last: bool = True) -> Column:
    """``frac_<x>`` part as double (conversion runs: last match wins; training: first)."""
    return _number(_part_text(c, "frac_", last), "double")


def run_executors(c: Column | str, last: bool = True) -> Column:
    """``exec_<n>`` part as int."""
    return _number(_part_text(c, "exec_", last), "int")


GPU_FILE_PATTERN = schemas.GPU_FILE_PATTERN
GPU_FILE_PATTERN_LOOSE = schemas.GPU_FILE_PATTERN_LOOSE
GPU_FILE_PATTERN_OLD = schemas.GPU_FILE_PATTERN_OLD


def regex_int(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Integer captured by ``pattern``; NULL when it does not match."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit("")).try_cast("int")


def gpu_count(c: Column | str, pattern: str = GPU_FILE_PATTERN) -> Column:
    """GPU count from a profile file name."""
    return regex_int(c, pattern)


def gpu_count_any(c: Column | str) -> Column:
    """P23 with the older ``train_<n>gpu`` naming accepted as an alternate."""
    return F.coalesce(gpu_count(c, GPU_FILE_PATTERN), gpu_count(c, GPU_FILE_PATTERN_OLD))


def fraction_regex(c: Column | str) -> Column:
    """First ``frac_([0-9.]+)`` anywhere in the key, as double."""
    return F.nullif(F.regexp_extract(_col(c), r"frac_([0-9.]+)", 1), F.lit("")).try_cast("double")


def has_run_depth(c: Column | str, min_parts: int = 7, part_index: int = 6,
                  prefix: str = "frac_") -> Column:
    """At least ``min_parts`` parts and part ``part_index`` (0-based) starts with ``prefix``."""
    parts = path_parts(c)
    return F.coalesce(
        (F.size(parts) >= min_parts) & F.get(parts, part_index).startswith(prefix),
        F.lit(False))


def fraction_label(c: Column | str) -> Column:
    """0.05 -> ``5%`` (half-even rounding of the percentage)."""
    return F.concat(F.bround(_col(c) * 100, 0).cast("long").cast("string"), F.lit("%"))


def output_dir(root: Column | str, experiment: Column | str, fraction: Column | str,
               executors: Column | str, kind: str = "petastorm") -> Column:
    """``{root}/{exp}/{kind}/frac_{f}/exec_{n}``; fraction rendered as text."""
    return F.concat(_col(root), F.lit("/"), _col(experiment), F.lit(f"/{kind}/frac_"),
                    _col(fraction).cast("string"), F.lit("/exec_"),
                    _col(executors).cast("string"))
