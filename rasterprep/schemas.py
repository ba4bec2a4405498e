"""Schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source archive's conventions.
# ---------------------------------------------------------------------------

# Land-cover class codes in their fixed order; a code's dense index is its
# position in this list.  Codes below LUT_SIZE that are not listed map to 0.
CLASS_CODES = [
    111, 112, 121, 122, 123, 124, 131, 132, 133, 141, 142,
    211, 212, 213, 221, 222, 223, 231, 241, 242, 243, 244,
    311, 312, 313, 321, 322, 323, 324, 331, 332, 333, 334, 335,
    411, 412, 421, 422, 423, 511, 512, 521, 522, 523, 999,
]
LUT_SIZE = 1000

# Channel order of the image tensor: radar bands, then optical bands.
S1_BANDS = ["VV", "VH"]
S2_BANDS = ["B02", "B03", "B04", "B08"]
# All optical bands of the archive (used by the full-band variant).
S2_BANDS_ALL = ["B01", "B02", "B03", "B04", "B05", "B06",
                "B07", "B08", "B8A", "B09", "B11", "B12"]
REFERENCE_BAND = "reference_map"
IMAGE_BANDS = S1_BANDS + S2_BANDS

# Archive folder names under the storage root.
S1_FOLDER = "BigEarthNet-S1"
S2_FOLDER = "BigEarthNet-S2"
REFERENCE_FOLDER = "Reference_Maps"

# Patch size, file suffix and bytes per output sample (120*120*6*4 + 120*120).
PATCH_HEIGHT = 120
PATCH_WIDTH = 120
RASTER_SUFFIX = ".tif"
BYTES_PER_SAMPLE = PATCH_HEIGHT * PATCH_WIDTH * len(IMAGE_BANDS) * 4 + PATCH_HEIGHT * PATCH_WIDTH

SPLITS = ["train", "validation", "test"]
SAMPLE_SEED = 42

# GPU counts in profile file names: the launcher's form, its loose form, the older form.
GPU_FILE_PATTERN = r"train_gpu(\d+)_profile\.json"
GPU_FILE_PATTERN_LOOSE = r"gpu(\d+)_profile\.json"
GPU_FILE_PATTERN_OLD = r"train_(\d+)gpu"

# ---------------------------------------------------------------------------
# Derived tables (built by rule from the fixed values above).
# ---------------------------------------------------------------------------


def class_lut() -> list[int]:
    """Dense code -> index table of LUT_SIZE entries; unlisted codes map to 0."""
    lut = [0] * LUT_SIZE
    for idx, code in enumerate(CLASS_CODES):
        lut[code] = idx
    return lut


# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------

#: Kinds of numpy items that a class map may hold: whole numbers, signed or not.
CLASS_KINDS = "iu"

REJECTS_SCHEMA = T.StructType([
    T.StructField("sample_id", T.LongType()),
    T.StructField("patch_id", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("detail", T.StringType()),
])

STEP_TYPE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("epochs", T.IntegerType()),
])

PROFILE_SCHEMA = T.StructType([
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("host_info", T.StructType([
        T.StructField("hostname", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("cpu_count", T.IntegerType()),
        T.StructField("ram_gb", T.DoubleType()),
    ])),
    T.StructField("steps", T.ArrayType(STEP_TYPE)),
    T.StructField("summary", T.StructType([
        T.StructField("total_duration", T.DoubleType()),
        T.StructField("train_samples", T.LongType()),
        T.StructField("validation_samples", T.LongType()),
        T.StructField("test_samples", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("dataset_size_gb", T.DoubleType()),
        T.StructField("train_rdd_partitions", T.IntegerType()),
        T.StructField("validation_rdd_partitions", T.IntegerType()),
        T.StructField("test_rdd_partitions", T.IntegerType()),
        T.StructField("train_partitions", T.IntegerType()),
        T.StructField("validation_partitions", T.IntegerType()),
        T.StructField("test_partitions", T.IntegerType()),
        T.StructField("global_batch_size", T.IntegerType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("test_loss", T.DoubleType()),
        T.StructField("test_accuracy", T.DoubleType()),
    ])),
    T.StructField("logs", T.ArrayType(T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("usage", T.StructType([
            T.StructField("cpu_percent", T.DoubleType()),
            T.StructField("ram_percent", T.DoubleType()),
            T.StructField("ram_used_gb", T.DoubleType()),
        ])),
    ]))),
])

SAMPLES_SCHEMA = T.StructType([
    T.StructField("patch_id", T.StringType(), False),
    T.StructField("image", T.ArrayType(T.FloatType(), False), False),
    T.StructField("label", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("height", T.IntegerType(), False),
    T.StructField("width", T.IntegerType(), False),
    T.StructField("channels", T.IntegerType(), False),
    T.StructField("split", T.StringType(), False),
])
