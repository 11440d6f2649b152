"""Table schemas, code values and fixed lists.

Schemas are declared, never inferred. Timestamps are TIMESTAMP_NTZ: the
recordings carry wall-clock times without a zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Chunk label (seizure_state): background, seizure, pre-seizure.
STATE_BACKGROUND = 0
STATE_SEIZURE = 1
STATE_PRE_SEIZURE = 2
STATES = (0, 1, 2)

# Channel type (data_type): intracranial EEG, ECG, EKG, surface EEG.
TYPE_IEEG = 0
TYPE_ECG = 1
TYPE_EKG = 2
TYPE_SURFACE = 3
DATA_TYPES = (0, 1, 2, 3)

# Electrode names that count as surface channels in an "inv" dataset.
SURFACE_ELECTRODES = (
    "N", "FP", "AF", "F", "FT", "FC", "A", "T", "C", "TP", "CP", "P", "PO",
    "O", "I", "EMG", "EOG", "PHO",
)

# Source directory suffix -> dataset name.
DATASET_DIR_SUFFIXES = (("inv", "inv"), ("surf30", "surf"))

# Target sampling rate, chunk length and pre-seizure horizon.
TARGET_FREQ = 256
CHUNK_SECONDS = 1
PRE_SEIZURE_SECONDS = 3600

# Header keys: mandatory integers, optional numbers.
HEADER_INT_KEYS = ("num_samples", "sample_freq", "num_channels", "adm_id",
                   "rec_id", "duration_in_sec")
HEADER_OPTIONAL_KEYS = ("conversion_factor", "sample_bytes")
HEADER_TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

# After this many failed recordings of one patient the next one aborts the load.
MAX_BAD_RECORDINGS = 6

# ---------------------------------------------------------------------------
# Table schemas.
# ---------------------------------------------------------------------------

DATASETS = T.StructType([
    T.StructField("dataset_id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), True),
])

PATIENTS = T.StructType([
    T.StructField("patient_id", T.IntegerType(), False),
    T.StructField("dataset_id", T.IntegerType(), False),
])

RECORDINGS = T.StructType([
    T.StructField("recording_id", T.LongType(), False),
    T.StructField("patient_id", T.IntegerType(), True),
    T.StructField("start_ts", T.TimestampNTZType(), True),
    T.StructField("num_samples", T.LongType(), True),
    T.StructField("sample_freq", T.IntegerType(), True),
    T.StructField("conversion_factor", T.DoubleType(), True),
    T.StructField("num_channels", T.IntegerType(), True),
    T.StructField("elec_names", T.StringType(), True),
    T.StructField("electrodes", T.ArrayType(T.StringType()), True),
    T.StructField("adm_id", T.IntegerType(), True),
    T.StructField("rec_id", T.LongType(), True),
    T.StructField("duration_in_sec", T.IntegerType(), True),
    T.StructField("sample_bytes", T.IntegerType(), True),
    T.StructField("data_file", T.StringType(), True),
])

ANNOTATIONS = T.StructType([
    T.StructField("patient_id", T.IntegerType(), True),
    T.StructField("onset", T.TimestampNTZType(), True),
    T.StructField("offset", T.TimestampNTZType(), True),
    T.StructField("onset_sample", T.LongType(), True),
    T.StructField("offset_sample", T.LongType(), True),
])

CHUNKS = T.StructType([
    T.StructField("patient_id", T.IntegerType(), False),
    T.StructField("recording_id", T.LongType(), False),
    T.StructField("chunk_idx", T.IntegerType(), False),
    T.StructField("channel_idx", T.IntegerType(), False),
    T.StructField("electrode", T.StringType(), True),
    T.StructField("chunk_start_ts", T.TimestampNTZType(), True),
    T.StructField("seizure_state", T.IntegerType(), True),
    T.StructField("data_type", T.ShortType(), True),
    T.StructField("data", T.ArrayType(T.FloatType(), False), True),
])

REJECTS = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("path", T.StringType(), True),
    T.StructField("line_no", T.IntegerType(), True),
    T.StructField("raw", T.StringType(), True),
    T.StructField("reasons", T.ArrayType(T.StringType()), True),
])

# Storage layout of the chunk table (directory partitions, outermost first).
CHUNK_PARTITION_COLS = ("patient_id", "seizure_state", "data_type")
CHUNK_SORT_COLS = ("recording_id", "chunk_idx", "channel_idx")
