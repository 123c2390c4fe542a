"""Column names, fixed vocabularies and Spark schemas of the telemetry tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: these must stay equal to the reference's behaviour -------------------------
# Raw CSV columns that every input file must carry (any order, extra columns allowed).
REQUIRED_COLUMNS = ["ts", "device", "co", "humidity", "light", "lpg", "motion", "smoke", "temp"]
# Measurement fields in the order the quality flags are emitted.
FLOAT_FIELDS = ["co", "humidity", "lpg", "smoke", "temp"]
BOOL_FIELDS = ["light", "motion"]
# Text (after trim + lower-case) that counts as a missing cell: the loader's own four tokens plus
# the default NA tokens of the CSV reader it used, lower-cased.
MISSING_TOKENS = [
    "", "nan", "none", "null",
    "#n/a", "#n/a n/a", "#na", "-1.#ind", "-1.#qnan", "-nan", "1.#ind", "1.#qnan", "<na>",
    "n/a", "na",
]
TRUE_WORDS_FLOAT = ["true", "yes"]
FALSE_WORDS_FLOAT = ["false", "no"]
TRUE_WORDS_BOOL = ["true", "1", "yes"]
FALSE_WORDS_BOOL = ["false", "0", "no"]
# Issue kinds; a flag is "<issue>_<field>".
ISSUE_MISSING = "missing_measurement"
ISSUE_NUMERIC = "invalid_numeric"
ISSUE_BOOLEAN = "invalid_boolean"
# Rejection reasons, in the order they are tested (first hit wins).
REJECT_MISSING_TS = "missing_ts"
REJECT_INVALID_TS = "invalid_ts"
REJECT_MISSING_DEVICE = "missing_device"
REJECT_EMPTY_DEVICE = "empty_device"
REJECTION_REASONS = [REJECT_MISSING_TS, REJECT_INVALID_TS, REJECT_MISSING_DEVICE, REJECT_EMPTY_DEVICE]
# Epoch values above this are milliseconds, otherwise seconds.
MILLIS_CUTOFF = 1e12
# Fallback alert thresholds when no percentile can be derived.
DEFAULT_THRESHOLDS = {"smoke": 0.05, "co": 0.01, "lpg": 0.01}
# Percentile used for alert thresholds.
ALERT_PERCENTILE = 0.9
# Default rows per load batch.
DEFAULT_BATCH_SIZE = 1000
# Blocker texts of the query-readiness check.
BLOCKER_EMPTY = "collection is empty"
BLOCKER_STRUCTURE = "structural validation failed"
BLOCKER_QUALITY_FIELD = "some documents are missing the quality field"
BLOCKER_NO_DEVICE_READINGS = "no per-device readings available"
# Descriptive metadata attached to every stored reading.
SOURCE_DATASET = "Environmental Sensor Telemetry Data"
SOURCE_PLATFORM = "Kaggle"
# -------------------------------------------------------------------------------------------

# Our own choices (see README "Divergences").
# Strict decimal text, applied to trimmed lower-case text before any cast.
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?$"
INF_PATTERN = r"^[+-]?inf(inity)?$"
NAN_PATTERN = r"^[+-]?nan$"
# Characters removed by trimming (ASCII whitespace).
WHITESPACE = " \t\n\r\x0b\x0c"
# Accepted epoch range after the seconds/milliseconds scaling: 0001-01-01 .. 9999-12-31T23:59:59.
MIN_EPOCH_SECONDS = -62135596800.0
MAX_EPOCH_SECONDS = 253402300799.0
# Version of the identity rule (canonical JSON text of the identifying fields, SHA-256).
READING_ID_VERSION = 1

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in REQUIRED_COLUMNS])

MEASUREMENTS_TYPE = T.StructType([
    T.StructField("co", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("light", T.BooleanType(), True),
    T.StructField("lpg", T.DoubleType(), True),
    T.StructField("motion", T.BooleanType(), True),
    T.StructField("smoke", T.DoubleType(), True),
    T.StructField("temp", T.DoubleType(), True),
])

QUALITY_TYPE = T.StructType([
    T.StructField("is_valid", T.BooleanType(), True),
    T.StructField("flags", T.ArrayType(T.StringType(), True), True),
    T.StructField("invalid_measurement_count", T.IntegerType(), True),
])

SOURCE_TYPE = T.StructType([
    T.StructField("dataset", T.StringType(), True),
    T.StructField("platform", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
])

READINGS_SCHEMA = T.StructType([
    T.StructField("reading_id", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestamp_unix", T.DoubleType(), True),
    T.StructField("device", T.StringType(), True),
    T.StructField("measurements", MEASUREMENTS_TYPE, True),
    T.StructField("quality", QUALITY_TYPE, True),
    T.StructField("source", SOURCE_TYPE, True),
    T.StructField("ingested_at", T.TimestampType(), True),
    T.StructField("event_date", T.DateType(), True),
])

READING_COLUMNS = [f.name for f in READINGS_SCHEMA.fields]

BATCH_STATUS_SCHEMA = T.StructType([
    T.StructField("batch_number", T.LongType(), True),
    T.StructField("rows_read", T.LongType(), True),
    T.StructField("documents_built", T.LongType(), True),
    T.StructField("invalid_rows", T.LongType(), True),
    T.StructField("rows_with_quality_flags", T.LongType(), True),
])
