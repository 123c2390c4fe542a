"""Registered queries: each reads the driver's tables (``events``) and runs one operator end to end.

The raw readings are derived from ``events`` (FIXTURES.md), classified, deduplicated like the
loaded table, and then the operator runs on the result. Each key also has DuckDB SQL in
``ORACLE`` that computes the same thing independently (see ``oracle.py``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envtrack import schema as S
from envtrack.functions.cells import is_missing, parse_bool, parse_float
from envtrack.functions.timecols import micros, utc_ntz
from envtrack.operators import health as H
from envtrack.operators import quality, validate
from envtrack.operators.batches import assign_batches, sequence_group
from envtrack.operators.dedupe import dedupe_readings
from envtrack.operators.transform import accepted_readings, classify_rows, rejected_rows
from envtrack.plans import oracle as O
from envtrack.plans import queries as Q
from envtrack.sources.fixtures import ORDER_COLUMNS, raw_readings
from envtrack.sources.storage import kept

# One literal per run; fixed here so repeated runs of a registered query give identical rows.
REGISTRY_INGESTED_AT = _dt.datetime(2024, 2, 1, tzinfo=_dt.timezone.utc)
SAMPLE_ROWS = 100
WINDOW_START = _dt.date(2024, 1, 8)
WINDOW_END = _dt.date(2024, 1, 15)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared derivations -----------------------------------------------------------------------

def classified(spark: SparkSession, sf_dir: str, with_batches: bool = False) -> DataFrame:
    raw = raw_readings(spark, sf_dir, keep_order=with_batches)
    keep = None
    if with_batches:
        raw = assign_batches(raw, sequence_group("_part", "_seq"), ["_seq"], S.DEFAULT_BATCH_SIZE)
        keep = ["batch_number"]
    return classify_rows(raw, REGISTRY_INGESTED_AT, keep=keep)


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted documents, copies included (what a load builds)."""
    return accepted_readings(classified(spark, sf_dir))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings table a full load leaves behind (one row per id)."""
    return dedupe_readings(loaded(spark, sf_dir))


def computed_once(df: DataFrame, *fields: str) -> DataFrame:
    """Readings with these measurements, written to the shared folder: for queries that find something in
    the readings (a threshold, large groups) before they use it, and would compute them for each job.

    The instants are written as microseconds, which Parquet holds whatever their year."""
    slim = kept(df.select("device", micros(F.col("timestamp")).alias("us"), "timestamp_unix",
                          *[F.col(f"measurements.{f}").alias(f) for f in fields], F.col("quality.is_valid").alias("is_valid")),
                "readings")
    return slim.select("device", F.timestamp_micros("us").alias("timestamp"), "timestamp_unix",
                       *([F.struct(*fields).alias("measurements")] if fields else []), F.struct("is_valid").alias("quality"))


def flat(df: DataFrame) -> DataFrame:
    """Readings without id / ingest time (engine-specific), measurements lifted, flags as text."""
    return df.select(
        utc_ntz(F.col("timestamp")).alias("timestamp"), "timestamp_unix", "device",
        *[F.col(f"measurements.{f}").alias(f) for f in Q.MEASUREMENT_ORDER],
        F.col("quality.is_valid").alias("is_valid"),
        F.array_join(F.col("quality.flags"), ",").alias("flags_text"),
        F.col("quality.invalid_measurement_count").alias("invalid_measurement_count"),
        "event_date",
    )


FLAT_SQL = ("timestamp, timestamp_unix, device, co, humidity, lpg, smoke, temp, light, motion, is_valid, "
            "flags_text, invalid_measurement_count, event_date")
POS_SQL = ("raw_pos AS (SELECT *, row_number() OVER (ORDER BY _part, _seq) AS position FROM raw), "
           "cls_b AS (SELECT c.*, CAST(ceil(p.position / 1000.0) AS BIGINT) AS batch_number "
           "FROM cls c JOIN raw_pos p USING (_part, _seq))")

# --- S: sources ---------------------------------------------------------------------------------

RAW9 = ", ".join(S.REQUIRED_COLUMNS)


@register("scan_raw", O.with_raw(f"SELECT {RAW9} FROM raw"))
def q_scan_raw(spark, sf_dir):
    return raw_readings(spark, sf_dir)


@register("sample_head", O.with_raw(f"SELECT {RAW9} FROM raw ORDER BY _part, _seq LIMIT {SAMPLE_ROWS}"))
def q_sample_head(spark, sf_dir):
    from envtrack.sources.csv import sample_head
    return sample_head(raw_readings(spark, sf_dir, keep_order=True), SAMPLE_ROWS, ["_part", "_seq"])


# --- P: row transformation ----------------------------------------------------------------------

@register("missing_counts_raw", O.with_raw("SELECT " + ", ".join(
    f"count_if({O.missing(c)}) AS {c}_missing" for c in S.REQUIRED_COLUMNS) + " FROM raw"))
def q_missing_counts_raw(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    return raw.agg(*[F.count_if(is_missing(F.col(c))).alias(f"{c}_missing") for c in S.REQUIRED_COLUMNS])


@register("parse_float", O.with_raw("SELECT " + ", ".join(
    f"{O.float_value(f)} AS {f}, {O.issue(f, "invalid_numeric", O.float_value(f))} AS {f}_issue"
    for f in O.FLOATS) + " FROM raw"))
def q_parse_float(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    cols = []
    for f in S.FLOAT_FIELDS:
        v, i = parse_float(F.col(f))
        cols += [v.alias(f), i.alias(f"{f}_issue")]
    return raw.select(*cols)


@register("parse_bool", O.with_raw("SELECT " + ", ".join(
    f"{O.bool_value(f)} AS {f}, {O.issue(f, "invalid_boolean", O.bool_value(f))} AS {f}_issue"
    for f in O.BOOLS) + " FROM raw"))
def q_parse_bool(spark, sf_dir):
    raw = raw_readings(spark, sf_dir)
    cols = []
    for f in S.BOOL_FIELDS:
        v, i = parse_bool(F.col(f))
        cols += [v.alias(f), i.alias(f"{f}_issue")]
    return raw.select(*cols)


@register("epoch_parse", O.with_readings(
    "SELECT ts, timestamp_unix, timestamp, timestamp_unix > 1e12 AS is_millis "
    "FROM acc JOIN raw USING (_part, _seq)"))
def q_epoch_parse(spark, sf_dir):
    raw = raw_readings(spark, sf_dir).withColumn("cell", F.col("ts"))
    ok = classify_rows(raw, REGISTRY_INGESTED_AT, keep=["cell"]).where(F.col("rejection_reason").isNull())
    return ok.select(F.col("cell").alias("ts"), "timestamp_unix", utc_ntz(F.col("timestamp")).alias("timestamp"),
                     (F.col("timestamp_unix") > S.MILLIS_CUTOFF).alias("is_millis"))


@register("measurements", O.with_readings(
    "SELECT device, timestamp_unix, co, humidity, lpg, smoke, temp, light, motion FROM acc"))
def q_measurements(spark, sf_dir):
    r = loaded(spark, sf_dir)
    return r.select("device", "timestamp_unix", *[F.col(f"measurements.{f}").alias(f) for f in Q.MEASUREMENT_ORDER])


@register("quality_flags", O.with_readings(
    "SELECT device, timestamp_unix, flags_text, invalid_measurement_count, is_valid FROM acc"))
def q_quality_flags(spark, sf_dir):
    r = loaded(spark, sf_dir)
    return r.select("device", "timestamp_unix", F.array_join("quality.flags", ",").alias("flags_text"),
                    F.col("quality.invalid_measurement_count").alias("invalid_measurement_count"),
                    F.col("quality.is_valid").alias("is_valid"))


@register("reading_id", O.with_readings(
    "SELECT device, count(*) AS distinct_readings FROM (SELECT DISTINCT device, timestamp_unix, co, humidity, "
    "light, lpg, motion, smoke, temp FROM acc) GROUP BY device"))
def q_reading_id(spark, sf_dir):
    r = loaded(spark, sf_dir)
    return r.groupBy("device").agg(F.countDistinct("reading_id").alias("distinct_readings"))


@register("classify_rows", O.with_readings(
    "SELECT c.rejection_reason, CASE WHEN c.rejection_reason IS NULL THEN c.device_t END AS device, "
    "CASE WHEN c.rejection_reason IS NULL THEN c.ts_num END AS timestamp_unix FROM cls c"))
def q_classify_rows(spark, sf_dir):
    return classified(spark, sf_dir).select("rejection_reason", "device", "timestamp_unix")


@register("rejected_rows", O.with_parsed(
    f"SELECT rejection_reason, {RAW9} FROM cls WHERE rejection_reason IS NOT NULL"))
def q_rejected_rows(spark, sf_dir):
    return rejected_rows(classified(spark, sf_dir)).select("rejection_reason", "row.*")


@register("transform_readings", O.with_readings(f"SELECT {FLAT_SQL} FROM acc2"))
def q_transform_readings(spark, sf_dir):
    return flat(loaded(spark, sf_dir))


@register("dedupe_readings", O.with_readings(f"SELECT {FLAT_SQL} FROM rd"))
def q_dedupe_readings(spark, sf_dir):
    return flat(readings(spark, sf_dir))


@register("readings_in_window", O.with_readings(
    "SELECT device, timestamp, timestamp_unix, co, humidity, lpg, smoke, temp, light, motion, is_valid FROM rd "
    f"WHERE timestamp >= TIMESTAMP '{WINDOW_START} 00:00:00' AND timestamp < TIMESTAMP '{WINDOW_END} 00:00:00'"))
def q_readings_in_window(spark, sf_dir):
    return Q.readings_in_window(readings(spark, sf_dir), None, WINDOW_START, WINDOW_END)


WINDOW_DEVICES = [f"dev-{i:04d}" for i in range(0, 100, 3)]


@register("readings_of_devices", O.with_readings(
    "SELECT device, timestamp, timestamp_unix, co, humidity, lpg, smoke, temp, light, motion, is_valid FROM rd "
    f"WHERE timestamp >= TIMESTAMP '{WINDOW_START} 00:00:00' AND timestamp < TIMESTAMP '{WINDOW_END} 00:00:00' "
    "AND length(device) = 8 AND TRY_CAST(substr(device, 5) AS INTEGER) < 100 "
    "AND TRY_CAST(substr(device, 5) AS INTEGER) % 3 = 0"))
def q_readings_of_devices(spark, sf_dir):
    """P25 with its device filter."""
    return Q.readings_in_window(readings(spark, sf_dir), WINDOW_DEVICES, WINDOW_START, WINDOW_END)


PAGE_AFTER = _dt.datetime(2024, 1, 15, tzinfo=_dt.timezone.utc)


@register("page_readings", O.with_readings(
    "SELECT device, timestamp, timestamp_unix, co, humidity, lpg, smoke, temp, light, motion, is_valid FROM rd "
    f"WHERE timestamp > TIMESTAMP '{PAGE_AFTER:%Y-%m-%d %H:%M:%S}' ORDER BY timestamp, device, timestamp_unix LIMIT 100"))
def q_page_readings(spark, sf_dir):
    """One 100-row page of readings after a cursor instant (keyset pagination)."""
    return Q.page_readings(readings(spark, sf_dir), 100, (PAGE_AFTER,)).drop("cursor_us", "reading_id")


# --- A: load-quality counters -------------------------------------------------------------------

@register("assign_batches", O.with_parsed(
    ", " + POS_SQL + " SELECT batch_number, count(*) AS rows_read FROM cls_b GROUP BY batch_number"))
def q_assign_batches(spark, sf_dir):
    c = classified(spark, sf_dir, with_batches=True)
    return c.groupBy("batch_number").agg(F.count("*").alias("rows_read"))


BATCH_STATUS_SQL = (
    "SELECT batch_number, count(*) AS rows_read, count_if(rejection_reason IS NULL) AS documents_built, "
    "count_if(rejection_reason IS NOT NULL) AS invalid_rows, "
    "count_if(rejection_reason IS NULL AND len(flags) > 0) AS rows_with_quality_flags FROM cls_b GROUP BY batch_number")


@register("batch_quality_status", O.with_parsed(", " + POS_SQL + " " + BATCH_STATUS_SQL))
def q_batch_quality_status(spark, sf_dir):
    return quality.batch_quality_status(classified(spark, sf_dir, with_batches=True))


@register("rejected_reasons", O.with_parsed(
    "SELECT rejection_reason, count(*) AS rows FROM cls WHERE rejection_reason IS NOT NULL GROUP BY 1"))
def q_rejected_reasons(spark, sf_dir):
    return quality.rejected_reasons(classified(spark, sf_dir))


@register("flag_counts", O.with_readings(
    "SELECT flag, count(*) AS occurrences FROM (SELECT unnest(flags) AS flag FROM acc) GROUP BY flag"))
def q_flag_counts(spark, sf_dir):
    return quality.flag_counts(loaded(spark, sf_dir))


@register("device_counts_loaded", O.with_readings("SELECT device, count(*) AS documents FROM acc GROUP BY device"))
def q_device_counts_loaded(spark, sf_dir):
    return quality.device_counts_loaded(loaded(spark, sf_dir))


@register("quality_report", O.with_parsed(
    ", " + POS_SQL + ", bs AS (" + BATCH_STATUS_SQL + ") SELECT CAST(sum(rows_read) AS BIGINT) AS total_rows_seen, "
    "CAST(sum(documents_built) AS BIGINT) AS rows_loaded, CAST(sum(invalid_rows) AS BIGINT) AS rows_rejected, "
    "CAST(sum(rows_with_quality_flags) AS BIGINT) AS rows_with_quality_flags, count(*) AS batches FROM bs"))
def q_quality_report(spark, sf_dir):
    return quality.quality_report(quality.batch_quality_status(classified(spark, sf_dir, with_batches=True)))


def _full_report(spark, sf_dir) -> dict[str, DataFrame]:
    c = classified(spark, sf_dir, with_batches=True)
    return quality.quality_report_full(quality.quality_counts(c), quality.batch_quality_status(c))


@register("quality_report_flags", O.with_readings(
    "SELECT flag, count(*) AS occurrences FROM (SELECT unnest(flags) AS flag FROM acc) GROUP BY flag"))
def q_quality_report_flags(spark, sf_dir):
    return _full_report(spark, sf_dir)["invalid_measurement_values"]


@register("quality_report_reasons", O.with_parsed(
    "SELECT rejection_reason, count(*) AS rows FROM cls WHERE rejection_reason IS NOT NULL GROUP BY 1"))
def q_quality_report_reasons(spark, sf_dir):
    return _full_report(spark, sf_dir)["rejected_reasons"]


@register("quality_report_devices", O.with_readings("SELECT device, count(*) AS documents FROM acc GROUP BY device"))
def q_quality_report_devices(spark, sf_dir):
    return _full_report(spark, sf_dir)["device_counts"]


@register("quality_report_batches", O.with_parsed(", " + POS_SQL + " " + BATCH_STATUS_SQL))
def q_quality_report_batches(spark, sf_dir):
    return _full_report(spark, sf_dir)["batch_quality_status"]


_KEYS = "device, timestamp_unix, co, humidity, light, lpg, motion, smoke, temp"


@register("upsert_counts", O.with_readings(
    f", old AS (SELECT DISTINCT {_KEYS} FROM acc WHERE _seq % 3 <> 0), "
    f"new AS (SELECT DISTINCT {_KEYS} FROM acc WHERE _seq % 2 = 0), "
    f"both_ AS (SELECT {_KEYS} FROM old INTERSECT SELECT {_KEYS} FROM new) "
    "SELECT (SELECT count(*) FROM new) - (SELECT count(*) FROM both_) AS inserted, "
    "(SELECT count(*) FROM both_) AS updated, (SELECT count(*) FROM new) AS inserted_or_updated"))
def q_upsert_counts(spark, sf_dir):
    """K2: every second row, taken in a day later, against a table of two thirds of the rows."""
    from envtrack.operators.dedupe import upsert_counts

    raw = raw_readings(spark, sf_dir, keep_order=True)
    old = accepted_readings(classify_rows(raw.where(F.col("_seq") % 3 != 0), REGISTRY_INGESTED_AT))
    new = classify_rows(raw.where(F.col("_seq") % 2 == 0), REGISTRY_INGESTED_AT + _dt.timedelta(days=1))
    return upsert_counts(accepted_readings(new), dedupe_readings(old))


# --- A: validation ------------------------------------------------------------------------------

@register("time_bounds", O.with_readings(
    "SELECT min(timestamp) AS first_timestamp, max(timestamp) AS latest_timestamp FROM rd"))
def q_time_bounds(spark, sf_dir):
    return validate.time_bounds(readings(spark, sf_dir))


@register("basic_statistics", O.with_readings(" UNION ALL ".join(
    f"SELECT '{f}' AS field, min({f}) AS min, max({f}) AS max, {O.round_even(f'avg({f})', 4)} AS avg, "
    f"count({f}) AS non_null_count FROM rd" for f in validate.STAT_FIELDS)))
def q_basic_statistics(spark, sf_dir):
    return validate.basic_statistics(readings(spark, sf_dir))


@register("null_counts", O.with_readings(" UNION ALL ".join(
    f"SELECT '{f}' AS field, count_if({f} IS NULL) AS null_count FROM rd" for f in validate.NULL_FIELDS)))
def q_null_counts(spark, sf_dir):
    return validate.null_counts(readings(spark, sf_dir))


@register("quality_metrics", O.with_readings(
    "SELECT count(*) AS documents_with_quality_field, CAST(0 AS BIGINT) AS documents_missing_quality_field, "
    "count_if(NOT is_valid) AS documents_with_quality_is_valid_false, "
    "count_if(len(flags) > 0) AS documents_with_quality_flags, count(*) > 0 AS quality_field_present FROM rd"))
def q_quality_metrics(spark, sf_dir):
    return validate.quality_metrics(readings(spark, sf_dir))


@register("unique_devices", O.with_readings("SELECT count(DISTINCT device) AS unique_devices FROM rd"))
def q_unique_devices(spark, sf_dir):
    return validate.unique_devices(readings(spark, sf_dir))


DENSITY_SQL = ("dens AS (SELECT device, count(*) AS readings FROM rd WHERE device IS NOT NULL AND device <> '' "
               "GROUP BY device)")


@register("device_density", O.with_readings(
    ", " + DENSITY_SQL + " SELECT CAST(coalesce(min(readings), 0) AS BIGINT) AS min_readings_per_device, "
    "CAST(coalesce(max(readings), 0) AS BIGINT) AS max_readings_per_device, "
    f"coalesce({O.round_even('avg(readings)', 2)}, 0.0) AS avg_readings_per_device, "
    "count(*) AS devices_with_readings FROM dens"))
def q_device_density(spark, sf_dir):
    return validate.device_density(readings(spark, sf_dir))


@register("validation_report", O.with_readings(
    ", " + DENSITY_SQL + ", t AS (SELECT count(*) AS n, count(DISTINCT device) AS u, min(timestamp) AS f, "
    "max(timestamp) AS l, count_if(NOT is_valid) AS inv, count_if(len(flags) > 0) AS fl FROM rd), "
    "d AS (SELECT coalesce(min(readings), 0) AS mn, coalesce(max(readings), 0) AS mx, "
    f"coalesce({O.round_even('avg(readings)', 2)}, 0.0) AS av FROM dens), "
    "v AS (SELECT *, (n > 0 AND u > 0 AND f IS NOT NULL AND l IS NOT NULL AND f <= l) AS ok FROM t, d) "
    "SELECT n AS total_documents, u AS unique_devices, f AS first_timestamp, l AS latest_timestamp, "
    "(f IS NOT NULL AND l IS NOT NULL AND f <= l) AS timestamp_range_valid, "
    "'co,humidity,light,lpg,motion,smoke,temp' AS measurement_fields, CAST(0 AS BIGINT) AS documents_missing_quality_field, "
    "inv AS documents_with_quality_is_valid_false, fl AS documents_with_quality_flags, "
    "CAST(mn AS BIGINT) AS min_readings_per_device, CAST(mx AS BIGINT) AS max_readings_per_device, "
    "av AS avg_readings_per_device, n > 0 AS data_present, ok AS data_valid, "
    "(n > 0 AND ok AND mn >= 1) AS ready_for_queries, "
    "array_to_string(list_filter([CASE WHEN n = 0 THEN 'collection is empty' END, "
    "CASE WHEN NOT ok THEN 'structural validation failed' END, "
    "CASE WHEN mn < 1 THEN 'no per-device readings available' END], lambda x: x IS NOT NULL), '; ') AS readiness_blockers "
    "FROM v"))
def q_validation_report(spark, sf_dir):
    return validate.validation_report(readings(spark, sf_dir))


# --- Q: the published queries -------------------------------------------------------------------

FALLBACK = {"smoke": 0.05, "co": 0.01, "lpg": 0.01}


def _thr_sql(field: str, valid_only: bool = False) -> str:
    where = f"WHERE {field} IS NOT NULL" + (" AND is_valid" if valid_only else "")
    return (f"(SELECT coalesce({O.round_even(f'quantile_disc({field}, 0.9)', 6)}, {FALLBACK[field]}) "
            f"FROM rd {where})")


@register("alert_thresholds", O.with_readings(
    "SELECT " + ", ".join(f"{_thr_sql(f)} AS {f}" for f in Q.THRESHOLD_FIELDS)))
def q_alert_thresholds(spark, sf_dir):
    return Q.alert_thresholds(computed_once(readings(spark, sf_dir), *Q.THRESHOLD_FIELDS))


LIFT_SQL = "co, humidity, lpg, smoke, temp, light, motion"


@register("latest_readings", O.with_readings(
    f"SELECT device, timestamp, {LIFT_SQL} FROM rd ORDER BY timestamp DESC, device, timestamp_unix, "
    "co ASC NULLS FIRST, humidity ASC NULLS FIRST, lpg ASC NULLS FIRST, smoke ASC NULLS FIRST, "
    "temp ASC NULLS FIRST, light ASC NULLS FIRST, motion ASC NULLS FIRST LIMIT 5"))
def q_latest_readings(spark, sf_dir):
    return Q.latest_readings(readings(spark, sf_dir))


@register("readings_per_device", O.with_readings(
    "SELECT device, count(*) AS reading_count FROM rd GROUP BY device ORDER BY reading_count DESC, device"))
def q_readings_per_device(spark, sf_dir):
    return Q.readings_per_device(readings(spark, sf_dir))


def _avg_sql(field: str, name: str) -> str:
    return O.with_readings(
        f"SELECT device, {O.round_even(f'avg({field})', 2)} AS {name}, count(*) AS readings FROM rd "
        f"WHERE {field} IS NOT NULL GROUP BY device ORDER BY avg({field}) DESC, device")


@register("avg_temperature_by_device", _avg_sql("temp", "avg_temp"))
def q_avg_temperature_by_device(spark, sf_dir):
    return Q.avg_temperature_by_device(readings(spark, sf_dir))


@register("avg_humidity_by_device", _avg_sql("humidity", "avg_humidity"))
def q_avg_humidity_by_device(spark, sf_dir):
    return Q.avg_humidity_by_device(readings(spark, sf_dir))


def _high_sql(field: str, valid_only: bool = False) -> str:
    extra = " AND is_valid" if valid_only else ""
    return O.with_readings(
        f"SELECT device, timestamp, {field} AS value FROM rd WHERE {field} >= {_thr_sql(field, valid_only)}{extra} "
        f"ORDER BY {field} DESC, timestamp DESC, device, timestamp_unix LIMIT 20")


@register("high_smoke_readings", _high_sql("smoke"))
def q_high_smoke(spark, sf_dir):
    return Q.high_smoke_readings(computed_once(readings(spark, sf_dir), "smoke"))


@register("high_co_readings", _high_sql("co"))
def q_high_co(spark, sf_dir):
    return Q.high_co_readings(computed_once(readings(spark, sf_dir), "co"))


@register("high_lpg_readings", _high_sql("lpg"))
def q_high_lpg(spark, sf_dir):
    return Q.high_lpg_readings(computed_once(readings(spark, sf_dir), "lpg"))


@register("high_smoke_valid_only", _high_sql("smoke", valid_only=True))
def q_high_smoke_valid_only(spark, sf_dir):
    return Q.high_smoke_readings(computed_once(readings(spark, sf_dir), "smoke"), valid_only=True)


@register("readings_by_day", O.with_readings(
    "SELECT CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS day, count(*) AS reading_count FROM rd "
    "GROUP BY 1 ORDER BY 1"))
def q_readings_by_day(spark, sf_dir):
    return Q.readings_by_day(readings(spark, sf_dir))


def _top_sql(field: str, n: int) -> str:
    return O.with_readings(
        f"SELECT device, timestamp, {field} FROM rd WHERE {field} IS NOT NULL "
        f"ORDER BY {field} DESC, timestamp DESC, device, timestamp_unix LIMIT {n}")


@register("highest_temperatures", _top_sql("temp", 10))
def q_highest_temperatures(spark, sf_dir):
    return Q.highest_temperatures(readings(spark, sf_dir))


@register("highest_smoke", _top_sql("smoke", 10))
def q_highest_smoke(spark, sf_dir):
    return Q.highest_smoke(readings(spark, sf_dir))


@register("upsert_merge", O.with_readings(f"SELECT {FLAT_SQL} FROM rd"))
def q_upsert_merge(spark, sf_dir):
    """K1: a table of two thirds of the rows, then an overlapping half and the rest merged into it with
    replace semantics; the result is the table a single full load leaves behind."""
    from envtrack.operators.dedupe import merge_frames

    docs = accepted_readings(classify_rows(raw_readings(spark, sf_dir, keep_order=True), REGISTRY_INGESTED_AT,
                                           keep=["_seq"]), keep=["_seq"])
    first = dedupe_readings(docs.where(F.col("_seq") % 3 != 0).drop("_seq"))
    rest = docs.where((F.col("_seq") % 3 == 0) | (F.col("_seq") % 2 == 0)).drop("_seq")
    return flat(merge_frames(first, rest))


# --- T: the resumable load, end to end ------------------------------------------------------

def _fresh_folder(spark: SparkSession, name: str) -> str:
    import uuid

    from envtrack.session import state_path

    return state_path(spark, "registry", f"{name}-{uuid.uuid4().hex}")


@register("resumable_load", O.with_readings(f"SELECT {FLAT_SQL} FROM rd"))
def q_resumable_load(spark, sf_dir):
    """Raw rows -> CSV files -> streaming load of several files a batch (T1) -> the table it leaves
    behind. Same rows as ``dedupe_readings``.

    Side effect: writes the input files, the table and the load state to a new folder under the
    session's shared state folder (``spark.checkpoint.dir``).
    """
    from envtrack.sources.table import read_readings
    from envtrack.streaming.load import load_readings

    root = _fresh_folder(spark, "resumable_load")
    raw = raw_readings(spark, sf_dir, keep_order=True).repartitionByRange(4, "_part", "_seq")
    raw.select(*S.REQUIRED_COLUMNS).write.option("header", True).option("escape", '"').csv(f"{root}/input")
    load_readings(spark, f"{root}/input", f"{root}/readings", f"{root}/state", files_per_batch=2,
                  delay_seconds=0, ingested_at=REGISTRY_INGESTED_AT)
    return flat(read_readings(spark, f"{root}/readings"))


@register("batch_log", O.with_parsed(
    ", n AS (SELECT _part, _seq, CAST(ceil(row_number() OVER (PARTITION BY _part ORDER BY _seq) / 1000.0) AS BIGINT) "
    "AS batch_number FROM raw) SELECT 'part-' || _part AS source_file, batch_number, count(*) AS rows_read, "
    "count_if(rejection_reason IS NULL) AS documents_built, count_if(rejection_reason IS NOT NULL) AS invalid_rows, "
    "count_if(rejection_reason IS NULL AND len(flags) > 0) AS rows_with_quality_flags "
    "FROM cls JOIN n USING (_part, _seq) GROUP BY ALL"))
def q_batch_log(spark, sf_dir):
    """T1 by rows: the counters of every 1,000-row batch of two inputs, all in one aggregate."""
    from envtrack.streaming.load import counters_by_batch, numbered_batches

    raw = raw_readings(spark, sf_dir, keep_order=True).withColumn("source_file", F.concat(F.lit("part-"), "_part"))
    slim = classify_rows(raw, REGISTRY_INGESTED_AT, keep=["source_file", *ORDER_COLUMNS]).select(
        "source_file", *ORDER_COLUMNS, "rejection_reason", F.struct(F.col("quality.is_valid").alias("is_valid")).alias("quality"))
    return counters_by_batch(numbered_batches(slim, sequence_group("_part", "_seq"), ["_seq"], S.DEFAULT_BATCH_SIZE, "source_file"))


@register("csv_round_trip", O.with_raw(
    "SELECT ts, 'a \"' || device || '\", b' AS device, " + ", ".join(f for f in O.FLOATS + O.BOOLS) + " FROM raw"))
def q_csv_round_trip(spark, sf_dir):
    """Rows written as CSV with quotes and commas in a cell, and read back by the loader's reader."""
    from envtrack.sources.csv import csv_options, text_schema

    path = _fresh_folder(spark, "csv_round_trip")
    raw = raw_readings(spark, sf_dir).withColumn("device", F.concat(F.lit('a "'), "device", F.lit('", b')))
    raw.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    back = spark.read.options(**csv_options()).schema(text_schema(S.REQUIRED_COLUMNS)).csv(path)
    return back.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in S.REQUIRED_COLUMNS])


# --- health: time buckets, baselines, sequences ---------------------------------------------

def _bucket_sql(seconds: int, col: str = "timestamp") -> str:
    w = seconds * 1_000_000
    return f"make_timestamp(CAST(floor(epoch_us({col}) / {w}) AS BIGINT) * {w})"


@register("hourly_by_device", O.with_readings(
    f"SELECT device, {_bucket_sql(3600)} AS bucket, count(*) AS readings, {O.round_even('avg(temp)', 4)} AS avg_temp, "
    f"min(temp) AS min_temp, max(temp) AS max_temp, {O.round_even('avg(humidity)', 4)} AS avg_humidity, "
    "max(smoke) AS max_smoke, max(co) AS max_co, max(lpg) AS max_lpg FROM rd GROUP BY ALL"))
def q_hourly_by_device(spark, sf_dir):
    return H.hourly_by_device(readings(spark, sf_dir))


@register("flags_per_device", O.with_readings(
    "SELECT device, flag, count(*) AS occurrences FROM (SELECT device, unnest(flags) AS flag FROM rd) GROUP BY ALL"))
def q_flags_per_device(spark, sf_dir):
    return H.flags_per_device(readings(spark, sf_dir))


@register("device_baselines", O.with_readings(
    "SELECT device, count(*) AS readings, " + ", ".join(
        f"quantile_disc({f}, 0.5) AS {f}_p50, quantile_disc({f}, 0.9) AS {f}_p90" for f in Q.THRESHOLD_FIELDS)
    + " FROM rd GROUP BY device"))
def q_device_baselines(spark, sf_dir):
    return H.device_baselines(computed_once(readings(spark, sf_dir), *Q.THRESHOLD_FIELDS))


@register("spread_by_device", O.with_readings(" UNION ALL ".join(
    f"SELECT device, '{f}' AS field, min({f}) AS min, max({f}) AS max, max({f}) - min({f}) AS range, "
    f"{O.round_even(f'stddev_samp({f})', 6)} AS stddev FROM rd GROUP BY device" for f in H.SPREAD_FIELDS)))
def q_spread_by_device(spark, sf_dir):
    return H.spread_by_device(readings(spark, sf_dir))


_LATEST_ORDER = ("timestamp DESC, timestamp_unix DESC, " + ", ".join(
    f"{f} DESC NULLS LAST" for f in Q.MEASUREMENT_ORDER))


@register("downsample", O.with_readings(
    f"SELECT device, bucket, timestamp, {LIFT_SQL}, readings FROM (SELECT *, "
    "count(*) OVER (PARTITION BY device, bucket) AS readings, "
    f"row_number() OVER (PARTITION BY device, bucket ORDER BY {_LATEST_ORDER}) AS rn "
    f"FROM (SELECT *, {_bucket_sql(6 * 3600)} AS bucket FROM rd)) WHERE rn = 1"))
def q_downsample(spark, sf_dir):
    return H.downsample(readings(spark, sf_dir))


@register("latest_per_device", O.with_readings(
    f"SELECT device, timestamp, timestamp_unix, {LIFT_SQL} FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY device ORDER BY {_LATEST_ORDER}) AS rn FROM rd) WHERE rn = 1"))
def q_latest_per_device(spark, sf_dir):
    return H.latest_per_device(readings(spark, sf_dir))


GAPS_SQL = ("g AS (SELECT device, timestamp, lag(timestamp) OVER w AS prev_ts, "
            "(epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 1e6 AS gap_seconds FROM rd "
            "WINDOW w AS (PARTITION BY device ORDER BY timestamp, timestamp_unix))")


@register("reading_gaps", O.with_readings(
    ", " + GAPS_SQL + " SELECT device, prev_ts AS gap_start, timestamp AS gap_end, gap_seconds FROM g "
    "WHERE gap_seconds > 3600.0"))
def q_reading_gaps(spark, sf_dir):
    return H.reading_gaps(readings(spark, sf_dir))


@register("silent_devices", O.with_readings(
    ", " + GAPS_SQL + ", per AS (SELECT device, max(timestamp) AS last, quantile_disc(gap_seconds, 0.5) AS med "
    "FROM g GROUP BY device), bounds AS (SELECT max(timestamp) AS a FROM rd) "
    "SELECT device, last AS last_timestamp, med AS median_interval_seconds, "
    "(epoch_us(a) - epoch_us(last)) / 1e6 AS silence_seconds, "
    "coalesce((epoch_us(a) - epoch_us(last)) / 1e6 > 3.0 * med, FALSE) AS is_silent FROM per, bounds"))
def q_silent_devices(spark, sf_dir):
    return H.silent_devices(computed_once(readings(spark, sf_dir)))


@register("sparse_devices", O.with_readings(
    ", per AS (SELECT device, count(*) AS readings FROM rd GROUP BY device), m AS (SELECT avg(readings) AS mean FROM per) "
    f"SELECT device, readings, {O.round_even('mean', 2)} AS mean_readings, "
    f"{O.round_even('readings / mean', 4)} AS ratio_to_mean, readings < 0.5 * mean AS is_sparse FROM per, m"))
def q_sparse_devices(spark, sf_dir):
    return H.sparse_devices(readings(spark, sf_dir))


BURST_SECONDS, BURST_READINGS = 6 * 3600, 2


@register("dense_bursts", O.with_readings(
    f"SELECT device, {_bucket_sql(BURST_SECONDS)} AS window_start, count(*) AS readings FROM rd GROUP BY ALL "
    f"HAVING count(*) >= {BURST_READINGS}"))
def q_dense_bursts(spark, sf_dir):
    return H.dense_bursts(readings(spark, sf_dir), BURST_SECONDS, BURST_READINGS)


@register("rolling_bursts", O.with_readings(
    ", w AS (SELECT device, timestamp AS window_end, count(*) OVER (PARTITION BY device ORDER BY epoch_us(timestamp) "
    f"RANGE BETWEEN {BURST_SECONDS * 1_000_000} PRECEDING AND CURRENT ROW) AS readings FROM rd) "
    f"SELECT * FROM w WHERE readings >= {BURST_READINGS}"))
def q_rolling_bursts(spark, sf_dir):
    return H.rolling_bursts(readings(spark, sf_dir), BURST_SECONDS, BURST_READINGS)


_BURST_DENSITY_SQL = ("SELECT device, max(n) AS max_readings_per_window, count(*) AS windows_with_readings FROM "
                      f"(SELECT device, {_bucket_sql(60)} AS w, count(*) AS n FROM %s GROUP BY ALL) GROUP BY device")


@register("device_burst_density", O.with_readings(_BURST_DENSITY_SQL % "rd"))
def q_device_burst_density(spark, sf_dir):
    return H.device_burst_density(readings(spark, sf_dir))


# --- P26: the same operators over valid readings only ---------------------------------------------

VALID_SQL = "valid AS (SELECT * FROM rd WHERE is_valid)"


@register("device_burst_density_valid_only", O.with_readings(", " + VALID_SQL + " " + _BURST_DENSITY_SQL % "valid"))
def q_device_burst_density_valid(spark, sf_dir):
    return H.device_burst_density(readings(spark, sf_dir), valid_only=True)


@register("sparse_devices_valid_only", O.with_readings(
    ", " + VALID_SQL + ", per AS (SELECT device, count(*) AS readings FROM valid GROUP BY device), "
    "m AS (SELECT avg(readings) AS mean FROM per) "
    f"SELECT device, readings, {O.round_even('mean', 2)} AS mean_readings, "
    f"{O.round_even('readings / mean', 4)} AS ratio_to_mean, readings < 0.5 * mean AS is_sparse FROM per, m"))
def q_sparse_devices_valid(spark, sf_dir):
    return H.sparse_devices(readings(spark, sf_dir), valid_only=True)


@register("reading_gaps_valid_only", O.with_readings(
    ", " + VALID_SQL + ", " + GAPS_SQL.replace("FROM rd", "FROM valid")
    + " SELECT device, prev_ts AS gap_start, timestamp AS gap_end, gap_seconds FROM g WHERE gap_seconds > 3600.0"))
def q_reading_gaps_valid(spark, sf_dir):
    return H.reading_gaps(readings(spark, sf_dir), valid_only=True)


# --- numbers outside the usual range ----------------------------------------------------------------

def extreme_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose smoke and temperature hold huge and infinite values."""
    raw, n = raw_readings(spark, sf_dir, keep_order=True), F.col("_seq")
    raw = raw.withColumns({
        "smoke": F.when(n % 5 == 0, "inf").when(n % 5 == 1, "3e12").otherwise(F.col("smoke")),
        "temp": F.when(n % 7 == 0, "-inf").when(n % 7 == 1, "3e12").when(n % 7 == 2, "1e300").otherwise(F.col("temp"))})
    return dedupe_readings(accepted_readings(classify_rows(raw, REGISTRY_INGESTED_AT)))


@register("extreme_statistics", O.with_extremes(" UNION ALL ".join(
    f"SELECT '{f}' AS field, min({f}) AS min, max({f}) AS max, {O.round_even(f'avg({f})', 4)} AS avg, "
    f"count({f}) AS non_null_count FROM rd" for f in validate.STAT_FIELDS)))
def q_extreme_statistics(spark, sf_dir):
    return validate.basic_statistics(extreme_readings(spark, sf_dir))


@register("extreme_thresholds", O.with_extremes(
    "SELECT " + ", ".join(f"{_thr_sql(f)} AS {f}" for f in Q.THRESHOLD_FIELDS)))
def q_extreme_thresholds(spark, sf_dir):
    return Q.alert_thresholds(computed_once(extreme_readings(spark, sf_dir), *Q.THRESHOLD_FIELDS))


@register("extreme_baselines", O.with_extremes(
    "SELECT device, count(*) AS readings, " + ", ".join(
        f"quantile_disc({f}, 0.5) AS {f}_p50, quantile_disc({f}, 0.9) AS {f}_p90" for f in ("smoke", "temp"))
    + " FROM rd GROUP BY device"))
def q_extreme_baselines(spark, sf_dir):
    return H.device_baselines(computed_once(extreme_readings(spark, sf_dir), "smoke", "temp"), fields=("smoke", "temp"))


@register("extreme_average_temperature", O.with_extremes(
    f"SELECT device, {O.round_even('avg(temp)', 2)} AS avg_temp, count(*) AS readings FROM rd "
    "WHERE temp IS NOT NULL GROUP BY device"))
def q_extreme_average_temperature(spark, sf_dir):
    return Q.avg_temperature_by_device(extreme_readings(spark, sf_dir))


_SEQ_ORDER = "PARTITION BY device ORDER BY timestamp, timestamp_unix, v ASC NULLS FIRST"


@register("elevated_periods", O.with_readings(
    f", x AS (SELECT device, timestamp, timestamp_unix, smoke AS v, coalesce(smoke >= {_thr_sql('smoke')}, FALSE) AS hi "
    f"FROM rd), p AS (SELECT *, coalesce(lag(hi) OVER ({_SEQ_ORDER}), FALSE) AS prev_hi FROM x), "
    "s AS (SELECT *, sum(CASE WHEN hi AND NOT prev_hi THEN 1 ELSE 0 END) OVER "
    f"({_SEQ_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period FROM p) "
    "SELECT device, min(timestamp) AS period_start, max(timestamp) AS period_end, count(*) AS readings, "
    "max(v) AS max_value FROM s WHERE hi GROUP BY device, period"))
def q_elevated_periods(spark, sf_dir):
    return H.elevated_periods(computed_once(readings(spark, sf_dir), "smoke"))


@register("device_relative_alerts", O.with_readings(
    ", b AS (SELECT device, quantile_disc(smoke, 0.9) AS device_p90 FROM rd GROUP BY device) "
    "SELECT rd.device, rd.timestamp, rd.smoke AS value, b.device_p90 FROM rd JOIN b USING (device) "
    "WHERE rd.smoke >= b.device_p90"))
def q_device_relative_alerts(spark, sf_dir):
    return H.device_relative_alerts(computed_once(readings(spark, sf_dir), "smoke"))


__all__ = ["ORACLE", "QUERIES", "classified", "flat", "loaded", "readings"]


_QUIET_US = 1_800_000_000


@register("gap_tolerant_periods", O.with_readings(
    f", x AS (SELECT device, timestamp, smoke AS v FROM rd WHERE smoke >= {_thr_sql('smoke')}), "
    "p AS (SELECT *, lag(timestamp) OVER (PARTITION BY device ORDER BY timestamp) AS before FROM x), "
    f"s AS (SELECT *, sum(CASE WHEN epoch_us(timestamp) - epoch_us(before) < {_QUIET_US} THEN 0 ELSE 1 END) OVER "
    "(PARTITION BY device ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period FROM p) "
    "SELECT device, min(timestamp) AS period_start, max(timestamp) AS period_end, count(*) AS readings, "
    "max(v) AS max_value FROM s GROUP BY device, period"))
def q_gap_tolerant_periods(spark, sf_dir):
    return H.gap_tolerant_periods(computed_once(readings(spark, sf_dir), "smoke"))


# --- files with headers of their own, kept summaries, standing queries ------------------------

@register("mixed_headers", O.with_readings(f"SELECT {FLAT_SQL} FROM rd"))
def q_mixed_headers(spark, sf_dir):
    """The raw rows as CSV files in three column orders, one with a column more, loaded as one source."""
    from envtrack.sources.table import read_readings
    from envtrack.streaming.load import load_readings

    root = _fresh_folder(spark, "mixed_headers")
    raw = raw_readings(spark, sf_dir, keep_order=True)
    orders = [S.REQUIRED_COLUMNS, S.REQUIRED_COLUMNS[::-1], ["extra", *sorted(S.REQUIRED_COLUMNS)]]
    for i, order in enumerate(orders):
        part = raw.where(F.col("_seq") % 3 == i).withColumn("extra", F.lit('not "read", ever'))
        part.select(*order).write.option("header", True).option("escape", '"').csv(f"{root}/input/{i}")
    load_readings(spark, f"{root}/input", f"{root}/readings", f"{root}/state", files_per_batch=1000, delay_seconds=0,
                  ingested_at=REGISTRY_INGESTED_AT)
    return flat(read_readings(spark, f"{root}/readings"))


def _table_of_parts(spark: SparkSession, sf_dir: str, name: str, parts: list) -> str:
    """A new readings table of the accepted rows, copies among the parts included, one batch for each
    condition on the raw rows in ``parts``; written in that order."""
    from envtrack.sources.table import merge_into_table

    root = _fresh_folder(spark, name)
    docs = accepted_readings(classify_rows(raw_readings(spark, sf_dir, keep_order=True), REGISTRY_INGESTED_AT, keep=["_seq"]),
                             keep=["_seq"])
    for i, condition in enumerate(parts):
        merge_into_table(docs.where(condition).drop("_seq"), f"{root}/readings", f"batch-{i:06d}")
    return root


@register("compacted_table", O.with_readings(f"SELECT {FLAT_SQL} FROM rd"))
def q_compacted_table(spark, sf_dir):
    """K1: three overlapping batches, settled and written anew as a table without copies."""
    from envtrack.sources.table import compact, stored_parts

    root = _table_of_parts(spark, sf_dir, "compacted", ["_seq % 3 <> 0", "_seq % 2 = 0", "_seq % 5 <> 1 or _seq % 3 = 0"])
    compact(spark, f"{root}/readings", f"{root}/compacted")
    return flat(stored_parts(spark, f"{root}/compacted"))


@register("kept_validation_report", ORACLE["validation_report"])
def q_kept_validation_report(spark, sf_dir):
    """A6-A16 from per-day parts: made for a first batch, then renewed for the days that a second one touched."""
    from envtrack.plans import summaries
    from envtrack.sources.table import merge_into_table

    root = _table_of_parts(spark, sf_dir, "kept_report", ["_seq % 3 <> 0"])
    summaries.refresh(spark, f"{root}/readings", f"{root}/summaries")
    merge_into_table(loaded(spark, sf_dir), f"{root}/readings", "batch-000001")
    summaries.refresh(spark, f"{root}/readings", f"{root}/summaries")
    return summaries.validation_report(spark, f"{root}/summaries")


@register("kept_quantiles", O.with_readings(
    ", l AS (SELECT device, 'co' AS field, co AS v FROM rd UNION ALL SELECT device, 'lpg', lpg FROM rd "
    "UNION ALL SELECT device, 'smoke', smoke FROM rd) SELECT device, field, count(*) AS n, TRUE AS p50_within, "
    "TRUE AS p90_within FROM l WHERE v IS NOT NULL GROUP BY ALL"))
def q_kept_quantiles(spark, sf_dir):
    """A13/A19 from sketches kept by day and device: whether each estimate's rank is within the stated error
    (twice that, as some hundred sketches are looked at and each holds it with 99 of 100)."""
    from envtrack.plans import summaries
    from envtrack.sources.table import read_readings

    root = _table_of_parts(spark, sf_dir, "kept_quantiles", ["true"])
    summaries.refresh(spark, f"{root}/readings", f"{root}/summaries")
    ps = {"p50": 0.5, "p90": 0.9}
    found = summaries.kept_quantiles(spark, f"{root}/summaries", ps, by_device=True)
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"measurements.{f}").alias("v")) for f in Q.THRESHOLD_FIELDS])
    values = read_readings(spark, f"{root}/readings").select("device", F.explode(entries).alias("e")).select(
        "device", "e.*").where("v is not null")
    ranks = values.join(found, ["device", "field"]).groupBy("device", "field", "n").agg(
        *[x for p in ps for x in (F.count_if(F.col("v") < F.col(p)).alias(f"{p}_below"),
                                  F.count_if(F.col("v") <= F.col(p)).alias(f"{p}_upto"))])
    slack = 2 * summaries.RANK_ERROR * F.col("n") + 1
    return ranks.select("device", "field", "n", *[
        ((F.col(f"{p}_below") <= q * F.col("n") + slack) & (F.col(f"{p}_upto") >= q * F.col("n") - slack)).alias(f"{p}_within")
        for p, q in ps.items()])


@register("kept_distinct_devices", O.with_readings(
    "SELECT count(DISTINCT device) AS devices, TRUE AS within FROM rd "
    f"WHERE event_date >= DATE '{WINDOW_START}' AND event_date < DATE '{WINDOW_END}'"))
def q_kept_distinct_devices(spark, sf_dir):
    """A10 of a range of days from one sketch a day, against the exact number (5 % of it, three standard errors)."""
    from envtrack.plans import summaries
    from envtrack.sources.table import read_readings

    root = _table_of_parts(spark, sf_dir, "kept_devices", ["true"])
    summaries.refresh(spark, f"{root}/readings", f"{root}/summaries")
    exact = read_readings(spark, f"{root}/readings").where(F.col("event_date").between(
        F.lit(WINDOW_START), F.lit(WINDOW_END - _dt.timedelta(days=1)))).agg(F.count_distinct("device").alias("devices"))
    found = summaries.kept_distinct_devices(spark, f"{root}/summaries", WINDOW_START, WINDOW_END)
    return exact.select("devices", (F.abs(found.scalar() - F.col("devices")) <= 0.05 * F.col("devices")).alias("within"))


@register("streamed_first_copies", O.with_readings(f"SELECT DISTINCT timestamp, {_KEYS} FROM acc"))
def q_streamed_first_copies(spark, sf_dir):
    """W1 on a stream of two overlapping batches, the later readings first."""
    from envtrack.streaming import live

    root = _table_of_parts(spark, sf_dir, "streamed_copies", ["_seq % 3 <> 0", "_seq % 3 = 0 or _seq % 2 = 0"])
    out = live.run(live.first_copies(live.arriving(spark, f"{root}/readings"), "400 days"), f"{root}/out", f"{root}/checkpoint")
    return out.select(utc_ntz(F.col("timestamp")).alias("timestamp"), "device", "timestamp_unix",
                      *[F.col(f"measurements.{f}").alias(f) for f in ("co", "humidity", "light", "lpg", "motion", "smoke", "temp")])


_HOUR_US = 3_600_000_000


@register("streamed_window_alerts", O.with_readings(
    f", w AS (SELECT device, make_timestamp(CAST(floor(epoch_us(timestamp) / {_HOUR_US}) AS BIGINT) * {_HOUR_US}) AS window_start, "
    "count(*) AS readings, count_if(smoke >= 0.02) AS elevated, max(smoke) AS max_value FROM rd GROUP BY ALL) "
    "SELECT device, window_start, window_start + INTERVAL 1 HOUR AS window_end, readings, elevated, max_value FROM w "
    "WHERE elevated >= 1 AND window_start + INTERVAL 1 HOUR <= (SELECT max(timestamp) - INTERVAL 1 DAY FROM rd)"))
def q_streamed_window_alerts(spark, sf_dir):
    """W7 by hourly windows of a stream: every window that the watermark has passed, once."""
    from envtrack.streaming import live

    root = _table_of_parts(spark, sf_dir, "streamed_windows", ["true"])
    alerts = live.window_alerts(live.arriving(spark, f"{root}/readings"), "smoke", 0.02, "1 hour", lateness="1 day")
    return live.run(alerts, f"{root}/out", f"{root}/checkpoint")


@register("standing_silence_alarms", f"SELECT device, last_timestamp FROM ({ORACLE['silent_devices']}) WHERE is_silent")
def q_standing_silence_alarms(spark, sf_dir):
    """W3 as a standing alarm, over the older half of the readings and then the newer one: the devices whose
    alarm is still up are those that ``silent_devices`` finds."""
    from envtrack.sources.table import write_part
    from envtrack.streaming import live

    root = _fresh_folder(spark, "silence")
    rows = kept(readings(spark, sf_dir), "readings")
    limits = kept(H.silent_devices(rows).where("median_interval_seconds is not null").select(
        "device", (F.col("median_interval_seconds") * 3).alias("limit_seconds")), "limits")
    at = micros(F.col("timestamp"))  # raw epochs are in seconds or milliseconds and do not order the readings
    half = rows.agg(F.avg(at)).first()[0]
    for i, part in enumerate((at < half, at >= half)):
        write_part(rows.where(part), f"{root}/readings", f"batch-{i}")
        events = live.run(live.silence_alarms(live.arriving(spark, f"{root}/readings"), limits), f"{root}/out", f"{root}/checkpoint")
    last = events.groupBy("device").agg(F.max_by("event", F.struct("at", F.col("event") == "raised")).alias("event"),
                                        F.max("last_timestamp").alias("last_timestamp"))
    return last.where("event = 'raised'").select("device", "last_timestamp")
