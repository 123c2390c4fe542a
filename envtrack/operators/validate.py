"""Validation report over the readings table.

The reference issues one server request per statistic; here the whole table-wide part is one scan
with one wide aggregate (A6-A9, A12), plus one ``groupBy(device)`` for distinct devices and
density (A10, A11). The full report (A14-A16) is a two-level aggregate -- per-device partials,
then one global row -- with the verdicts as column expressions on that row; no joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envtrack import schema as S
from envtrack.functions.numeric import round_even
from envtrack.functions.timecols import utc_ntz

STAT_FIELDS = ["temp", "humidity", "co", "lpg", "smoke"]
NULL_FIELDS = STAT_FIELDS + S.BOOL_FIELDS
EXPECTED_MEASUREMENT_FIELDS = sorted(S.FLOAT_FIELDS + S.BOOL_FIELDS)


def _m(f: str):
    return F.col(f"measurements.{f}")


def measurement_fields(readings: DataFrame) -> list[str]:
    """Measurement field names from the table schema (sorted), or the expected list."""
    try:
        return sorted(readings.schema["measurements"].dataType.fieldNames())
    except (KeyError, AttributeError):
        return list(EXPECTED_MEASUREMENT_FIELDS)


def table_metrics(readings: DataFrame) -> DataFrame:
    """One pass, one row: counts, time bounds, per-field statistics, null counts, quality counts."""
    aggs = [
        F.count("*").alias("total_documents"),
        F.min("timestamp").alias("_first"),
        F.max("timestamp").alias("_latest"),
        F.count_if(F.col("quality").isNotNull()).alias("documents_with_quality_field"),
        F.count_if(F.col("quality.is_valid") == F.lit(False)).alias("documents_with_quality_is_valid_false"),
        F.count_if(F.size(F.col("quality.flags")) > 0).alias("documents_with_quality_flags"),
    ]
    for f in STAT_FIELDS:
        aggs += [F.min(_m(f)).alias(f"{f}_min"), F.max(_m(f)).alias(f"{f}_max"),
                 F.avg(_m(f)).alias(f"{f}_avg"), F.count(_m(f)).alias(f"{f}_count")]
    for f in NULL_FIELDS:
        aggs.append(F.count_if(_m(f).isNull()).alias(f"{f}_nulls"))
    return readings.agg(*aggs)


def time_bounds(readings: DataFrame) -> DataFrame:
    """First and latest timestamp (UTC, NTZ)."""
    return readings.agg(utc_ntz(F.min("timestamp")).alias("first_timestamp"),
                        utc_ntz(F.max("timestamp")).alias("latest_timestamp"))


def basic_statistics(readings: DataFrame) -> DataFrame:
    """One row per field: min, max, avg (4 places), non-null count."""
    t = table_metrics(readings)
    rows = ", ".join(f"'{f}', {f}_min, {f}_max, {f}_avg, {f}_count" for f in STAT_FIELDS)
    long = t.selectExpr(f"stack({len(STAT_FIELDS)}, {rows}) AS (field, min, max, avg, non_null_count)")
    return long.select("field", "min", "max", round_even(F.col("avg"), 4).alias("avg"),
                       F.col("non_null_count").cast("bigint").alias("non_null_count"))


def null_counts(readings: DataFrame) -> DataFrame:
    """Null count per measurement field (seven fields, one pass)."""
    t = table_metrics(readings)
    rows = ", ".join(f"'{f}', {f}_nulls" for f in NULL_FIELDS)
    return t.selectExpr(f"stack({len(NULL_FIELDS)}, {rows}) AS (field, null_count)")


def quality_metrics(readings: DataFrame) -> DataFrame:
    """Quality-metadata counts."""
    t = table_metrics(readings)
    return t.select(
        "documents_with_quality_field",
        (F.col("total_documents") - F.col("documents_with_quality_field")).alias("documents_missing_quality_field"),
        "documents_with_quality_is_valid_false",
        "documents_with_quality_flags",
        ((F.col("documents_with_quality_field") == F.col("total_documents"))
         & (F.col("total_documents") > 0)).alias("quality_field_present"),
    )


def unique_devices(readings: DataFrame, approximate: bool = False) -> DataFrame:
    """A10: number of distinct devices (``approximate`` uses HyperLogLog++ for huge tables)."""
    agg = F.approx_count_distinct("device") if approximate else F.countDistinct("device")
    return readings.agg(agg.alias("unique_devices"))


def _density_from_counts(per: DataFrame) -> DataFrame:
    """One row from per-device counts: distinct devices, and min / max / avg over named devices."""
    named = F.col("device").isNotNull() & (F.col("device") != "")
    n = F.when(named, F.col("readings"))
    return per.agg(
        F.count_if(F.col("device").isNotNull()).alias("unique_devices"),
        F.coalesce(F.min(n), F.lit(0)).cast("bigint").alias("min_readings_per_device"),
        F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias("max_readings_per_device"),
        F.coalesce(round_even(F.avg(n), 2), F.lit(0.0)).alias("avg_readings_per_device"),
        F.count_if(named).alias("devices_with_readings"),
    )


def device_density(readings: DataFrame) -> DataFrame:
    """Readings per device, then min / max / avg (2 places) over devices.

    Devices with a null or empty name are left out of the density figures.
    """
    per = readings.groupBy("device").agg(F.count("*").alias("readings"))
    return _density_from_counts(per).drop("unique_devices")


def device_parts(readings: DataFrame, *also: str) -> DataFrame:
    """Per device (and ``also``): what the validation report is made of, counts and bounds that add up."""
    return readings.groupBy(*also, "device").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
        F.count_if(F.col("quality").isNotNull()).alias("q"),
        F.count_if(F.col("quality.is_valid") == F.lit(False)).alias("inv"),
        F.count_if(F.size(F.col("quality.flags")) > 0).alias("fl"))


def validation_report(readings: DataFrame) -> DataFrame:
    """One row with the figures and the validity / readiness verdicts.

    Structural checks that the reference made on one sample document (device, timestamp and a
    nested measurements object present) are checked here on the table schema, which Spark fixes.
    A two-level aggregate, no join: per-device parts (map-side combined), then one global row.
    """
    fields = measurement_fields(readings)
    has_fields = set(EXPECTED_MEASUREMENT_FIELDS).issubset(fields)
    schema_ok = has_fields and {"device", "timestamp", "measurements"}.issubset(set(readings.columns))
    return report_of_devices(device_parts(readings), fields, schema_ok)


def report_of_devices(per: DataFrame, fields: list[str], schema_ok: bool) -> DataFrame:
    """The report from one row of ``device_parts`` for each device."""
    named = F.col("device").isNotNull() & (F.col("device") != "")
    j = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_documents"),
        F.count_if(F.col("device").isNotNull()).alias("unique_devices"),
        F.min("first").alias("_first"), F.max("last").alias("_latest"),
        F.coalesce(F.sum("q"), F.lit(0)).cast("bigint").alias("documents_with_quality_field"),
        F.coalesce(F.sum("inv"), F.lit(0)).cast("bigint").alias("documents_with_quality_is_valid_false"),
        F.coalesce(F.sum("fl"), F.lit(0)).cast("bigint").alias("documents_with_quality_flags"),
        F.coalesce(F.min(F.when(named, F.col("n"))), F.lit(0)).cast("bigint").alias("min_readings_per_device"),
        F.coalesce(F.max(F.when(named, F.col("n"))), F.lit(0)).cast("bigint").alias("max_readings_per_device"),
        F.coalesce(round_even(F.avg(F.when(named, F.col("n"))), 2), F.lit(0.0)).alias("avg_readings_per_device"),
    )

    total = F.col("total_documents")
    first, latest = F.col("_first"), F.col("_latest")
    range_ok = first.isNotNull() & latest.isNotNull() & (first <= latest)
    quality_present = (F.col("documents_with_quality_field") == total) & (total > 0)
    data_valid = ((total > 0) & (F.col("unique_devices") > 0) & range_ok & F.lit(schema_ok) & quality_present)
    blockers = F.array_compact(F.array(
        F.when(total == 0, F.lit(S.BLOCKER_EMPTY)),
        F.when(~data_valid, F.lit(S.BLOCKER_STRUCTURE)),
        F.when(total - F.col("documents_with_quality_field") > 0, F.lit(S.BLOCKER_QUALITY_FIELD)),
        F.when(F.col("min_readings_per_device") < 1, F.lit(S.BLOCKER_NO_DEVICE_READINGS)),
    ))
    return j.select(
        total.alias("total_documents"),
        F.col("unique_devices"),
        utc_ntz(first).alias("first_timestamp"),
        utc_ntz(latest).alias("latest_timestamp"),
        range_ok.alias("timestamp_range_valid"),
        F.lit(",".join(fields)).alias("measurement_fields"),
        (total - F.col("documents_with_quality_field")).alias("documents_missing_quality_field"),
        F.col("documents_with_quality_is_valid_false"),
        F.col("documents_with_quality_flags"),
        F.col("min_readings_per_device"),
        F.col("max_readings_per_device"),
        F.col("avg_readings_per_device"),
        (total > 0).alias("data_present"),
        data_valid.alias("data_valid"),
        (F.size(blockers) == 0).alias("ready_for_queries"),
        F.array_join(blockers, "; ").alias("readiness_blockers"),
    )


def example_document(readings: DataFrame) -> DataFrame:
    """One example reading (smallest id, so the choice is stable)."""
    return readings.orderBy("reading_id").limit(1)
