"""Kept summaries of a readings table: small parts by day and device, renewed only where days changed.

``<root>/devices/event_date=D/`` has a row for each device of a day: the parts of the validation report and,
for each alert field, a mergeable KLL sketch of its values. ``<root>/days/event_date=D/`` has one row: an HLL
sketch of the day's devices and the *stamp* of the table's files that it was made from. ``refresh`` compares
stamps (which asks for partition columns and file times alone), makes the parts of changed days anew and
writes the stamps last, so that a refresh that fails is done again.

Whatever is asked of the summaries reads them and not the readings: the validation report of the whole
table, quantiles of any days and devices within a stated rank error, distinct devices of any days. Exact
quantiles (``operators.quantiles``) stay the default of every query.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envtrack.operators import validate as V
from envtrack.plans.queries import THRESHOLD_FIELDS
from envtrack.sources.storage import kept, read_if_exists
from envtrack.sources.table import read_readings, stored_parts

#: Size of a KLL sketch and log2 of the buckets of an HLL sketch.
KLL_SIZE, HLL_BITS = 1024, 12
#: A quantile's rank is off by no more than this share of the values, with 99 of 100 sketches.
RANK_ERROR = 2.446 / KLL_SIZE**0.9433

DEVICES_SCHEMA = ("device string, n bigint, first timestamp, last timestamp, q bigint, inv bigint, fl bigint, "
                  + ", ".join(f"{f}_kll binary" for f in THRESHOLD_FIELDS) + ", event_date date")
DAYS_SCHEMA = "rows bigint, files timestamp, parts bigint, device_hll binary, event_date date"


def _sketch(field: str) -> Column:
    return F.kll_sketch_agg_double(F.col(f"measurements.{field}"), F.lit(KLL_SIZE)).alias(f"{field}_kll")


def _write(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path))


def changed_days(spark: SparkSession, table: str, root: str) -> DataFrame | None:
    """event_date and stamp of the days whose files are not those that the summaries were made from."""
    stored = stored_parts(spark, table)
    if stored is None:
        return None
    stamps = stored.groupBy("event_date").agg(F.count("*").alias("rows"), F.max("_metadata.file_modification_time").alias("files"),
                                              F.count_distinct("batch").alias("parts"))
    days = read_if_exists(spark, f"{root}/days", DAYS_SCHEMA)
    return stamps if days is None else stamps.join(days, ["event_date", "rows", "files", "parts"], "left_anti")


def refresh(spark: SparkSession, table: str, root: str) -> int:
    """Bring the summaries below ``root`` up to date; returns the number of days made anew."""
    root = root.rstrip("/")
    changed = changed_days(spark, table, root)
    if changed is None:
        return 0
    changed = kept(changed, "changed-days")
    if not (number := changed.count()):
        return 0
    readings = read_readings(spark, table).join(changed.select("event_date"), "event_date", "left_semi")
    keys = ["event_date", "device"]
    sketches = readings.groupBy(*keys).agg(*[_sketch(f) for f in THRESHOLD_FIELDS])
    parts = V.device_parts(readings, "event_date")
    same = F.expr(" and ".join(f"l.{k} <=> r.{k}" for k in keys))
    _write(parts.alias("l").join(sketches.alias("r"), same).select("l.*", *[f"r.{f}_kll" for f in THRESHOLD_FIELDS]),
           f"{root}/devices")
    devices = spark.read.schema(DEVICES_SCHEMA).parquet(f"{root}/devices").join(changed.select("event_date"), "event_date", "left_semi")
    hll = devices.groupBy("event_date").agg(F.hll_sketch_agg("device", F.lit(HLL_BITS)).alias("device_hll"))
    _write(changed.join(hll, "event_date").select("rows", "files", "parts", "device_hll", "event_date"), f"{root}/days")
    return number


def _range(df: DataFrame, start: _dt.date | None, end: _dt.date | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("event_date") >= F.lit(start))
    return df if end is None else df.where(F.col("event_date") < F.lit(end))


def _devices(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_exists(spark, f"{root.rstrip('/')}/devices", DEVICES_SCHEMA)
    return spark.createDataFrame([], DEVICES_SCHEMA) if found is None else found


def validation_report(spark: SparkSession, root: str, start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """A14-A16 from the summaries, of the whole table or of the days from ``start`` to before ``end``."""
    parts = _range(_devices(spark, root), start, end).groupBy("device").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("q").alias("q"),
        F.sum("inv").alias("inv"), F.sum("fl").alias("fl"))
    return V.report_of_devices(parts, list(V.EXPECTED_MEASUREMENT_FIELDS), True)


def kept_quantiles(spark: SparkSession, root: str, ps: dict[str, float], by_device: bool = False,
                   start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """(device,) field, n and one column for each name of ``ps``: quantiles within ``RANK_ERROR``.

    Sketches of the chosen days (and devices) are merged; a field without values has no row."""
    keys = ["device"] if by_device else []
    merged = _range(_devices(spark, root), start, end).groupBy(*keys).agg(
        *[F.kll_merge_agg_double(f"{f}_kll").alias(f) for f in THRESHOLD_FIELDS])
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("sketch")) for f in THRESHOLD_FIELDS])
    long = merged.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*").where("sketch is not null")
    some = long.withColumn("n", F.kll_sketch_get_n_double("sketch")).where("n > 0")
    return some.select(*keys, "field", "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name)
                                              for name, p in ps.items()])


def kept_distinct_devices(spark: SparkSession, root: str, start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """One row, unique_devices: distinct devices of any days (A10) from one small sketch a day."""
    days = read_if_exists(spark, f"{root.rstrip('/')}/days", DAYS_SCHEMA)
    days = spark.createDataFrame([], DAYS_SCHEMA) if days is None else days
    union = F.hll_union_agg("device_hll")
    return _range(days, start, end).agg(F.coalesce(F.hll_sketch_estimate(union), F.lit(0)).cast("bigint").alias("unique_devices"))
