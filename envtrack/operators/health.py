"""Device-health analyses the reference's docs ask for (time buckets, baselines, silence, gaps,
sparse and dense devices, elevated periods).

The thresholds here are our parameters (the reference states the needs, not the numbers):
silence = 3 x the device's median interval, sparse = fewer than 0.5 x the mean readings per
device, dense = at least 10 readings in one minute, gap = more than one hour. The as-of time for
silence is the table's newest timestamp, never the wall clock, so results are reproducible.

All aggregations combine map-side; per-device sequence work goes through ``sequence`` (chunked by
time, so a hot device is spread over many tasks); percentiles are exact, by distributed selection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envtrack.functions.numeric import round_even
from envtrack.functions.timecols import bucket_start, micros, utc_ntz
from envtrack.operators.quantiles import quantiles_of_counts, value_counts
from envtrack.operators.sequence import DEFAULT_CHUNK_SECONDS, with_islands, with_previous
from envtrack.plans.queries import MEASUREMENT_ORDER, THRESHOLD_FIELDS, alert_threshold, base

def _m(f: str):
    return F.col(f"measurements.{f}")


def _lifted():
    return [_m(f).alias(f) for f in MEASUREMENT_ORDER]


def hourly_by_device(readings: DataFrame, bucket_seconds: int = 3600, valid_only: bool = False) -> DataFrame:
    """Per device and epoch-aligned bucket: count, temperature avg/min/max, humidity avg,
    smoke/co/lpg max (averages rounded to 4 places)."""
    r = base(readings, valid_only)
    return (r.groupBy("device", bucket_start(F.col("timestamp"), bucket_seconds).alias("bucket"))
            .agg(F.count("*").alias("readings"),
                 round_even(F.avg(_m("temp")), 4).alias("avg_temp"),
                 F.min(_m("temp")).alias("min_temp"), F.max(_m("temp")).alias("max_temp"),
                 round_even(F.avg(_m("humidity")), 4).alias("avg_humidity"),
                 F.max(_m("smoke")).alias("max_smoke"), F.max(_m("co")).alias("max_co"),
                 F.max(_m("lpg")).alias("max_lpg")))


def flags_per_device(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """How often each quality flag occurs per device (none among valid readings)."""
    return (base(readings, valid_only).select("device", F.explode("quality.flags").alias("flag"))
            .groupBy("device", "flag").agg(F.count("*").alias("occurrences")))


def device_baselines(readings: DataFrame, fields=tuple(THRESHOLD_FIELDS), valid_only: bool = False) -> DataFrame:
    """Per-device median and p90 of each field, exact, as ``<field>_p50`` / ``<field>_p90``.

    One count of values per device and field serves both; readings without any value are counted with
    a null value, so that one scan gives the number of readings too.
    """
    r = base(readings, valid_only)
    entries = [F.struct(F.lit("").alias("field"), F.lit(0.0).alias("value"))]
    entries += [F.struct(F.lit(f).alias("field"), _m(f).alias("value")) for f in fields]
    counts = (r.select("device", F.explode(F.array(*entries)).alias("e")).select("device", "e.*")
              .groupBy("device", "field", "value").agg(F.count("*").alias("n")))
    readings_of = counts.where(F.col("field") == "").select("device", F.col("n").alias("readings"))
    q = quantiles_of_counts(counts.where((F.col("field") != "") & F.col("value").isNotNull()), ["device", "field"],
                            {"p50": 0.5, "p90": 0.9}, rows=r.select("device").withColumn("field", F.lit("")))
    names = [(f, p) for f in fields for p in ("p50", "p90")]
    wide = q.groupBy("device").agg(*[F.max(F.when(F.col("field") == f, F.col(p))).alias(f"{f}_{p}") for f, p in names])
    return readings_of.join(wide, "device", "left").select("device", "readings", *[f"{f}_{p}" for f, p in names])


SPREAD_FIELDS = ["temp", "humidity", "co", "lpg", "smoke"]


def spread_by_device(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """Per device and field: min, max, range and sample standard deviation (6 places)."""
    r = base(readings, valid_only)
    aggs = []
    for f in SPREAD_FIELDS:
        aggs += [F.min(_m(f)).alias(f"{f}_min"), F.max(_m(f)).alias(f"{f}_max"),
                 F.stddev_samp(_m(f)).alias(f"{f}_sd")]
    wide = r.groupBy("device").agg(*aggs)
    rows = ", ".join(f"'{f}', {f}_min, {f}_max, {f}_sd" for f in SPREAD_FIELDS)
    long = wide.selectExpr("device", f"stack({len(SPREAD_FIELDS)}, {rows}) AS (field, min, max, sd)")
    return long.select("device", "field", "min", "max", (F.col("max") - F.col("min")).alias("range"),
                       round_even(F.col("sd"), 6).alias("stddev"))


def _latest_struct():
    # order: timestamp, raw epoch, then the values (null lowest) -- a total order for ties
    return F.struct(F.col("timestamp").alias("t"), F.col("timestamp_unix").alias("u"),
                    *[_m(f).alias(f) for f in MEASUREMENT_ORDER])


def downsample(readings: DataFrame, bucket_seconds: int = 6 * 3600, valid_only: bool = False) -> DataFrame:
    """One reading per (device, bucket) -- the last one -- plus the bucket's count."""
    r = base(readings, valid_only)
    agg = (r.groupBy("device", bucket_start(F.col("timestamp"), bucket_seconds).alias("bucket"))
           .agg(F.max(_latest_struct()).alias("_l"), F.count("*").alias("readings")))
    return agg.select("device", "bucket", utc_ntz(F.col("_l.t")).alias("timestamp"),
                      *[F.col(f"_l.{f}").alias(f) for f in MEASUREMENT_ORDER], "readings")


def latest_per_device(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """Each device's newest reading (a max-struct aggregate, no window)."""
    r = base(readings, valid_only)
    agg = r.groupBy("device").agg(F.max(_latest_struct()).alias("_l"))
    return agg.select("device", utc_ntz(F.col("_l.t")).alias("timestamp"), F.col("_l.u").alias("timestamp_unix"),
                      *[F.col(f"_l.{f}").alias(f) for f in MEASUREMENT_ORDER])


def _with_gaps(readings: DataFrame, chunk_seconds: int) -> DataFrame:
    r = readings.select("device", "timestamp", "timestamp_unix", micros(F.col("timestamp")).alias("_us"))
    p = with_previous(r, "device", "timestamp", ["timestamp", "timestamp_unix"], ["timestamp", "_us"],
                      chunk_seconds=chunk_seconds)
    return p.withColumn("gap_seconds", (F.col("_us") - F.col("prev__us")) / 1e6)


def reading_gaps(readings: DataFrame, min_gap_seconds: float = 3600.0,
                 chunk_seconds: int = DEFAULT_CHUNK_SECONDS, valid_only: bool = False) -> DataFrame:
    """Gaps longer than ``min_gap_seconds`` between consecutive readings of a device."""
    g = _with_gaps(base(readings, valid_only), chunk_seconds)
    return (g.where(F.col("gap_seconds") > min_gap_seconds)
            .select("device", utc_ntz(F.col("prev_timestamp")).alias("gap_start"),
                    utc_ntz(F.col("timestamp")).alias("gap_end"), "gap_seconds"))


def silent_devices(readings: DataFrame, factor: float = 3.0, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                   valid_only: bool = False) -> DataFrame:
    """Per device, last reading, median interval and silence up to the table's newest reading;
    ``is_silent`` when the silence exceeds ``factor`` x the median interval.

    The gaps are reduced at once to counts of equal gaps with their newest time; everything else is
    read off those counts.
    """
    r = base(readings, valid_only)
    counts = _with_gaps(r, chunk_seconds).groupBy("device", "gap_seconds").agg(
        F.count("*").alias("n"), F.max("timestamp").alias("_last"))
    last = counts.groupBy("device").agg(F.max("_last").alias("_last"))
    gaps = counts.where(F.col("gap_seconds").isNotNull()).select("device", F.col("gap_seconds").alias("value"), "n")
    per = last.join(quantiles_of_counts(gaps, ["device"], {"median_interval_seconds": 0.5}, rows=r), "device", "left")
    as_of = last.agg(F.max("_last")).scalar()
    silence = (micros(as_of) - micros(F.col("_last"))) / 1e6
    return per.select(
        "device", utc_ntz(F.col("_last")).alias("last_timestamp"), "median_interval_seconds",
        silence.alias("silence_seconds"),
        F.coalesce(silence > F.lit(factor) * F.col("median_interval_seconds"), F.lit(False)).alias("is_silent"))


def sparse_devices(readings: DataFrame, ratio: float = 0.5, valid_only: bool = False) -> DataFrame:
    """Readings per device against the mean over devices; sparse below ``ratio`` x mean."""
    per = base(readings, valid_only).groupBy("device").agg(F.count("*").alias("readings"))
    mean = per.agg(F.avg("readings")).scalar()
    return per.select("device", "readings", round_even(mean, 2).alias("mean_readings"),
                      round_even(F.col("readings") / mean, 4).alias("ratio_to_mean"),
                      (F.col("readings") < F.lit(ratio) * mean).alias("is_sparse"))


def dense_bursts(readings: DataFrame, window_seconds: int = 60, min_readings: int = 10,
                 valid_only: bool = False) -> DataFrame:
    """(device, window) cells holding at least ``min_readings`` readings."""
    return (base(readings, valid_only).groupBy("device", bucket_start(F.col("timestamp"), window_seconds).alias("window_start"))
            .agg(F.count("*").alias("readings")).where(F.col("readings") >= min_readings))


def rolling_bursts(readings: DataFrame, window_seconds: int = 60, min_readings: int = 10,
                   valid_only: bool = False) -> DataFrame:
    """W6, rolling: readings that end a window of ``window_seconds`` (both ends included) with at least
    ``min_readings`` readings of their device, wherever the window lies.

    Rows are grouped by device and span of one window's length, and each is also shown to the next span,
    so that a group holds what two windows hold and a busy device is spread over its spans.
    """
    width = window_seconds * 1_000_000
    r = base(readings, valid_only).select("device", micros(F.col("timestamp")).alias("_us"))
    own = F.floor(F.col("_us") / width)
    seen = r.select("device", "_us", own.alias("_own"), F.explode(F.array(own, own + 1)).alias("_span"))
    back = Window.partitionBy("device", "_span").orderBy("_us").rangeBetween(-width, 0)
    return (seen.withColumn("readings", F.count("*").over(back))
            .where((F.col("_span") == F.col("_own")) & (F.col("readings") >= min_readings))
            .select("device", utc_ntz(F.timestamp_micros("_us")).alias("window_end"), "readings"))


def device_burst_density(readings: DataFrame, window_seconds: int = 60, valid_only: bool = False) -> DataFrame:
    """W6 (summary): per device, the most readings seen in one window and in how many windows."""
    cells = (base(readings, valid_only).groupBy("device", bucket_start(F.col("timestamp"), window_seconds).alias("w"))
             .agg(F.count("*").alias("n")))
    return cells.groupBy("device").agg(F.max("n").alias("max_readings_per_window"),
                                       F.count("*").alias("windows_with_readings"))


def elevated_periods(readings: DataFrame, field: str = "smoke", threshold=None,
                     chunk_seconds: int = DEFAULT_CHUNK_SECONDS, valid_only: bool = False) -> DataFrame:
    """Maximal runs of consecutive readings of a device with ``field >= threshold``.

    Gaps and islands: a run starts where the previous reading (of the same device) was not
    elevated; the running count of starts numbers the runs; runs are then aggregated. The default
    threshold is the field's alert threshold (p90), found by a few jobs when the query is built.
    """
    r = base(readings, valid_only)
    if threshold is None:
        threshold = alert_threshold(readings, field, valid_only)
    threshold = F.lit(float(threshold))
    x = r.select("device", "timestamp", "timestamp_unix", _m(field).alias("v"),
                 F.coalesce(_m(field) >= threshold, F.lit(False)).alias("_hi"))
    numbered = with_islands(x, "device", "timestamp", ["timestamp", "timestamp_unix", "v"], "_hi", "period",
                            chunk_seconds=chunk_seconds)
    return (numbered.where(F.col("_hi")).groupBy("device", "period")
            .agg(utc_ntz(F.min("timestamp")).alias("period_start"), utc_ntz(F.max("timestamp")).alias("period_end"),
                 F.count("*").alias("readings"), F.max("v").alias("max_value"))
            .select("device", "period_start", "period_end", "readings", "max_value"))


def gap_tolerant_periods(readings: DataFrame, field: str = "smoke", threshold=None, quiet_seconds: float = 1800.0,
                         chunk_seconds: int = DEFAULT_CHUNK_SECONDS, valid_only: bool = False) -> DataFrame:
    """W7 with gaps: periods of readings of a device with ``field >= threshold``, each less than
    ``quiet_seconds`` behind the one before; what lies between them does not end a period.

    Session windows, in two levels: sessions inside each (device, chunk), so that a busy device is spread over
    its chunks, and then sessions of those sessions, of which there are few, each as long as it is and the
    quiet gap behind it. The widths of chunks make no difference to the result.
    """
    r = base(readings, valid_only)
    if threshold is None:
        threshold = alert_threshold(readings, field, valid_only)
    quiet = int(round(quiet_seconds * 1e6))
    high = r.where(_m(field) >= F.lit(float(threshold))).select("device", "timestamp", _m(field).alias("v"))
    inner = high.groupBy("device", F.floor(micros(F.col("timestamp")) / (chunk_seconds * 1_000_000)).alias("_chunk"),
                         F.session_window("timestamp", f"{quiet} microseconds").alias("_w")).agg(
        F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to"), F.count("*").alias("_n"), F.max("v").alias("_max"))
    length = F.concat((micros(F.col("_to")) - micros(F.col("_from")) + quiet).cast("string"), F.lit(" microseconds"))
    parts = inner.select("device", "_from", "_to", "_n", "_max")
    return parts.groupBy("device", F.session_window("_from", length).alias("_w")).agg(
        utc_ntz(F.min("_from")).alias("period_start"), utc_ntz(F.max("_to")).alias("period_end"),
        F.sum("_n").alias("readings"), F.max("_max").alias("max_value")).drop("_w")


def device_relative_alerts(readings: DataFrame, field: str = "smoke", valid_only: bool = False) -> DataFrame:
    """Readings at or above their own device's p90 of ``field``.

    The readings meet their device's p90 in a plain join: adaptive execution broadcasts the devices if
    they turn out to be few, and otherwise splits the readings of a busy device among tasks.
    """
    r = base(readings, valid_only).where(_m(field).isNotNull())
    p90 = quantiles_of_counts(value_counts(r, ["device"], _m(field)), ["device"], {"device_p90": 0.9}, rows=r)
    rows = r.select("device", "timestamp", _m(field).alias("value"))
    return (rows.join(p90, "device").where(F.col("value") >= F.col("device_p90"))
            .select("device", utc_ntz(F.col("timestamp")).alias("timestamp"), "value", "device_p90"))
