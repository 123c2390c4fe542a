"""The ten published example queries, the alert thresholds they use, and two documented filters.

Every function takes the readings table (a DataFrame in the stored schema) and returns a lazy
DataFrame. Timestamps are emitted as UTC TIMESTAMP_NTZ (independent of the session zone) and the
nested measurements are lifted to top-level columns.

Plan notes:

* top-k (sort + limit) plans as ``TakeOrderedAndProject``: each task keeps its k best rows and
  only those reach the driver, so no global sort or shuffle of the table;
* thresholds are exact p90 values found by distributed selection when the query is built; they
  enter the filter as a one-row scalar (no join), so the comparison is pushed to the Parquet scan;
* filters on nested measurement fields reach the Parquet scan as pushed filters, and nested-schema
  pruning reads only the fields a query uses;
* ``valid_only=True`` keeps readings without quality flags (also for threshold derivation).

Ties: the reference sorts on one key, so ties were arbitrary. We add tie-breaks so results are
deterministic: newest timestamp, then device, then the raw epoch number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envtrack import schema as S
from envtrack.functions.numeric import round_even
from envtrack.functions.timecols import bucket_start, utc_ntz
from envtrack.operators.quantiles import exact_quantile_values

MEASUREMENT_ORDER = ["co", "humidity", "lpg", "smoke", "temp", "light", "motion"]
THRESHOLD_FIELDS = ["smoke", "co", "lpg"]


def m(field: str) -> Column:
    return F.col(f"measurements.{field}")


def base(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    return readings.where(F.col("quality.is_valid")) if valid_only else readings


def _lifted() -> list[Column]:
    return [m(f).alias(f) for f in MEASUREMENT_ORDER]


def _thresholds(readings: DataFrame, fields: list[str], valid_only: bool, percentile: float) -> DataFrame:
    values = exact_quantile_values(base(readings, valid_only), {f: m(f) for f in fields}, percentile)
    given = [S.DEFAULT_THRESHOLDS[f] if values[f] is None else values[f] for f in fields]
    return readings.sparkSession.range(0, 1, 1, 1).select(*[
        round_even(F.lit(float(v)), 6).alias(f) for f, v in zip(fields, given)])


def alert_thresholds(readings: DataFrame, valid_only: bool = False,
                     percentile: float = S.ALERT_PERCENTILE) -> DataFrame:
    """One row ``smoke, co, lpg``: p90 of each field over non-null values, rounded to 6 places,
    or the fixed fallback when the field has no values.

    The percentile is exact (the value at rank ceil(0.9 * n)) and computed by distributed selection
    over the fields at once (``operators.quantiles.exact_quantile_values``): counts per value bucket,
    never a sketch funnelled into one task. Like ``approxQuantile`` it runs when called (three small
    jobs at most); queries filtering on a threshold get a plain pushed-down comparison.
    """
    return _thresholds(readings, THRESHOLD_FIELDS, valid_only, percentile)


def alert_threshold(readings: DataFrame, field: str, valid_only: bool = False,
                    percentile: float = S.ALERT_PERCENTILE) -> float:
    """The threshold of one field; the other fields are not read."""
    return _thresholds(readings, [field], valid_only, percentile).first()[0]


def latest_readings(readings: DataFrame, limit: int = 5, valid_only: bool = False) -> DataFrame:
    """Q1: the newest readings that carry measurements."""
    r = base(readings, valid_only).where(F.col("measurements").isNotNull())
    order = [F.col("timestamp").desc(), F.col("device"), F.col("timestamp_unix")] + \
        [m(f).asc_nulls_first() for f in MEASUREMENT_ORDER] + [F.col("reading_id")]
    return (r.orderBy(*order).limit(limit)
            .select("device", utc_ntz(F.col("timestamp")).alias("timestamp"), *_lifted()))


def readings_per_device(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """Q2: readings per device, most first."""
    return (base(readings, valid_only).groupBy("device").agg(F.count("*").alias("reading_count"))
            .orderBy(F.col("reading_count").desc(), F.col("device")))


def _avg_by_device(readings: DataFrame, field: str, name: str, valid_only: bool) -> DataFrame:
    r = base(readings, valid_only).where(m(field).isNotNull())
    agg = r.groupBy("device").agg(F.avg(m(field)).alias("_avg"), F.count("*").alias("readings"))
    # sort on the unrounded average (the sort stage precedes the rounding projection)
    return (agg.orderBy(F.col("_avg").desc(), F.col("device"))
            .select("device", round_even(F.col("_avg"), 2).alias(name), "readings"))


def avg_temperature_by_device(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """Q3: average temperature per device (non-null), rounded to 2 places."""
    return _avg_by_device(readings, "temp", "avg_temp", valid_only)


def avg_humidity_by_device(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """Q4: average humidity per device (non-null), rounded to 2 places."""
    return _avg_by_device(readings, "humidity", "avg_humidity", valid_only)


def _top_by(r: DataFrame, field: str, limit: int, out: str) -> DataFrame:
    order = [m(field).desc(), F.col("timestamp").desc(), F.col("device"), F.col("timestamp_unix")]
    return (r.orderBy(*order).limit(limit)
            .select("device", utc_ntz(F.col("timestamp")).alias("timestamp"), m(field).alias(out)))


def high_metric_readings(readings: DataFrame, field: str, threshold: float | Column | None = None,
                         limit: int = 20, valid_only: bool = False) -> DataFrame:
    """Q5-Q7: readings at or above the threshold (``>=``), highest first.

    Without an explicit threshold the exact p90 of ``alert_thresholds`` is used.
    """
    r = base(readings, valid_only)
    if threshold is None:
        threshold = F.lit(alert_threshold(readings, field, valid_only))
    elif not isinstance(threshold, Column):
        threshold = F.lit(float(threshold))
    return _top_by(r.where(m(field) >= threshold), field, limit, "value")


def high_smoke_readings(readings: DataFrame, limit: int = 20, valid_only: bool = False) -> DataFrame:
    return high_metric_readings(readings, "smoke", limit=limit, valid_only=valid_only)


def high_co_readings(readings: DataFrame, limit: int = 20, valid_only: bool = False) -> DataFrame:
    return high_metric_readings(readings, "co", limit=limit, valid_only=valid_only)


def high_lpg_readings(readings: DataFrame, limit: int = 20, valid_only: bool = False) -> DataFrame:
    return high_metric_readings(readings, "lpg", limit=limit, valid_only=valid_only)


def readings_by_day(readings: DataFrame, valid_only: bool = False) -> DataFrame:
    """Q8: readings per UTC calendar day, oldest first."""
    return (base(readings, valid_only).groupBy(bucket_start(F.col("timestamp"), 86_400).alias("day"))
            .agg(F.count("*").alias("reading_count")).orderBy("day"))


def highest_temperatures(readings: DataFrame, limit: int = 10, valid_only: bool = False) -> DataFrame:
    """Q9: the highest temperature readings."""
    r = base(readings, valid_only).where(m("temp").isNotNull())
    return _top_by(r, "temp", limit, "temp")


def highest_smoke(readings: DataFrame, limit: int = 10, valid_only: bool = False) -> DataFrame:
    """Q10: the highest smoke readings."""
    r = base(readings, valid_only).where(m("smoke").isNotNull())
    return _top_by(r, "smoke", limit, "smoke")


def readings_in_window(readings: DataFrame, devices: Iterable[str] | None = None, start=None,
                       end=None) -> DataFrame:
    """Readings of some devices in a half-open time window ``[start, end)``.

    ``start``/``end`` are ``datetime.date`` or timezone-aware ``datetime`` values. The window is
    also applied to the ``event_date`` partition column, so a partitioned table is pruned to the
    days of the window before any file is opened.
    """
    import datetime as _dt

    r = readings
    if devices is not None:
        r = r.where(F.col("device").isin(list(devices)))

    def as_instant(v):
        if isinstance(v, _dt.datetime):
            return v if v.tzinfo else v.replace(tzinfo=_dt.timezone.utc)
        return _dt.datetime(v.year, v.month, v.day, tzinfo=_dt.timezone.utc)

    if start is not None:
        s = as_instant(start)
        r = r.where((F.col("event_date") >= F.lit(s.astimezone(_dt.timezone.utc).date()))
                    & (F.col("timestamp") >= F.lit(s)))
    if end is not None:
        e = as_instant(end)
        r = r.where((F.col("event_date") <= F.lit(e.astimezone(_dt.timezone.utc).date()))
                    & (F.col("timestamp") < F.lit(e)))
    return r.select("device", utc_ntz(F.col("timestamp")).alias("timestamp"), "timestamp_unix",
                    *_lifted(), F.col("quality.is_valid").alias("is_valid"))


def page_readings(readings: DataFrame, size: int = 100, after: tuple | None = None,
                  valid_only: bool = False) -> DataFrame:
    """One page of readings in time order, for API responses (keyset pagination).

    ``after`` is the key of the previous page's last row, ``(cursor_us, device, timestamp_unix,
    reading_id)``; a prefix is allowed, and the first item may also be an aware ``datetime``. Each
    page is a pushed, partition-pruned range filter plus a top-k, so page N costs the same as page 1
    (no global offset, no sort of the table). ``cursor_us`` (epoch microseconds, independent of the
    session zone) and the other key columns are returned for the next call.
    """
    import datetime as _dt

    if size < 1:
        raise ValueError("page size must be >= 1")
    r = base(readings, valid_only)
    if after:
        t0 = after[0]
        if isinstance(t0, int):  # epoch microseconds, converted exactly
            t0 = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc) + _dt.timedelta(microseconds=t0)
        elif isinstance(t0, _dt.datetime) and t0.tzinfo is None:
            t0 = t0.replace(tzinfo=_dt.timezone.utc)  # naive cursor values are UTC wall clock
        ts = F.col("timestamp")
        cond = ts > F.lit(t0)
        rest = [(F.col("device"), 1), (F.col("timestamp_unix"), 2), (F.col("reading_id"), 3)]
        tie = None
        for col, i in reversed(rest):
            if len(after) > i:
                step = col > F.lit(after[i])
                tie = step if tie is None else (step | ((col == F.lit(after[i])) & tie))
        if tie is not None:
            cond = cond | ((ts == F.lit(t0)) & tie)
        day = t0.astimezone(_dt.timezone.utc).date() if isinstance(t0, _dt.datetime) else t0
        r = r.where((F.col("event_date") >= F.lit(day)) & (ts >= F.lit(t0)) & cond)
    return (r.orderBy("timestamp", "device", "timestamp_unix", "reading_id").limit(size)
            .select("device", utc_ntz(F.col("timestamp")).alias("timestamp"), "timestamp_unix", *_lifted(),
                    F.col("quality.is_valid").alias("is_valid"), F.unix_micros("timestamp").alias("cursor_us"),
                    "reading_id"))


def run_all(readings: DataFrame, valid_only: bool = False) -> dict[str, DataFrame]:
    """Q11: every published query plus the thresholds used, as lazy DataFrames."""
    thresholds = alert_thresholds(readings, valid_only)
    out = {
        "thresholds_used": thresholds,
        "latest_readings": latest_readings(readings, valid_only=valid_only),
        "readings_per_device": readings_per_device(readings, valid_only=valid_only),
        "avg_temperature_by_device": avg_temperature_by_device(readings, valid_only=valid_only),
        "avg_humidity_by_device": avg_humidity_by_device(readings, valid_only=valid_only),
        "readings_by_day": readings_by_day(readings, valid_only=valid_only),
        "highest_temperature_readings": highest_temperatures(readings, valid_only=valid_only),
        "highest_smoke_readings": highest_smoke(readings, valid_only=valid_only),
    }
    for f in THRESHOLD_FIELDS:
        out[f"high_{f}_readings"] = high_metric_readings(
            readings, f, thresholds.first()[f], valid_only=valid_only)
    return out


THRESHOLD_NOTE = ("Alert thresholds are the 90th percentile of each field when data exists; "
                  "otherwise fixed fallback values apply.")
