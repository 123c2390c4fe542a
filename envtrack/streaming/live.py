"""Standing queries on readings as they arrive: copies, windows, silence.

All take a stream of readings (``arriving`` reads what loads write, part by part) and return one; ``run``
brings a stream's output up to date and ends, and the next run goes on from its checkpoint. What each keeps
between batches is bounded by its watermark: the newest event time seen, less the ``lateness`` that rows may
have. Rows that come later than that are left out, as Spark does.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from envtrack.functions.timecols import micros, micros_to_ntz
from envtrack.sources.table import STORED_SCHEMA


def arriving(spark: SparkSession, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """The readings that batches write to a table, copies included, as a stream."""
    stream = spark.readStream.schema(STORED_SCHEMA)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    return stream.parquet(table.rstrip("/"))


def run(stream: DataFrame, dest: str, checkpoint: str) -> DataFrame:
    """Append what the stream has to give now to the Parquet folder ``dest``, and return all that is there."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(dest))
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(dest)


def first_copies(readings: DataFrame, lateness: str = "1 day") -> DataFrame:
    """W1 on a stream: each reading once, whichever of its copies comes first.

    An id is remembered until the watermark has passed its event time by ``lateness``: copies that come
    within it, in whatever order the files do, are dropped, and older ids are forgotten.
    """
    return readings.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["reading_id"])


def window_alerts(readings: DataFrame, field: str, threshold: float, window: str = "10 minutes", slide: str | None = None,
                  least: int = 1, lateness: str = "1 hour") -> DataFrame:
    """W7 by windows: device, window_start, window_end, readings, elevated, max_value of the windows with at
    least ``least`` readings at or above ``threshold``.

    On a stream a window is reported once, when the watermark has passed its end, and then forgotten; on a
    table it is the same aggregate over all windows. Readings are combined before they are shuffled, so
    that a busy device costs one row a window and task.
    """
    value = F.col(f"measurements.{field}")
    rows = readings.withWatermark("timestamp", lateness) if readings.isStreaming else readings
    out = rows.groupBy(F.window("timestamp", window, slide).alias("w"), "device").agg(
        F.count("*").alias("readings"), F.count_if(value >= threshold).alias("elevated"), F.max(value).alias("max_value"))
    return out.where(F.col("elevated") >= least).select(
        "device", micros_to_ntz(micros(F.col("w.start"))).alias("window_start"),
        micros_to_ntz(micros(F.col("w.end"))).alias("window_end"), "readings", "elevated", "max_value")


ALARM_STATE = "last bigint, most bigint, alarmed boolean"
ALARMS = "device string, event string, last_us bigint, at_us bigint"


def silence_alarms(readings: DataFrame, limits: DataFrame, lateness: str = "0 seconds") -> DataFrame:
    """W3 as a standing alarm: device, event (raised, cleared), last_timestamp, at.

    ``limits`` (device, limit_seconds): how long each device may be silent (for instance
    ``operators.health.silent_devices``'s factor times the median interval); devices without a limit are not
    watched. An alarm is raised once, by an event-time timer, when the watermark passes a device's last
    reading by more than its limit, and cleared by its next reading. Spark has no built-in operator with
    timers by key, so that this one keeps three numbers a device in ``applyInPandasWithState``; only time
    stamps go to Python, reduced chunk by chunk.
    """
    import pandas as pd

    def watch(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = []
        last, most, alarmed = state.get if state.exists else (None, None, False)
        if state.hasTimedOut:
            rows, alarmed = [(key[0], "raised", last, last + most)], True
        else:
            newest = None
            for chunk in chunks:
                newest, most = max(newest or chunk.us.iloc[0], chunk.us.max()), int(chunk.most.iloc[0])
            newest = int(newest)
            if last is None or newest > last:
                if alarmed:
                    rows.append((key[0], "cleared", newest, newest))
                last, alarmed = newest, False
            due = -(-(last + most) // 1000)
            if not alarmed and due <= state.getCurrentWatermarkMs():
                rows.append((key[0], "raised", last, last + most))
                alarmed = True
        state.update((last, most, alarmed))
        if not alarmed:
            state.setTimeoutTimestamp(max(due, 1))
        yield pd.DataFrame(rows, columns=["device", "event", "last_us", "at_us"])

    seen = readings.select("device", "timestamp", micros(F.col("timestamp")).alias("us")).withWatermark("timestamp", lateness)
    watched = seen.join(limits.select("device", F.round(F.col("limit_seconds") * 1e6).cast("bigint").alias("most")), "device")
    events = watched.groupBy("device").applyInPandasWithState(watch, ALARMS, ALARM_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return events.select("device", "event", micros_to_ntz(F.col("last_us")).alias("last_timestamp"),
                         micros_to_ntz(F.col("at_us")).alias("at"))
