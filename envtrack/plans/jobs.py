"""Job-level entry points: validate a table, run every published query, write reports.

These are what the reference's three scripts did (load, validate, query), as functions over a table
path. The load itself is ``envtrack.streaming.load.load_readings``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from envtrack.functions.timecols import utc_ntz
from envtrack.operators import validate as V
from envtrack.plans import queries as Q
from envtrack.sources.table import read_readings
from envtrack.streaming.sinks import write_json_report


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The readings in force; an absent table reads as an empty one, an unreadable one fails."""
    return read_readings(spark, table)


def read_window(spark: SparkSession, table: str, start, end, devices=None) -> DataFrame:
    """P25 on a table path: readings of ``[start, end)`` (dates or aware datetimes); the days of the
    window prune the table's folders."""
    return Q.readings_in_window(read_table(spark, table), devices, start, end)


def validate(spark: SparkSession, table: str) -> DataFrame:
    """The one-row validation report."""
    return V.validation_report(read_table(spark, table))


def validation_reports(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """J3 with its attachments: the one-row report, statistics, null counts, quality metrics, density,
    and one example reading (S7, smallest id), its timestamps as UTC text and measurements nested."""
    readings = read_table(spark, table)
    example = V.example_document(readings).select(
        "reading_id", F.date_format(utc_ntz(F.col("timestamp")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "timestamp_unix", "device", "measurements", "quality", "source",
        F.date_format(utc_ntz(F.col("ingested_at")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"))
    return {"validation_report": V.validation_report(readings), "example_document": example,
            "basic_statistics": V.basic_statistics(readings), "null_counts": V.null_counts(readings),
            "quality_metrics": V.quality_metrics(readings), "device_density": V.device_density(readings)}


def is_ready(report: Row) -> bool:
    """Exit-status rule of the validation job: data present and ready for queries."""
    return bool(report["data_present"] and report["ready_for_queries"])


def run_all(spark: SparkSession, table: str, valid_only: bool = False) -> dict[str, DataFrame]:
    """Every published query (Q1-Q10) plus the thresholds used and the note (Q11)."""
    out = Q.run_all(read_table(spark, table), valid_only=valid_only)
    out["threshold_note"] = spark.createDataFrame([(Q.THRESHOLD_NOTE,)], "threshold_note string")
    return out


def write_reports(frames: dict[str, DataFrame], dest: str) -> dict[str, DataFrame]:
    """K5: each frame as JSON lines under ``dest/<name>``, computed once: returns what was written."""
    written = {}
    for name, df in frames.items():
        path = f"{dest.rstrip('/')}/{name}"
        write_json_report(df, path)
        written[name] = df.sparkSession.read.schema(df.schema).json(path)
    return written


def load_summary_frame(spark: SparkSession, summary) -> DataFrame:
    """K6: a load summary as a one-row frame (for the JSON sink)."""
    d = dict(summary.as_dict())
    steps = d.pop("step_seconds", None) or {}
    row = spark.createDataFrame([tuple(d.values())], ", ".join(f"{k} {_sql_type(v)}" for k, v in d.items()))
    if steps:
        row = row.withColumn("step_seconds", F.create_map(*[x for k, v in steps.items() for x in (F.lit(k), F.lit(v))]))
    return row


def _sql_type(v) -> str:
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "bigint"
    if isinstance(v, float):
        return "double"
    return "string"
