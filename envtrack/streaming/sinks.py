"""Sinks of the load: rejected rows, batch status, manifest, failure log, JSON reports.

Per-batch outputs are written under a ``batch_id=N`` partition with dynamic partition overwrite, so
writing the same batch twice (a replay after a crash) leaves exactly one copy. The failure log is
append-only by design: every failed attempt is a fact worth keeping.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_batch_partition(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Overwrite the ``batch_id`` partition of ``path`` with ``df`` (replay-safe)."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").format(fmt).save(path))


FAILURE_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("rows_in_batch", T.LongType()),
    T.StructField("documents_count", T.LongType()),
])


def append_failure(spark: SparkSession, path: str, batch_id: int, attempts: int, error: str,
                   rows_in_batch: int | None, documents_count: int | None) -> None:
    """K4: append one failure record with the whole error text."""
    row = (batch_id, attempts, error, _dt.datetime.now(_dt.timezone.utc), rows_in_batch, documents_count)
    spark.createDataFrame([row], FAILURE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """K5: a result as JSON lines; as many files as it has tasks, so that none is gathered into one."""
    df.write.mode("overwrite").json(path)
