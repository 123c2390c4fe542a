"""Paths in the store that Spark reads: whether they exist, and whether a write came to its end.

Whether a path exists is asked of the file system. Nothing here turns an error into "not there": a
listing that fails, fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from envtrack.session import state_path


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The Parquet files below ``path``; None only if the path itself is absent."""
    if not exists(spark, path):
        return None
    return spark.read.schema(schema).parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end (Spark leaves its mark with the last step of the job)."""
    return exists(spark, f"{path}/_SUCCESS")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder (spark.checkpoint.dir) and read back: whatever follows sees
    the same rows, and a lost executor costs a read, not a recomputation."""
    path = state_path(df.sparkSession, "work", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def released(df: DataFrame) -> None:
    """Remove the folder of a ``kept`` frame that nothing reads any more."""
    fs, p = _path(df.sparkSession, df.kept_path)
    fs.delete(p, True)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file (of a compressed one too); None if it has no bytes."""
    fs, p = _path(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    raw = fs.open(p)
    try:
        stream = raw if codec is None else codec.createInputStream(raw)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        raw.close()
