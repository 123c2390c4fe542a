"""Source manifest (path, size, modification time) and the changed-source guard.

Spark's file stream source remembers file *paths*; a file rewritten in place under a known path is
silently skipped. The load therefore records, per batch, the size and modification time of every
file it consumed, and refuses to start when a known file now looks different.

The listing uses the ``binaryFile`` source with only the metadata columns selected, so the scan's
read schema has no ``content`` column and file bodies are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SourceChangedError(RuntimeError):
    """A file that was already loaded has changed size or modification time."""


def source_manifest(spark: SparkSession, source: str, pattern: str = "*.csv") -> DataFrame:
    """S3: one row per file under ``source``: ``path, length, modificationTime``."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(source)
            .select("path", "length", "modificationTime"))


def changed_files(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Files present in both listings whose size or modification time differ (new files are fine)."""
    s = stored.select("path", F.col("length").alias("_len"), F.col("modificationTime").alias("_mtime"))
    return (current.join(s, "path", "inner")
            .where((F.col("length") != F.col("_len")) | (F.col("modificationTime") != F.col("_mtime")))
            .select("path", F.col("_len").alias("loaded_length"), F.col("length").alias("current_length"),
                    F.col("_mtime").alias("loaded_mtime"), F.col("modificationTime").alias("current_mtime")))


def guard_unchanged(current: DataFrame, stored: DataFrame | None, report: str) -> None:
    """Raise ``SourceChangedError`` if any loaded file looks different now.

    The message has the number of such files, one of their paths, and the folder below ``report``
    where all of them are listed with both sizes and times.
    """
    if stored is None:
        return
    bad = changed_files(current, stored)
    count, example = bad.agg(F.count("*"), F.min("path")).first()
    if not count:
        return
    where = f"{report}/{uuid.uuid4().hex}"
    bad.write.parquet(where)
    raise SourceChangedError(f"{count} source files changed after they were loaded, among them {example}; all are "
                             f"listed in {where}. Restore them, or start over with reset=True.")
