"""Dedupe by reading id, and the repeatable upsert of a batch into the readings table.

Skew: one reading may be copied millions of times (a replayed file, a stuck sensor). A window
``row_number() over (partition by reading_id)`` would put every copy of that id into one task.
``groupBy(reading_id).agg(max(struct(...)))`` instead combines copies on the map side, so each map
task ships at most one row per id to the shuffle.

Winner among copies: newest ``ingested_at``; among copies of the same load the greatest flag list
text (copies share device, timestamp and measurements by construction of the id, so only the flag
wording -- missing vs. invalid for a null value -- can differ).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envtrack import schema as S

def dedupe_readings(readings: DataFrame, also: list[str] | None = None) -> DataFrame:
    """One row per ``reading_id``, newest wins (partial aggregation handles hot ids).

    ``also`` names columns that are functions of the id, to be grouped by as well.
    """
    keys = ["reading_id", *(also or [])]
    payload = [c for c in S.READING_COLUMNS if c not in keys]
    best = F.max(F.struct(
        F.col("ingested_at").alias("_k1"),
        F.array_join(F.col("quality.flags"), ",").alias("_k2"),
        F.struct(*[F.col(c) for c in payload]).alias("p"),
    )).alias("_best")
    return (readings.groupBy(*keys).agg(best)
            .select(*[c if c in keys else F.col(f"_best.p.{c}").alias(c) for c in S.READING_COLUMNS]))


def upsert_counts(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: ``inserted``, ``updated``, ``inserted_or_updated`` for a batch against a table.

    inserted = distinct ids of the batch absent from the table; updated = ids present whose stored
    copy differs (other ingest time or flags). Identical repeats count as neither. ``existing`` should
    be restricted to the batch's days (an id's day is fixed), so the join reads only those partitions.
    """
    ids = dedupe_readings(batch).select("event_date", "reading_id", "ingested_at",
                                        F.col("quality.flags").alias("flags"))
    old = existing.select("event_date", "reading_id", F.col("ingested_at").alias("_old_at"),
                          F.col("quality.flags").alias("_old_flags"))
    joined = ids.join(old, ["event_date", "reading_id"], "left")
    return joined.agg(
        F.count_if(F.col("_old_at").isNull()).alias("inserted"),
        F.count_if(F.col("_old_at").isNotNull() & ((F.col("_old_at") != F.col("ingested_at"))
                                                  | (F.col("_old_flags") != F.col("flags")))).alias("updated"),
    ).withColumn("inserted_or_updated", F.col("inserted") + F.col("updated"))


def settled(readings: DataFrame) -> DataFrame:
    """``dedupe_readings`` of stored rows, grouped by day, device and time as well.

    All three are functions of the id, so that the groups are the same, and filters on them pass below
    the aggregate and reach the scan.
    """
    return dedupe_readings(readings, ["event_date", "device", "timestamp"])


def merge_frames(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    """K1 as a frame operation: the stored rows (of the touched days) upserted with a batch.

    Replace semantics: for an id present in both, the newer ingest wins (see ``dedupe_readings``).
    """
    combined = batch.select(*S.READING_COLUMNS)
    if current is not None:
        combined = current.select(*S.READING_COLUMNS).unionByName(combined)
    return dedupe_readings(combined)


def merge_into_table(spark: SparkSession, batch: DataFrame, table: str) -> None:
    """Upsert ``batch`` into the readings table as a new part of its own (``sources.table.merge_into_table``)."""
    from envtrack.sources import table as readings  # which imports this module

    readings.merge_into_table(batch, table, f"batch-{uuid.uuid4().hex}")
