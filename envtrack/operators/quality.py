"""Load-quality counters: per batch, by rejection reason, by flag, by device; cumulative report.

All counters come from a classified frame (``classify_rows`` output with ``batch_number``) in
aggregations with map-side partial combine; none collects rows. The cumulative report sums the
small per-batch table (one row per batch) instead of rescanning loaded data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUALITY_CONSEQUENCES = (
    "Rows without a usable timestamp or device are rejected and kept only in the rejected-rows "
    "log. Rows with missing or unparseable measurements are stored with null values and quality "
    "flags, so queries can exclude or warn on them. Few readings per device weaken per-device "
    "averages; dense bursts inflate short-window counts; widely varying values call for per-device "
    "baselines instead of global thresholds."
)


def batch_counters() -> list[Column]:
    """A1: the counters of a batch, as aggregates over its classified rows."""
    accepted = F.col("rejection_reason").isNull()
    return [F.count("*").alias("rows_read"), F.count_if(accepted).alias("documents_built"),
            F.count_if(~accepted).alias("invalid_rows"),
            F.count_if(accepted & ~F.col("quality.is_valid")).alias("rows_with_quality_flags")]


def batch_quality_status(classified: DataFrame) -> DataFrame:
    """A1: one row per ``batch_number`` with rows read, documents built, rejected and flagged."""
    return classified.groupBy("batch_number").agg(*batch_counters()).orderBy("batch_number")


def rejected_reasons(classified: DataFrame) -> DataFrame:
    """A2: rejected rows per reason."""
    return (classified.where(F.col("rejection_reason").isNotNull())
            .groupBy("rejection_reason").agg(F.count("*").alias("rows")).orderBy("rejection_reason"))


def flag_counts(readings: DataFrame) -> DataFrame:
    """A3: occurrences of each quality flag (array unnest + count)."""
    return (readings.select(F.explode("quality.flags").alias("flag"))
            .groupBy("flag").agg(F.count("*").alias("occurrences")).orderBy("flag"))


def device_counts_loaded(readings: DataFrame) -> DataFrame:
    """A4: documents built per device (copies included, as counted at load time)."""
    return readings.groupBy("device").agg(F.count("*").alias("documents")).orderBy("device")


def quality_report(batch_status: DataFrame) -> DataFrame:
    """A5: cumulative totals over the per-batch table (one row)."""
    return batch_status.agg(
        F.coalesce(F.sum("rows_read"), F.lit(0)).cast("bigint").alias("total_rows_seen"),
        F.coalesce(F.sum("documents_built"), F.lit(0)).cast("bigint").alias("rows_loaded"),
        F.coalesce(F.sum("invalid_rows"), F.lit(0)).cast("bigint").alias("rows_rejected"),
        F.coalesce(F.sum("rows_with_quality_flags"), F.lit(0)).cast("bigint").alias("rows_with_quality_flags"),
        F.count("*").alias("batches"),
    )


def quality_counts(classified: DataFrame) -> DataFrame:
    """(kind, key, n): rejections by reason, flags by kind, documents by device (A2-A4), in one pass."""
    accepted = F.col("rejection_reason").isNull()

    def entry(kind: str, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"))

    found = F.array_compact(F.array(F.when(~accepted, entry("rejected", F.col("rejection_reason"))),
                                    F.when(accepted, entry("device", F.col("device")))))
    flags = F.transform(F.coalesce("quality.flags", F.array().cast("array<string>")), lambda f: entry("flag", f))
    return (classified.select(F.explode(F.concat(found, flags)).alias("e"))
            .groupBy("e.kind", "e.key").agg(F.count("*").alias("n")))


def _by(counts: DataFrame, kind: str, key: str, n: str) -> DataFrame:
    return (counts.where(F.col("kind") == kind).groupBy(F.col("key").alias(key)).agg(F.sum("n").alias(n))
            .orderBy(key))


def _as_map(counts: DataFrame, key: str, value: str) -> DataFrame:
    """One row, one map column -- only for vocabularies of fixed, small size (flags, reasons)."""
    return counts.agg(F.coalesce(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value)))),
                                 F.create_map().cast("map<string,bigint>")).alias("m"))


def quality_report_full(counts: DataFrame, batch_status: DataFrame) -> dict[str, DataFrame]:
    """A5: the whole report from kept counts (``quality_counts``, summed over batches) and batches.

    The totals carry the consequences text and the two bounded maps -- flag counts and rejection
    reasons, at most 14 and 4 keys. Counts per device stay a frame: they grow with the devices.
    """
    flags = _by(counts, "flag", "flag", "occurrences")
    reasons = _by(counts, "rejected", "rejection_reason", "rows")
    totals = quality_report(batch_status).withColumn("consequences", F.lit(QUALITY_CONSEQUENCES)).select(
        "*", _as_map(flags, "flag", "occurrences").scalar().alias("invalid_measurement_values"),
        _as_map(reasons, "rejection_reason", "rows").scalar().alias("rejected_reasons"))
    return {"totals": totals, "invalid_measurement_values": flags, "rejected_reasons": reasons,
            "device_counts": _by(counts, "device", "device", "documents"), "batch_quality_status": batch_status}
